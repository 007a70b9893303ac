"""Exact duplicates and concatenation of part tables."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """Whole-row distinct, nested arrays included. Copies collapse before the shuffle."""
    return df.dropDuplicates()


def with_hashes(df: DataFrame) -> DataFrame:
    """``df`` with 128 bits of each row's columns in ``h1`` and ``h2``; equal rows have equal ones."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    return df.withColumns({"h1": F.xxhash64(*columns), "h2": F.xxhash64(F.lit("second"), *columns)})


def unseen(hashed: DataFrame, seen: DataFrame) -> DataFrame:
    """Rows whose hashes are not among those ``seen``.

    An outer join, so that Spark may filter ``seen`` by a Bloom filter of the new rows before it shuffles
    it; it does not do that for an anti join.
    """
    known = seen.select(F.col("h1").alias("_h1"), F.col("h2").alias("_h2"))
    same = (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2"))
    return hashed.join(known, same, "left").where(F.col("_h1").isNull()).drop("_h1", "_h2")


def dedup_report(df: DataFrame) -> DataFrame:
    """Rows before, after and removed, from one aggregation."""
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("copies"))
    return copies.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
    ).select("*", (F.col("rows_before") - F.col("rows_after")).alias("duplicates_removed"))


def union_parts(parts: list[DataFrame]) -> DataFrame:
    """Concatenate part tables by column name; none at all is an error."""
    if not parts:
        raise ValueError("no part tables to concatenate")
    return reduce(DataFrame.unionByName, parts)

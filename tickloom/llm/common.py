"""Helpers that several training-data operators share."""

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.session import materialize

__all__ = [
    "BUCKETS", "WORD", "arrow_rows", "documents", "fresh_names", "materialize", "offsets_in_groups", "once",
    "row_key", "slices", "small_batches", "text_key",
]

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Parts that a group is cut into when its rows are numbered; fixed, so that reruns agree.
BUCKETS = 4096


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fresh_names(df: DataFrame, *bases: str) -> list[str]:
    """Column names that no column of ``df`` has, whatever their case."""
    taken = {name.lower() for name in df.columns}
    tail = uuid.uuid4().hex[:8]
    return [base if base.lower() not in taken else f"{base}_{tail}" for base in bases]


def text_key(text: Column) -> list[Column]:
    """128 bits of a text as two longs."""
    return [F.xxhash64(text), F.xxhash64(F.lit("second"), text)]


def row_key(df: DataFrame) -> list[Column]:
    """128 bits of all of a row's columns (but maps, which have no order) as two longs."""
    columns = [df[f"`{f.name}`"] for f in df.schema if not isinstance(f.dataType, T.MapType)]
    return [F.xxhash64(*columns), F.xxhash64(F.lit("second"), *columns)]


def once(df: DataFrame, keys: list[str], marker: str) -> DataFrame:
    """One row for each value of ``keys``.

    Spark limits each task's rows to the first of a key before the shuffle, so a row that repeats
    without end costs no more than its copies in one task each.
    """
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(keys[0]))
    return df.withColumn(marker, first).where(F.col(marker) == 1)


def small_batches(spark: SparkSession, rows: int = 256) -> None:
    """Arrow batches of at most ``rows`` rows, so that very long texts fit a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most ``rows`` rows for what is run inside the block."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def slices(batch: pa.RecordBatch, column: str, most: int = 16 << 20) -> Iterator[pa.Table]:
    """Pieces of an Arrow batch whose ``column`` holds about ``most`` bytes, or else a single row."""
    table = pa.Table.from_batches([batch])
    sizes = pc.fill_null(pc.binary_length(table[column]), 0).to_numpy()
    part = np.cumsum(sizes, dtype=np.int64) // most
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), table.num_rows]
    for begin, end in zip(cuts, cuts[1:]):
        if end > begin:
            yield table.slice(begin, end - begin)


def offsets_in_groups(
    df: DataFrame, groups: list[str], order: list[str], name: str, weight: Column | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Add ``name``, the sum of ``weight`` over the rows before each row of its group.

    Without a weight it is the row's gapless number from 0. No group is sorted in one task: its
    rows fall into ``buckets`` parts by the hash of the ordering columns, each part is summed on its
    own, and the parts' totals, one row for each, give where a part begins. ``df`` should be a stored
    table, it is read twice. Rows equal in all ordering columns are interchangeable. Null groups
    count as a group of their own.
    """
    bucket, total, begin, inside, size = fresh_names(
        df, "_bucket", "_total", "_begin", "_inside", "_size")
    keys = [f"_group_{i}" for i in range(len(groups))]
    rows = df.withColumns({
        bucket: F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"),
        size: (F.lit(1) if weight is None else weight).cast("long"),
    })
    totals = rows.groupBy(*[F.col(g).alias(k) for g, k in zip(groups, keys)], F.col(bucket).alias("_b")) \
        .agg(F.sum(size).alias(total))
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        *keys, "_b", F.coalesce(F.sum(total).over(before), F.lit(0)).alias(begin))
    within = Window.partitionBy(*groups, bucket).orderBy(*order) \
        .rowsBetween(Window.unboundedPreceding, -1)
    numbered = rows.withColumn(inside, F.coalesce(F.sum(size).over(within), F.lit(0)))
    matching = [F.col(g).eqNullSafe(F.col(k)) for g, k in zip(groups, keys)]
    condition = F.col(bucket) == F.col("_b")
    for one in matching:
        condition = condition & one
    joined = numbered.join(starts, condition)
    return joined.select(*df.columns, (F.col(begin) + F.col(inside)).cast("long").alias(name))

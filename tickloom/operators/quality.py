"""Counts, reports and pass/fail checks; every report is one aggregation over the table."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.numbers import missing

def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def _counts_by_column(
    df: DataFrame, columns: list[str], test: Callable[[str], Column], name: str
) -> DataFrame:
    return df.agg(*[F.count_if(test(c)).alias(c) for c in columns]).unpivot(
        [], columns, "column", name
    )


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls of every column, as ``(column, nulls)`` rows."""
    return _counts_by_column(df, df.columns, lambda c: F.col(c).isNull(), "nulls")


def nan_counts(df: DataFrame) -> DataFrame:
    """Null or NaN values of every numeric column, as ``(column, missing)`` rows."""
    return _counts_by_column(df, numeric_columns(df), lambda c: missing(df, c), "missing")


def symbol_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy("symbol").agg(F.count(F.lit(1)).alias("rows")).orderBy("symbol")


def price_range(df: DataFrame) -> DataFrame:
    return df.groupBy("symbol").agg(
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.avg("price").alias("avg_price"),
    ).orderBy("symbol")


def join_quality(joined: DataFrame) -> DataFrame:
    """Joined rows with and without a book; percentages are null on an empty table."""
    matched, total = F.count("top_bid_price"), F.count(F.lit(1))
    def percent(part: Column) -> Column:
        return F.try_divide(part * F.lit(100.0), total)

    return joined.agg(
        total.alias("total"),
        matched.alias("matched"),
        (total - matched).alias("unmatched"),
        percent(matched).alias("matched_pct"),
        percent(total - matched).alias("unmatched_pct"),
    )


def profile(df: DataFrame) -> DataFrame:
    """Stage report ``(column, type, rows, nulls, missing)`` from one pass."""
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    wide = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[
            F.struct(
                F.count_if(F.col(c).isNull()).alias("nulls"),
                F.count_if(missing(df, c)).alias("missing"),
            ).alias(c)
            for c in df.columns
        ],
    )
    type_of = F.create_map(*[F.lit(x) for item in types.items() for x in item])
    return wide.unpivot("rows", df.columns, "column", "m").select(
        "column",
        F.try_element_at(type_of, F.col("column")).alias("type"),
        "rows",
        F.col("m.nulls").alias("nulls"),
        F.col("m.missing").alias("missing"),
    )


def sample_rows(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(n)


def expectations(features: DataFrame) -> DataFrame:
    """``(name, observed, bound, passed)``: row count, price bounds, share of empty averages."""
    rows = F.count_if(F.col("symbol") == "BTCUSDT").cast("double")
    zero_share = F.try_divide(
        F.count_if(F.col("rolling_avg_5") == 0).cast("double"), F.count(F.lit(1))
    )
    observed = features.agg(
        rows.alias("btc_rows_at_least"),
        F.min("price").alias("price_at_least"),
        F.max("price").alias("price_at_most"),
        zero_share.alias("zero_average_share_below"),
    )
    # --- fixed values: documented bounds ---
    bounds = {
        "btc_rows_at_least": 1000.0,
        "price_at_least": 1.0,
        "price_at_most": 1_000_000.0,
        "zero_average_share_below": 0.01,
    }
    # --- end of fixed values ---
    bound_of = F.create_map(*[F.lit(x) for item in bounds.items() for x in item])
    long = observed.unpivot([], list(bounds), "name", "observed").withColumn(
        "bound", F.try_element_at(bound_of, F.col("name"))
    )
    passed = (
        F.when(F.col("name").endswith("at_least"), F.col("observed") >= F.col("bound"))
        .when(F.col("name").endswith("at_most"), F.col("observed") <= F.col("bound"))
        .otherwise(F.col("observed") < F.col("bound"))
    )
    return long.withColumn("passed", F.coalesce(passed, F.lit(False)))


def observed(df: DataFrame, stage: str) -> tuple[DataFrame, Observation]:
    """``df`` with row and symbol-null counts taken while it is written, not by extra jobs."""
    taken = Observation(stage)
    return df.observe(
        taken,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("symbol").isNull()).alias("rows_without_symbol"),
    ), taken


def observed_step(
    df: DataFrame, step: Callable[[DataFrame], DataFrame], name: str
) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """``step(df)`` and, once that has been written, the rows before, after and dropped."""
    counted_in, before = observed(df, f"{name} before")
    counted_out, after = observed(step(counted_in), f"{name} after")

    def counts() -> dict[str, int]:
        rows_in, rows_out = before.get["rows"], after.get["rows"]
        return {"rows_before": rows_in, "rows_after": rows_out, "dropped": rows_in - rows_out}

    return counted_out, counts


def layer_size(spark: SparkSession, path: str) -> DataFrame:
    """Number and total bytes of the parquet files below ``path``; file contents stay unread."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(path)
    )
    return files.agg(
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"),
    )


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    return [c for c in required if c not in df.columns]

"""Newest rows per key, latest value per key, newest rows overall."""

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.session import materialize

SLICE_MS = 3_600_000
#: Rows of one time slice that may be ranked with those of the newer ones; more are sliced finer.
SPARE = 10_000
#: Finer slices that a crowded one is cut into.
FINER = 1_000
#: Keys whose floors are pushed down to the scan one by one.
FEW_KEYS = 32
_NO_TIME = -(1 << 62)  # slice of rows without a time


def _newest_first(order: list[str]) -> list[Column]:
    return [F.col(c).desc() for c in order]


def _boundary(sliced: DataFrame, key: str, n: int, before: Column) -> DataFrame:
    """The slice of each key that holds its ``n``-th newest row: start, rows, and rows in newer slices.

    ``before`` counts rows that are newer than all slices.
    """
    newer = Window.partitionBy(key).orderBy(F.col("_slice").desc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    counts = sliced.groupBy(key, "_slice").agg(F.count(F.lit(1)).alias("rows"), F.max(before).alias("_before"))
    return (
        counts.withColumn("newer", F.coalesce(F.sum("rows").over(newer), F.lit(0)) + F.col("_before"))
        .where(F.col("newer") < n)
        .withColumn("_slice", F.coalesce("_slice", F.lit(_NO_TIME)))
        .groupBy(F.col(key).alias("_key"))
        .agg(F.min("_slice").alias("start"), F.min_by("rows", "_slice").alias("rows"), F.max("newer").alias("newer"))
    )


def _cut(df: DataFrame, n: int, key: str, time: Column, slice_ms: int, spare: int) -> DataFrame:
    """(_key, start): where the newest rows of each key begin, some older ones included.

    Slices are counted, and the one with a key's ``n``-th newest row is cut finer as long as it holds
    more than ``spare`` rows and more than one millisecond.
    """
    def slice_of(width: int) -> Column:
        return time - F.pmod(time, F.lit(width))

    width, settled = slice_ms, None
    cut = materialize(_boundary(df.withColumn("_slice", slice_of(width)), key, n, F.lit(0)), "slices")
    while width > 1 and not cut.where((F.col("rows") > spare) & (F.col("start") > _NO_TIME)).isEmpty():
        crowded = cut.where((F.col("rows") > spare) & (F.col("start") > _NO_TIME))
        rest = cut.where((F.col("rows") <= spare) | (F.col("start") == _NO_TIME))
        settled = rest if settled is None else settled.unionByName(rest)
        inside = df.join(crowded, F.col(key).eqNullSafe(F.col("_key"))).where(
            (time >= F.col("start")) & (time < F.col("start") + width))
        width = max(1, width // FINER)
        cut = materialize(
            _boundary(inside.withColumn("_slice", slice_of(width)), key, n, F.col("newer")), "slices")
    return cut if settled is None else materialize(settled.unionByName(cut), "slices")


def _above_floors(df: DataFrame, cut: DataFrame, key: str, time: Column) -> DataFrame:
    """Rows not older than what their key needs, as a filter that the scan can skip files by."""
    floors = cut.select("_key", "start").limit(FEW_KEYS + 1).collect()
    if not floors or any(r["start"] <= _NO_TIME for r in floors):
        return df
    if len(floors) <= FEW_KEYS:
        return df.where(reduce(or_, [
            (F.col(key).isNull() if r["_key"] is None else F.col(key) == F.lit(r["_key"])) & (time >= r["start"])
            for r in floors]))
    oldest = cut.agg(F.min("start")).first()[0]
    return df.where(time >= oldest) if oldest > _NO_TIME else df


def most_recent(
    df: DataFrame,
    n: int,
    key: str = "symbol",
    order: tuple[str, ...] = ("timestamp",),
    slice_ms: int = SLICE_MS,
    salts: int | None = None,
    spare: int = SPARE,
) -> DataFrame:
    """The ``n`` newest rows of every key, by ``order`` (its first column is epoch ms).

    1. Rows are counted per key and time slice, finer where a slice is crowded, which tells the time
       from which a key's newest ``n`` rows can come. These times are pushed down to the scan.
    2. What is left, about ``n`` rows and the ``spare`` of a slice for each key, is ranked twice:
       within (key, salt), then within the key. Only rows of one millisecond can be more; a
       mass of them is spread over ``salts`` tasks, by default as many as a shuffle has.
    """
    salts = salts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    time = F.col(order[0])
    cut = _cut(df, n, key, time, slice_ms, spare)
    near = _above_floors(df, cut, key, time).join(
        cut.select("_key", "start"), F.col(key).eqNullSafe(F.col("_key"))
    ).where(F.coalesce(time, F.lit(_NO_TIME)) >= F.col("start")).drop("_key", "start")
    # The task's partition number is the same when a lost task runs again.
    salted = near.withColumn("_salt", F.spark_partition_id() % salts)
    ranked = _newest_first([*order])
    within_salt = Window.partitionBy(key, "_salt").orderBy(*ranked)
    within_key = Window.partitionBy(key).orderBy(*ranked)
    return (
        salted.withColumn("_rank", F.row_number().over(within_salt)).where(F.col("_rank") <= n)
        .withColumn("_rank", F.row_number().over(within_key)).where(F.col("_rank") <= n)
        .drop("_rank", "_salt")
    )


def latest_value(
    df: DataFrame, value: str, key: str = "symbol", order: tuple[str, ...] = ("timestamp",)
) -> DataFrame:
    """``value`` of the newest row per key; keys without rows do not appear.

    Not ``max_by`` over (time, id): aggregating by a struct sorts all rows, this prunes them.
    """
    return most_recent(df, 1, key, order).select(key, value, order[0])


def newest(df: DataFrame, n: int, order: tuple[str, ...] = ("timestamp",)) -> DataFrame:
    """The ``n`` newest rows overall, newest first."""
    return df.orderBy(*_newest_first([*order])).limit(n)

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickloom.operators.ordered import CARRIED, lay_out


def rows_for(seed, n=400, hot=True):
    """One group with a third of the rows, groups of one row, and many equal timestamps."""
    rng = random.Random(seed)
    names = ["hot"] * (n // 3 if hot else 0)
    names += [rng.choice("abc") for _ in range(n - len(names) - 2)] + ["one", "two"]
    return [
        (g, rng.randrange(n // 8), i, rng.choice([None, float(i)])) for i, g in enumerate(names)
    ]


@pytest.fixture(params=[(1, 1), (2, 3), (3, 9), (4, 40)])
def case(spark, request):
    seed, blocks = request.param
    data = rows_for(seed)
    df = spark.createDataFrame(data, "g string, t long, id long, v double")
    expected = pd.DataFrame(data, columns=["g", "t", "id", "v"]).sort_values(["g", "t", "id"])
    return lay_out(df, ["g"], ["t", "id"], blocks), expected


def test_history_gives_the_same_lags_and_frames_as_one_window(case):
    ordered, expected = case
    seen = ordered.with_history(10)
    got = (
        seen.df.withColumn("lag", F.lag("id", 10).over(seen.window))
        .withColumn("total", F.sum("id").over(seen.window.rowsBetween(-10, 0)))
        .where(~F.col(CARRIED)).select("g", "t", "id", "lag", "total").toPandas()
        .sort_values(["g", "t", "id"]).reset_index(drop=True)
    )
    expected = expected.assign(
        lag=expected.groupby("g")["id"].shift(10),
        total=expected.groupby("g")["id"].rolling(11, min_periods=1).sum()
        .reset_index(level=0, drop=True),
    ).reset_index(drop=True)
    pd.testing.assert_series_equal(got["id"], expected["id"])
    assert got["lag"].fillna(-1).tolist() == expected["lag"].fillna(-1).tolist()
    assert got["total"].tolist() == expected["total"].tolist()


def test_ranked_counts_over_all_blocks(case):
    ordered, expected = case
    got = ordered.ranked().rows().toPandas().sort_values(["g", "t", "id"])
    assert got["rn"].tolist() == (expected.groupby("g").cumcount() + 1).tolist()
    assert got["group_rows"].tolist() == expected.groupby("g")["g"].transform("size").tolist()


def test_filled_carries_values_across_blocks(case):
    ordered, expected = case
    got = ordered.filled(["v"]).rows().toPandas().sort_values(["g", "t", "id"])
    wanted = expected.groupby("g")["v"].ffill()
    assert got["v"].fillna(-1).tolist() == wanted.fillna(-1).tolist()


def test_rank_survives_added_history(case):
    ordered, expected = case
    seen = ordered.ranked().with_history(5)
    wrong = seen.df.withColumn("previous", F.lag("rn", 1).over(seen.window)).where(
        ~F.col(CARRIED) & (F.col("previous") != F.col("rn") - 1)
    )
    assert wrong.count() == 0


def test_a_hot_group_is_cut_into_blocks(spark):
    df = spark.range(3000).select(F.lit("hot").alias("g"), F.col("id").alias("t"))
    blocks = lay_out(df, ["g"], ["t"], 10).blocks.select("block_rows").toPandas()["block_rows"]
    assert len(blocks) == 10 and blocks.max() < 900


def test_rows_equal_in_every_key_are_still_spread(spark):
    df = spark.range(4000, numPartitions=16).select(
        F.lit("g").alias("g"), F.lit(5).cast("long").alias("t")
    )
    ordered = lay_out(df, ["g"], ["t"], 8)
    sizes = ordered.blocks.select("block_rows").toPandas()["block_rows"]
    assert sizes.sum() == 4000 and sizes.max() < 2000


def test_empty_input(spark):
    df = spark.createDataFrame([], "g string, t long, v double")
    ordered = lay_out(df, ["g"], ["t"], 4)
    assert ordered.with_history(3).df.count() == 0
    assert ordered.ranked().rows().count() == 0
    assert ordered.filled(["v"]).rows().count() == 0


def test_null_group_is_a_group(spark):
    df = spark.createDataFrame(
        [(None, i, float(i)) for i in range(30)], "g string, t long, v double"
    )
    ranked = lay_out(df, ["g"], ["t"], 4).ranked().rows().orderBy("t").collect()
    assert [r["rn"] for r in ranked] == list(range(1, 31))


def test_window_needs_one_shuffle_and_one_sort(spark):
    df = spark.range(1000).select(F.lit("a").alias("g"), F.col("id").alias("t"))
    seen = lay_out(df, ["g"], ["t"], 5).with_history(10)
    plan = seen.df.withColumns({
        "a": F.lag("t", 1).over(seen.window),
        "b": F.avg("t").over(seen.window.rowsBetween(-5, 0)),
    })._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(g") == 1
    assert plan.count("Window [lag") == 1

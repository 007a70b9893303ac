import random

import pytest
from pyspark.sql import functions as F

from tickloom.operators import recent
from tickloom.operators.recent import latest_value, most_recent, newest
from tickloom.operators.views import chart


@pytest.mark.parametrize("n", [1, 2, 50, 5000])
def test_most_recent_against_brute_force(spark, n):
    rng = random.Random(n)
    data = [("hot" if i % 3 == 0 else rng.choice("abc"), rng.randrange(20_000_000), i)
            for i in range(2000)] + [("late", None, 2000)]
    df = spark.createDataFrame(data, "symbol string, timestamp long, id long").repartition(7)
    got = most_recent(df, n, order=("timestamp", "id")).collect()
    wanted = []
    for symbol in {d[0] for d in data}:
        mine = [d for d in data if d[0] == symbol]
        mine.sort(key=lambda d: (d[1] is not None, d[1] or 0, d[2]), reverse=True)
        wanted += mine[:n]
    assert sorted((r["id"]) for r in got) == sorted(d[2] for d in wanted)


@pytest.mark.parametrize("n, spare", [(1, 1), (7, 3), (50, 20), (700, 10)])
def test_crowded_slices_are_cut_finer(spark, n, spare, monkeypatch):
    """All rows lie within one slice, many in one second or one millisecond; negative times too."""
    rng = random.Random(n)
    data = [(rng.choice("ab"), rng.choice([-5, 5, 4000 + rng.randrange(40), 5000 + rng.randrange(2000)]), i)
            for i in range(1500)] + [("none", None, i) for i in range(2000, 2060)] + [(None, 7, 3000)]
    df = spark.createDataFrame(data, "symbol string, timestamp long, id long").repartition(7)
    got = most_recent(df, n, order=("timestamp", "id"), spare=spare)
    wanted = []
    for symbol in {d[0] for d in data}:
        mine = [d for d in data if d[0] == symbol]
        mine.sort(key=lambda d: (d[1] is not None, d[1] or 0, d[2]), reverse=True)
        wanted += mine[:n]
    assert sorted(r["id"] for r in got.collect()) == sorted(d[2] for d in wanted)


def test_what_is_ranked_does_not_grow_with_a_slice(spark):
    df = spark.range(30_000).select(F.lit("s").alias("symbol"), F.col("id").alias("timestamp"), "id")
    cut = recent._cut(df, 5, "symbol", F.col("timestamp"), recent.SLICE_MS, 100).first()
    assert df.where(F.col("timestamp") >= cut["start"]).count() <= 5 + 100


def test_one_stale_key_does_not_bring_back_the_others(spark):
    df = spark.createDataFrame(
        [("new", t, t) for t in range(10_000_000, 10_000_050)] + [("old", 5, 1)], "symbol string, timestamp long, id long")
    cut = recent._cut(df, 2, "symbol", F.col("timestamp"), 10, 1)
    assert recent._above_floors(df, cut, "symbol", F.col("timestamp")).count() == 3


def test_most_recent_of_equal_rows(spark):
    df = spark.range(1000, numPartitions=8).select(
        F.lit("s").alias("symbol"), F.lit(7).cast("long").alias("timestamp")
    )
    assert most_recent(df, 10).count() == 10


def test_most_recent_limits_before_it_shuffles(spark):
    df = spark.range(100).select(F.lit("s").alias("symbol"), F.col("id").alias("timestamp"))
    plan = most_recent(df, 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2
    assert "Partial" in plan and "hashpartitioning(_salt" in plan


def test_latest_and_newest(spark):
    df = spark.createDataFrame(
        [("a", 1, 1.0), ("a", 3, 3.0), ("a", 2, 2.0), ("b", 1, 9.0)],
        "symbol string, timestamp long, price double",
    )
    assert {r["symbol"]: r["price"] for r in latest_value(df, "price").collect()} == {
        "a": 3.0, "b": 9.0}
    assert [r["timestamp"] for r in newest(df, 2).collect()] == [3, 2]


def test_chart_joins_points_by_time(spark):
    prices = spark.createDataFrame(
        [("a", 1, 1.0), ("a", 2, 2.0)], "symbol string, timestamp long, price double"
    )
    predictions = spark.createDataFrame(
        [("a", 2, 2.5), ("a", 3, 3.5), ("no-price", 1, 1.0)],
        "symbol string, timestamp long, predicted_price double",
    )
    rows = sorted(tuple(r) for r in chart(prices, predictions)
                  .select("symbol", "t", F.coalesce("actual_price", F.lit(-1.0)),
                          F.coalesce("predicted_price", F.lit(-1.0))).collect())
    assert rows == [("a", 1, 1.0, -1.0), ("a", 2, 2.0, 2.5), ("a", 3, -1.0, 3.5)]
    assert chart(prices, predictions, n=2).count() == 2

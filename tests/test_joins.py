import random

import pytest
from pyspark.sql import functions as F

from tickloom.operators.joins import asof_join, band_join
from tickloom.schemas import BOOK_MATCH_COLS

EPOCH = 1_704_067_200_000
TRADE = "symbol string, timestamp long, price double, size double, trade_id long"
BOOK = "symbol string, timestamp long, " + ", ".join(f"{c} double" for c in BOOK_MATCH_COLS)


def trades_at(spark, *offsets, symbol="BTCUSDT"):
    rows = [(symbol, EPOCH + t, 1.0, 1.0, i) for i, t in enumerate(offsets)]
    return spark.createDataFrame(rows, TRADE)


def books_at(spark, *offsets, symbol="BTCUSDT"):
    rows = [(symbol, EPOCH + t, 1.0, 2.0, 0.5, 3.0, 6.0) for t in offsets]
    return spark.createDataFrame(rows, BOOK)


def test_band_is_whole_seconds_inclusive(spark):
    joined = band_join(trades_at(spark, 1000), books_at(spark, 0, 999, 2999, 3000))
    assert sorted(r["book_timestamp"] - EPOCH for r in joined.collect()) == [0, 999, 2999]


def test_trade_without_book_stays(spark):
    rows = band_join(trades_at(spark, 1000), books_at(spark, 9000)).collect()
    assert len(rows) == 1 and rows[0]["top_bid_price"] is None


def test_no_books_at_all(spark):
    assert band_join(trades_at(spark, 1, 2, 3), books_at(spark)).count() == 3


def test_null_keys_stay_unmatched(spark):
    trades = spark.createDataFrame(
        [(None, EPOCH, 1.0, 1.0, 1), ("BTCUSDT", None, 1.0, 1.0, 2)], TRADE
    )
    books = books_at(spark, 0).unionByName(books_at(spark, 0, symbol=None))
    rows = band_join(trades, books).collect()
    assert len(rows) == 2 and all(r["book_timestamp"] is None for r in rows)


def test_band_join_against_brute_force_with_a_crowded_second(spark):
    rng = random.Random(7)
    trades = [("A", EPOCH + 500, 1.0, 1.0, i) for i in range(60)]
    trades += [(rng.choice("AB"), EPOCH + rng.randrange(60_000), 1.0, 1.0, i)
               for i in range(60, 180)]
    books = [("A", EPOCH + 700, float(i), 2.0, 0.5, 3.0, 6.0) for i in range(30)]
    books += [(rng.choice("AB"), EPOCH + rng.randrange(60_000), float(i), 2.0, 0.5, 3.0, 6.0)
              for i in range(30, 90)]
    wanted = []
    for t in trades:
        near = [b for b in books
                if b[0] == t[0] and abs(t[1] // 1000 - b[1] // 1000) <= 1]
        wanted += [(t[4], b[2]) for b in near] or [(t[4], None)]
    got = band_join(spark.createDataFrame(trades, TRADE), spark.createDataFrame(books, BOOK))
    found = [(r["trade_id"], r["top_bid_price"]) for r in got.collect()]
    assert sorted(found, key=str) == sorted(wanted, key=str)


def test_band_join_is_an_equality_join_on_symbol_and_second(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = band_join(trades_at(spark, 1000), books_at(spark, 0))
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join = next(line for line in plan.splitlines() if "SortMergeJoin" in line)
    assert "symbol" in join and "second" in join and join.rstrip().endswith("Inner")
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_aqe_splits_a_crowded_second_on_both_sides(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        spread = F.col("id") * 1000 + EPOCH
        crowded = F.when(F.col("id") % 3 == 0, F.lit(EPOCH)).otherwise(spread)
        trades = spark.range(0, 900, numPartitions=8).select(
            F.lit("A").alias("symbol"), crowded.alias("timestamp"), F.rand(1).alias("price"),
            F.rand(2).alias("size"), F.col("id").alias("trade_id"))
        books = spark.range(0, 300, numPartitions=8).select(
            F.lit("A").alias("symbol"), crowded.alias("timestamp"),
            *[F.rand(3).alias(c) for c in BOOK_MATCH_COLS])
        joined = band_join(trades, books)
        wanted = trades.alias("t").join(
            books.alias("b"),
            F.expr("abs(t.timestamp div 1000 - b.timestamp div 1000) <= 1"), "left").count()
        assert joined.count() == wanted
        summed = joined.agg(F.sum("price"), F.sum("size"), F.sum("top_bid_price"))
        summed.collect()
        plan = summed._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
        assert plan.split("Initial Plan")[0].count("AQEShuffleRead skewed") == 2
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_latest_book(spark):
    trades = trades_at(spark, 10, 100, 100, 250)
    books = spark.createDataFrame([
        ("BTCUSDT", EPOCH + 100, 10.0, 12.0, 0.5, 3.0, 6.0),
        ("BTCUSDT", EPOCH + 240, 20.0, 25.0, 0.7, 4.0, 7.0),
        ("ETHUSDT", EPOCH + 5, 1.0, 2.0, 9.0, 9.0, 9.0),
    ], BOOK)
    rows = asof_join(trades, books, blocks=3).orderBy("trade_id").collect()
    assert [r["spread"] for r in rows] == [0.0, 2.0, 2.0, 5.0]
    assert [r["bid_ask_ratio"] for r in rows] == [0.0, 0.5, 0.5, 0.7]


@pytest.mark.parametrize("blocks", [1, 6])
def test_latest_book_against_brute_force(spark, blocks):
    rng = random.Random(3)
    trades = [(rng.choice("AAAB"), EPOCH + rng.randrange(3000), 1.0, 1.0, i) for i in range(200)]
    times = rng.sample(range(3000), 60)
    books = [(rng.choice("AB"), EPOCH + t, float(t), t + 1.0, 0.5, 3.0, 6.0) for t in times]
    wanted = {}
    for t in trades:
        before = [b[1] for b in books if b[0] == t[0] and b[1] <= t[1]]
        wanted[t[4]] = max(before, default=None)
    got = asof_join(
        spark.createDataFrame(trades, TRADE), spark.createDataFrame(books, BOOK), blocks=blocks
    )
    assert {r["trade_id"]: r["book_timestamp"] for r in got.collect()} == wanted

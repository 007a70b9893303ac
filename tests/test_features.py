import math
import statistics

import pytest
from pyspark.sql import functions as F

from tickloom.operators.features import BY_DATE, CONTINUOUS, build_features, live_features, order_ticks

EPOCH = 1_704_067_200_000
DAY = 86_400_000
JOINED = (
    "symbol string, timestamp long, price double, size double, top_bid_price double,"
    " top_ask_price double, bid_ask_ratio double, total_bid_volume double,"
    " total_ask_volume double, trade_id long, book_timestamp long"
)


def ticks(spark, prices, group=BY_DATE, blocks=None, ratio=None, gap=1000, start=EPOCH):
    rows = [
        ("BTCUSDT", start + i * gap, float(p), float(i % 4), None, None, ratio, None, None, i, None)
        for i, p in enumerate(prices)
    ]
    df = spark.createDataFrame(rows, JOINED).withColumn(
        "date", F.to_date(F.timestamp_millis("timestamp"))
    )
    return order_ticks(df, group, blocks)


@pytest.mark.parametrize("rows, expected", [(10, 0), (11, 1)])
def test_first_ten_rows_go(spark, rows, expected):
    assert build_features(ticks(spark, range(1, rows + 1))).count() == expected


@pytest.mark.parametrize("blocks", [1, 5])
def test_batch_and_serving_statistics(spark, blocks):
    prices = [((i * 37) % 23) + 1.5 for i in range(60)]
    batch = build_features(ticks(spark, prices, blocks=blocks)).orderBy("timestamp").collect()
    live = ticks(spark, prices, CONTINUOUS, blocks)
    live = live_features(order_ticks(
        live.rows().withColumn("spread", F.lit(0.0)), CONTINUOUS, blocks
    )).orderBy("timestamp").collect()
    assert len(batch) == len(live) == 50
    for i, (b, s) in enumerate(zip(batch, live), start=10):
        assert (b["price_lag_1"], b["price_lag_5"], b["price_lag_10"]) == (
            prices[i - 1], prices[i - 5], prices[i - 10])
        assert b["price_change"] == prices[i] - prices[i - 1]
        assert math.isclose(b["rolling_avg_5"], statistics.fmean(prices[i - 5:i + 1]))
        assert math.isclose(b["rolling_avg_10"], statistics.fmean(prices[i - 10:i + 1]))
        assert math.isclose(b["rolling_stddev_10"], statistics.stdev(prices[i - 10:i + 1]))
        assert math.isclose(s["rolling_avg_5"], statistics.fmean(prices[i - 4:i + 1]))
        assert math.isclose(s["rolling_avg_10"], statistics.fmean(prices[i - 9:i + 1]))
        assert math.isclose(s["rolling_stddev_10"], statistics.pstdev(prices[i - 9:i + 1]))
        assert b["volume_change"] == float(i % 4) - float((i - 1) % 4)


def test_windows_restart_on_each_date(spark):
    start = EPOCH + DAY - 15_000
    by_date = build_features(ticks(spark, range(1, 31), start=start))
    assert by_date.count() == (15 - 10) * 2
    assert build_features(ticks(spark, range(1, 31), CONTINUOUS, start=start)).count() == 20


def test_zero_previous_price_gives_zero_percent(spark):
    row = build_features(ticks(spark, [1.0] * 9 + [0.0, 5.0])).first()
    assert row["price_change_pct"] == 0.0 and row["price_change"] == 5.0


@pytest.mark.parametrize("ratio, pressure", [
    (1.0, "sell"), (1.01, "buy"), (None, "sell"), (math.nan, "buy"),
])
def test_pressure_and_missing_book(spark, ratio, pressure):
    row = build_features(ticks(spark, range(1, 12), ratio=ratio)).first()
    assert row["market_pressure"] == pressure
    assert (row["spread"], row["total_bid_volume"], row["total_ask_volume"]) == (0.0, 0.0, 0.0)
    if ratio is None:
        assert row["bid_ask_ratio"] == 0.0

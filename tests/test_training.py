import math

import pytest
from pyspark.sql import functions as F

from tickloom.operators import training
from tickloom.operators.evaluate import direction, forecast_errors, prediction_records
from tickloom.operators.models import scaled_without_missing
from tickloom.schemas import BOOK_FILL_COLS, FEATURE_COLS

SCHEMA = "symbol string, timestamp long, " + ", ".join(f"{c} double" for c in FEATURE_COLS)


def table(spark, rows, symbol="BTCUSDT"):
    """Each row maps some features; the others equal the row number."""
    data = [
        (symbol, i, *[row.get(c, float(i)) for c in FEATURE_COLS]) for i, row in enumerate(rows)
    ]
    return spark.createDataFrame(data, SCHEMA)


def test_clean_series(spark):
    bad = [math.inf, -math.inf, math.nan, None]
    rows = [{"size": None, "spread": math.inf}, {"size": 5.0}] + [
        {"size": b, "spread": b, "bid_ask_ratio": b} for b in bad
    ]
    got = training.clean_series(table(spark, rows), blocks=3).orderBy("timestamp").collect()
    assert [r["size"] for r in got] == [0.0, 5.0, 5.0, 5.0, 5.0, 5.0]
    assert [r["spread"] for r in got] == [0.0, 1.0, 0.0, 0.0, 0.0, 0.0]
    assert training.bad_values(training.clean_series(table(spark, rows))).first()[:2] == (0, 0)


def test_prepare_training_limits_then_drops_then_fills(spark):
    rows = [{}, {"price_lag_1": math.nan}, {"spread": math.nan, "bid_ask_ratio": None}]
    got = training.prepare_training(table(spark, rows), rows_per_symbol=2).collect()
    assert [r["timestamp"] for r in got] == [2]
    assert got[0]["spread"] == 0.0 and got[0]["bid_ask_ratio"] == 0.0


def test_scaling_and_its_inverse(spark):
    df = table(spark, [{"size": 3.0}, {"size": 3.0}, {"size": 3.0}])
    scaler = training.fit_scaler(df)
    scaled = training.scale(df, scaler).orderBy("timestamp").collect()
    assert [r["price"] for r in scaled] == [0.0, 0.5, 1.0]
    assert {r["size"] for r in scaled} == {0.0}
    back = training.inverse_scale(training.scale(df, scaler), scaler, {"price": "p"})
    assert sorted(r["p"] for r in back.collect()) == [0.0, 1.0, 2.0]


def test_stored_scaler_is_not_clipped(spark):
    scaler = training.fit_scaler(table(spark, [{}, {}]))
    later = training.scale(table(spark, [{"price": 4.0}]), scaler)
    assert later.first()["price"] == 4.0


def test_inverse_of_a_constant_price(spark):
    df = table(spark, [{"price": 7.0}] * 3)
    scaler = training.fit_scaler(df)
    back = training.inverse_scale(training.scale(df, scaler), scaler, {"price": "p"})
    assert {r["p"] for r in back.collect()} == {7.0}


@pytest.mark.parametrize("rows, expected", [(69, 0), (70, 1)])
def test_minimum_rows(spark, rows, expected):
    assert training.trainable_symbols(table(spark, [{}] * rows)).count() == expected


@pytest.mark.parametrize("rows, blocks", [(61, 1), (60, 2), (150, 4)])
def test_sequences(spark, rows, blocks):
    series = training.order_series(table(spark, [{}] * rows), blocks)
    got = training.build_sequences(series).orderBy("seq_no").collect()
    assert len(got) == max(rows - 60, 0)
    for i, r in enumerate(got):
        assert r["seq_no"] == i + 1 and r["seq_total"] == rows - 60
        assert r["y"] == float(i + 60)
        assert [step[0] for step in r["x"]] == [float(j) for j in range(i, i + 60)]
        assert len(r["x"][0]) == len(FEATURE_COLS)


def test_sequences_with_a_longer_horizon(spark):
    series = training.order_series(table(spark, [{}] * 20), 3)
    got = training.build_sequences(series, length=5, horizon=3).orderBy("seq_no").collect()
    assert len(got) == 13
    assert [s[0] for s in got[0]["x"]] == [0.0, 1.0, 2.0, 3.0, 4.0] and got[0]["y"] == 7.0


def test_split_is_chronological(spark):
    series = training.order_series(table(spark, [{}] * 160), 2)
    split = training.validation_part(training.split_sequences(
        training.index_sequences(series).rows().where("seq_no > 0")))
    counts = {r["part"]: (r["n"], r["first"]) for r in split.groupBy("part").agg(
        F.count("*").alias("n"), F.min("seq_no").alias("first")).collect()}
    assert counts == {"train": (72, 1), "validation": (8, 73), "test": (20, 81)}


def test_walk_forward_folds_are_equal_and_ordered(spark):
    series = training.order_series(table(spark, [{}] * 100), 2)
    folds = training.walk_forward(
        training.index_sequences(series).rows().where("seq_no > 0"), 4)
    got = [(r["fold"], r["n"]) for r in folds.groupBy("fold").agg(F.count("*").alias("n"))
           .orderBy("fold").collect()]
    assert got == [(0, 10), (1, 10), (2, 10), (3, 10)]


def test_symbols_with_missing_scaled_values_are_skipped(spark):
    df = table(spark, [{}]).unionByName(table(spark, [{"size": math.nan}], "ETHUSDT"))
    assert [r["symbol"] for r in scaled_without_missing(df).collect()] == ["BTCUSDT"]


def test_recent_days(spark):
    df = spark.sql("select date_add(date'2024-01-01', cast(id as int)) as date from range(5)")
    assert training.recent_days(df, None).count() == 5
    assert training.recent_days(df, 2).count() == 2


def test_errors_skip_zero_actuals_in_percent(spark):
    df = spark.createDataFrame(
        [("a", 0.0, 1.0), ("a", 10.0, 8.0)], "symbol string, actual double, predicted double")
    row = forecast_errors(df).first()
    assert (row["mae"], row["mape"], row["test_records"]) == (1.5, 20.0, 2)
    assert math.isclose(row["rmse"], math.sqrt(2.5))


def test_a_tie_is_down(spark):
    df = spark.createDataFrame(
        [("a", 1.0, 1.0), ("a", 1.0, 1.00015)],
        "symbol string, current_price double, predicted_price double")
    assert [r["d"] for r in df.select(direction().alias("d")).collect()] == ["DOWN", "UP"]
    record = prediction_records(df, F.lit(5)).collect()[1]
    assert record["timestamp"] == 5 and record["diff"] == pytest.approx(0.0002, abs=1e-4)


def test_book_columns_are_part_of_the_features():
    assert set(BOOK_FILL_COLS) < set(FEATURE_COLS)

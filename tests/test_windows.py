import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.operators import training, windows
from tickloom.plans import daily
from tickloom.schemas import FEATURE_COLS, SEQUENCE_LENGTH
from tickloom.session import materialize
from tickloom.sources import registry

DAY = 86_400_000
SCHEMA = "symbol string, timestamp long, " + ", ".join(f"{c} double" for c in FEATURE_COLS)


def ticks(spark, counts, days=1, seed=0, step=None):
    """Random walks with every feature its own; rows are spread evenly over the days."""
    rng, data = np.random.default_rng(seed), []
    for symbol, n in counts.items():
        values = np.cumsum(rng.normal(size=(n, len(FEATURE_COLS))), axis=0) * 0.1 + rng.normal(size=len(FEATURE_COLS)) * 50
        times = np.arange(n) * (step or days * DAY // n)
        data += [(symbol, int(t), *map(float, row)) for t, row in zip(times, values)]
    return spark.createDataFrame(data, SCHEMA).repartition(5)


def scaled(clean, blocks=4):
    scaler = materialize(training.fit_scaler(clean), "scaler")
    return training.order_series(training.scale(clean, scaler), blocks), scaler


def direct(series, newest, ridge, inputs=None):
    """Least squares with a ridge on the cut windows, by symbol."""
    out = {}
    rows = training.build_sequences(series).where(windows.trained_range(newest)).orderBy("symbol", "seq_no").collect()
    for symbol in {r["symbol"] for r in rows}:
        own = [r for r in rows if r["symbol"] == symbol]
        x, y = np.array([np.array(r["x"]).ravel() for r in own]), np.array([r["y"] for r in own])
        chosen = slice(None) if inputs is None else inputs
        weights = np.zeros(x.shape[1])
        centred = x[:, chosen] - x[:, chosen].mean(axis=0)
        among = centred.T @ centred / len(y) + ridge * np.eye(centred.shape[1])
        weights[chosen] = np.linalg.solve(among, centred.T @ (y - y.mean()) / len(y))
        out[symbol] = (len(y), y.mean() - x.mean(axis=0) @ weights, weights)
    return out


@pytest.fixture(scope="module")
def series(spark):
    return scaled(ticks(spark, {"a": 900, "b": 400, "few": 69, "c": 75}))


@pytest.mark.parametrize("newest, inputs, ridge", [
    (None, None, windows.RIDGE), (100, None, windows.RIDGE), (10_000, [0, 15, 885, 899], 0.0), (3, [885], 1e-3)])
def test_models_are_the_direct_least_squares(series, newest, inputs, ridge):
    found = {r["symbol"]: r for r in windows.fit_windows(series[0], ridge, newest, inputs).collect()}
    wanted = direct(series[0], newest, ridge, inputs)
    assert set(found) == set(wanted) == {"a", "b", "c"}
    for symbol, (n, intercept, weights) in wanted.items():
        assert found[symbol]["windows"] == n
        assert np.allclose(found[symbol]["weights"], weights, atol=1e-7)
        assert found[symbol]["intercept"] == pytest.approx(intercept, abs=1e-7)


def test_optimality_tells_other_models_apart(series):
    used = training.build_sequences(series[0]).where(windows.trained_range(None))
    fitted = materialize(windows.fit_windows(series[0]), "fitted")
    rows = windows.optimality(used, fitted).collect()
    assert len(rows) == 3 and all(r["gradient"] < 1e-9 and r["residual"] < 1e-9 and r["inputs"] == 900 for r in rows)
    other = fitted.withColumn("weights", F.transform("weights", lambda w: w + 1e-4))
    assert all(r["gradient"] > 1e-6 for r in windows.optimality(used, other).collect())


def test_predictions_along_blocks_are_those_of_cut_windows(series):
    fitted = materialize(windows.fit_windows(series[0]), "fitted")
    weights = {r["symbol"]: (r["intercept"], np.array(r["weights"])) for r in fitted.collect()}
    cut = {(r["symbol"], r["seq_no"]): weights[r["symbol"]][0] + weights[r["symbol"]][1] @ np.array(r["x"]).ravel()
           for r in training.build_sequences(series[0]).collect() if r["symbol"] in weights}
    tested = windows.predict_series(series[0], fitted, F.lit(True)).collect()
    assert {(r["symbol"], r["seq_no"]) for r in tested} == set(cut)
    assert all(r["y_hat"] == pytest.approx(cut[r["symbol"], r["seq_no"]], abs=1e-9) for r in tested)
    rows = windows.score_with_table(training.build_sequences(series[0]), fitted)
    assert all(r["y_hat"] == pytest.approx(cut[r["symbol"], r["seq_no"]], abs=1e-9) for r in rows.collect())


def test_scoring_reads_the_windows_once(series):
    cut = materialize(training.build_sequences(series[0]), "cut")
    fitted = materialize(windows.fit_windows(series[0]), "fitted")
    plan = windows.score_with_table(cut, fitted)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2


def test_windows_are_cut_in_parts_and_weighed_in_batches(series):
    """Neither is a row handled anew for each window that holds it, nor a value of a window on its own."""
    fitted = materialize(windows.fit_windows(series[0]), "fitted")
    scored = windows.score_with_table(training.build_sequences(series[0]), fitted)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "lambdafunction" not in plan
    assert "RowFrame, -60" not in plan


def test_scores_of_odd_windows(spark):
    nan, rows = float("nan"), [[1.0, 2.0], [3.0, 4.0]]
    cut = spark.createDataFrame(
        [(0, "a", rows), (1, "a", [[1.0, None], [3.0, 4.0]]), (2, "a", [[1.0, nan], [3.0, 4.0]]), (3, "a", rows[:1]), (4, "a", None),
         (5, "a", [[1.0, 2.0], None]), (6, "twice", rows), (7, "no model", rows), (8, "no weights", rows), (9, "no intercept", rows), (10, None, rows)],
        "id int, symbol string, x array<array<double>>").coalesce(1)
    weights = [1.0, 10.0, 100.0, 1000.0]
    models = spark.createDataFrame(
        [("a", 0.5, weights), ("twice", 0.0, weights), ("twice", 1.0, [0.0, 0.0, 0.0, 1.0]), ("no weights", 1.0, None),
         ("no intercept", None, weights), (None, 1.0, weights)], "symbol string, intercept double, weights array<double>")
    found = windows.score_with_table(cut, models)
    assert found.columns == ["symbol", "id", "y_hat"]
    assert sorted((r["id"], str(r["y_hat"])) for r in found.collect()) == [
        (0, "4321.5"), (1, "None"), (2, "nan"), (3, "None"), (4, "None"), (5, "None"), (6, "4321.0"), (6, "5.0"), (8, "None"), (9, "None")]


def test_optimality_cuts_the_windows_once(series):
    used = training.build_sequences(series[0]).where(windows.trained_range(None))
    fitted = materialize(windows.fit_windows(series[0]), "fitted")
    plan = windows.optimality(used, fitted)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan  # what both sums read is stored


def test_sums_of_a_day_are_taken_once(spark, tmp_path, monkeypatch):
    """The second run has two days more: its models are those of a run from scratch, the old days' sums are kept."""
    counts = {"a": 1500, "b": 1000}
    clean = materialize(ticks(spark, counts, days=5), "clean")
    first = clean.where(F.col("timestamp") < 3 * DAY)

    def run(rows, root, name):
        scaler = registry.save_scaler(training.fit_scaler(rows), root, name)
        series = training.order_series(training.scale(rows, scaler), 3)
        moments = daily.kept_moments(series, rows, root, name, None, scaler)
        return {r["symbol"]: r for r in windows.fit_windows(series, moments=moments).collect()}

    run(first, str(tmp_path / "kept"), "r1")
    again, scratch = run(clean, str(tmp_path / "kept"), "r2"), run(clean, str(tmp_path / "new"), "r2")
    for symbol in counts:
        assert again[symbol]["windows"] == scratch[symbol]["windows"]
        assert np.allclose(again[symbol]["weights"], scratch[symbol]["weights"], atol=1e-6)
    days = {r["run_id"]: r["days"] for r in registry.read_moments(spark, str(tmp_path / "kept")).where("symbol = 'a'")
            .groupBy("run_id").agg(F.sort_array(F.collect_set(F.col("day").cast("string"))).alias("days")).collect()}
    # The first run's range ends within the third day, the second's within the fourth.
    assert days == {"r1": ["1970-01-01", "1970-01-02"], "r2": ["1970-01-03"]}
    changed = clean.withColumn("size", F.when(F.col("timestamp") == 0, F.lit(9.0)).otherwise(F.col("size")))
    run(changed, str(tmp_path / "kept"), "r3")
    redone = registry.read_moments(spark, str(tmp_path / "kept")).where("run_id = 'r3' and symbol = 'a'").select("day").distinct()
    assert sorted(str(r["day"]) for r in redone.collect()) == ["1970-01-01", "1970-01-02"]


def test_label_and_first_row_are_a_window_apart():
    assert SEQUENCE_LENGTH == 60 and len(windows.TERMS) == len(FEATURE_COLS) + 1

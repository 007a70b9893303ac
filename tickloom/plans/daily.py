"""The two batch runs: one date from raw to features, and features to evaluated models."""

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark.ml import Estimator, Pipeline
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.contract import valid_records
from tickloom.operators.dedup import drop_exact_duplicates, unseen, with_hashes
from tickloom.operators.features import CONTINUOUS, build_features, order_ticks
from tickloom.operators.joins import band_join
from tickloom.operators.models import (
    evaluate, evaluate_series, fit_symbol, scaled_without_missing, symbols_with_missing,
    training_status,
)
from tickloom.operators.ordered import Ordered
from tickloom.operators.quality import expectations, observed, observed_step
from tickloom.operators.training import (
    build_sequences, clean_series, fit_scaler, order_series, prepare_training, scale,
    split_sequences, trainable_symbols, validation_part,
)
from tickloom.operators.windows import (
    RIDGE, converted, day_marks, fit_windows, whole_days, window_moments,
)
from tickloom.plans import gates
from tickloom.schemas import (
    BOOK_TOPIC, ROWS_PER_SYMBOL, SEQUENCE_LENGTH, SYMBOLS, TRADE_TOPIC, TRAIN_SHARE,
)
from tickloom.session import folder_names, materialize, scratch_scope
from tickloom.sources import lake, registry

MERGED = "merged"
JOINED = "joined"
FEATURES = "daily"
TRAINING = "training"
FITS_AT_ONCE = 8


def merged_layer(topic: str) -> str:
    return f"{MERGED}/{topic}"


def _merged(lines: DataFrame, topic: str):
    """Records of landed lines without exact copies, and their counts once they are written."""
    checked = lake.checked_lines(lines, topic)
    seen = Observation(f"lines {topic}")
    checked = checked.observe(seen, F.count_if(~F.col("valid")).alias("unreadable"))
    merged, counts = observed_step(valid_records(checked), drop_exact_duplicates, f"merge {topic}")
    return merged, lambda: counts() | {"unreadable": seen.get["unreadable"]}


def _staged_merge(spark: SparkSession, root: str, topic: str, date: str):
    batches = folder_names(spark, lake.raw_day_path(root, topic, date))
    merged, counts = _merged(lake.read_raw_lines(spark, root, topic, date), topic)
    return lake.Staged(merged, root, merged_layer(topic), date), batches, counts


def merge_topic(spark: SparkSession, root: str, topic: str, date: str) -> dict[str, int]:
    """Raw records of a day without exact copies; row counts come from the write itself.

    ``unreadable`` counts the landed lines that are no record, such as lines cut short.
    """
    staged, batches, counts = _staged_merge(spark, root, topic, date)
    staged.publish(batches=batches)
    return counts()


def merge_landed(spark: SparkSession, root: str, topic: str, date: str) -> dict[str, int]:
    """Add what has landed since the last merge of the day; ``files`` counts the batches looked at.

    Only their files are read. Their rows are compared with the hashes of the rows that the layer has
    already, which are made once if a whole merge came before. The result is that of ``merge_topic``.
    """
    layer = merged_layer(topic)
    batches = lake.new_batches(spark, root, topic, date, layer)
    if not batches:
        return {"files": 0, "rows_before": 0, "rows_after": 0, "dropped": 0, "unreadable": 0, "added": 0}
    with scratch_scope(spark):
        rows, counts = _merged(lake.read_landed(spark, root, topic, date, batches), topic)
        hashed = materialize(with_hashes(rows), "landed")
        seen = lake.seen_hashes(spark, root, layer, date)
        if seen is None:
            seen = _first_hashes(spark, root, layer, date)
        fresh = materialize(hashed if seen is None else unseen(hashed, seen), "fresh")
        lake.append_landed(fresh.drop("h1", "h2"), fresh.select("h1", "h2"), root, layer, date, batches)
        return counts() | {"files": len(batches), "added": fresh.count()}


def _first_hashes(spark: SparkSession, root: str, layer: str, date: str) -> DataFrame | None:
    """Hashes of the rows that a whole merge has left, kept from now on; none for a new date."""
    if not lake.has_date(spark, root, layer, date):
        return None
    rows = lake.read_layer(spark, root, layer, date).drop("date")
    return lake.keep_hashes(with_hashes(rows).select("h1", "h2"), root, layer, date)


def run_daily(spark: SparkSession, root: str, date: str) -> dict[str, dict[str, int]]:
    """Raw to features for one date. Rerunning a date replaces it in every layer.

    Each stage's tables are written aside and pass their gates before readers see them, so a run that
    fails leaves what was there.
    """
    with scratch_scope(spark):
        return _run_daily(spark, root, date)


def _run_daily(spark: SparkSession, root: str, date: str) -> dict[str, dict[str, int]]:
    report, staged = {}, {}
    for topic in (TRADE_TOPIC, BOOK_TOPIC):
        gates.raw_files_exist(spark, root, topic, date)
    for topic in (TRADE_TOPIC, BOOK_TOPIC):
        table, batches, counts = _staged_merge(spark, root, topic, date)
        report[topic] = counts()
        staged[topic] = (table, batches)
    for topic, (table, _) in staged.items():
        gates.has_rows(table.read(), f"layer {merged_layer(topic)} for {date}")
    trades, books = (staged[topic][0].read().drop("date") for topic in (TRADE_TOPIC, BOOK_TOPIC))
    ticks = order_ticks(band_join(trades, books), CONTINUOUS)
    joined = lake.Staged(ticks.rows(), root, JOINED, date)
    features, counted = observed(build_features(ticks), "features")
    gates.feature_columns_present(features)
    daily = lake.Staged(features, root, FEATURES, date)
    report[FEATURES] = {"rows": counted.get["rows"]}
    gates.has_rows(daily.read(), f"layer {FEATURES} for {date}")
    for table, batches in staged.values():
        table.publish(batches=batches)
    joined.publish()
    daily.publish()
    return report


def run_training(
    spark: SparkSession,
    root: str,
    run: str,
    rows_per_symbol: int | None = None,
    days: int | None = None,
    estimator: Estimator | None = None,
    fit_on: str = "all",
    fit_rows: int | None = ROWS_PER_SYMBOL,
    expect: bool = False,
) -> DataFrame:
    """Features to models: returns the stored metrics of this run, one row per trained symbol.

    All rows are prepared, scaled and tested on; a regressor is fitted on the newest ``fit_rows``
    training sequences of its symbol (None: all). ``rows_per_symbol`` and ``days`` limit the
    training layer itself. Every symbol gets a status, the skipped ones too. ``expect`` stops the run if the features miss the documented bounds.
    """
    gates.layer_has_rows(spark, root, FEATURES)
    features = lake.read_layer(spark, root, FEATURES).where(F.col("symbol").isin(*SYMBOLS))
    if expect:
        gates.expectations_met(expectations(features))
    with scratch_scope(spark):
        lake.write_table(prepare_training(features, rows_per_symbol, days), root, TRAINING)
        gates.training_layer_usable(spark, root, TRAINING)
        layer = lake.read_layer(spark, root, TRAINING)
        clean = _with_enough_rows(materialize(clean_series(_with_enough_rows(layer)), "clean"))
        metrics = materialize(train_and_evaluate(spark, root, run, clean, estimator, fit_on, fit_rows), "metrics")
        bad = symbols_with_missing(scale(clean, registry.read_scaler(spark, root).where(F.col("run_id") == run).drop("run_id")))
        registry.save_status(training_status([*SYMBOLS], layer, bad, metrics), root, run)
        registry.save_metrics(metrics, root, run)
    return registry.read_metrics(spark, root).where(F.col("run_id") == run).orderBy("symbol")


def _with_enough_rows(rows: DataFrame) -> DataFrame:
    """Rows of the trainable symbols; their list is written, so the join broadcasts it."""
    symbols = materialize(trainable_symbols(rows).select("symbol"), "trainable")
    return rows.join(symbols, "symbol", "left_semi")


def train_and_evaluate(
    spark: SparkSession,
    root: str,
    run: str,
    clean: DataFrame,
    estimator: Estimator | None = None,
    fit_on: str = "all",
    fit_rows: int | None = ROWS_PER_SYMBOL,
    ridge: float = RIDGE,
    inputs: list[int] | None = None,
) -> DataFrame:
    """Scale, fit one model per symbol and measure it on the last sequences.

    By default the models are linear in a window's ``inputs`` with a ``ridge``, fitted for all symbols
    in one pass over the series. An ``estimator`` is fitted symbol by symbol on cut sequences.
    """
    scaler = registry.save_scaler(fit_scaler(_scaler_rows(clean, fit_on)), root, run)
    series = order_series(scaled_without_missing(scale(clean, scaler)))
    if estimator is None:
        moments = kept_moments(series, clean, root, run, fit_rows, scaler)
        fitted = fit_windows(series, ridge, fit_rows, inputs, moments)
        metrics = evaluate_series(series, registry.save_coefficients(fitted, root, run), scaler)
    else:
        metrics = _with_estimator(series, clean, root, run, estimator, fit_rows, scaler)
    return metrics.withColumns({
        "epochs_trained": F.lit(1).cast("long"),
        "trained_at": F.lit(datetime.now(timezone.utc).replace(tzinfo=None).isoformat()),
    })


def kept_moments(
    series: Ordered, clean: DataFrame, root: str, run: str, fit_rows: int | None, scaler: DataFrame,
) -> DataFrame:
    """The sums that models are solved from; those of a day are taken once and kept for later runs.

    A day's sums are used again if all of its sequences train and its rows and those of the day before
    are what they were. They are kept in the units of the first run's scaler.
    """
    spark = series.df.sparkSession
    units = registry.first_scaler(scaler, root)
    days = ["symbol", "day", "rows", "mark", "before"]
    whole = materialize(day_marks(clean).join(whole_days(series, fit_rows), ["symbol", "day"]), "whole-days")
    kept = registry.read_moments(spark, root).join(whole, days)
    first = materialize(kept.groupBy("symbol", "day").agg(F.min("run_id").alias("run_id")), "known-days")
    old = converted(kept.join(first, ["symbol", "day", "run_id"]), units, scaler)
    fresh = materialize(window_moments(series, fit_rows, first), "moments")
    registry.save_moments(converted(fresh, scaler, units).join(whole, ["symbol", "day"]), root, run)
    return materialize(fresh.unionByName(old), "moments")


def _with_estimator(
    series: Ordered, clean: DataFrame, root: str, run: str, estimator: Estimator,
    fit_rows: int | None, scaler: DataFrame,
) -> DataFrame:
    """The symbols are those of the contract, a few; their fits run side by side."""
    # Sequences repeat every row 60 times, so they are cut anew for each fit and never stored.
    split = validation_part(split_sequences(build_sequences(series)))
    symbols = [r["symbol"] for r in trainable_symbols(clean).toLocalIterator()]
    pipeline = Pipeline(stages=[estimator])
    with ThreadPoolExecutor(max_workers=FITS_AT_ONCE) as pool:
        fits = {s: pool.submit(fit_symbol, split, s, pipeline, fit_rows) for s in sorted(symbols)}
        models = {symbol: fit.result() for symbol, fit in fits.items()}
    registry.save_models(models, root, run)
    return evaluate(split, models, scaler)


def _scaler_rows(clean: DataFrame, fit_on: str) -> DataFrame:
    """All rows by default; ``"train"`` leaves out the rows only test sequences see."""
    if fit_on == "all":
        return clean
    ranked = order_series(clean).ranked()
    trained = F.floor((F.col("group_rows") - SEQUENCE_LENGTH) * F.lit(TRAIN_SHARE))
    return ranked.rows().where(F.col("rn") <= trained + SEQUENCE_LENGTH)

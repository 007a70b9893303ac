"""Per-symbol regressors: fit, evaluate, score, and the registry of runs."""

from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators.evaluate import forecast_errors
from tickloom.operators.ordered import Ordered
from tickloom.operators.training import (
    has_missing, inverse_scale, last_trained, trained_sequences,
)
from tickloom.operators.windows import WindowModels, predict_tests, score_with_table
from tickloom.schemas import FEATURE_COLS, MIN_TRAINING_ROWS
from tickloom.session import materialize


def next_price_regressor(reg_param: float = 0.01) -> Estimator:
    return LinearRegression(
        featuresCol="features", labelCol="y", predictionCol="y_hat", regParam=reg_param
    )


def as_vectors(windows: DataFrame) -> DataFrame:
    """Flatten ``x`` (window of feature rows) to one vector per row."""
    return windows.withColumn("features", array_to_vector(F.flatten("x"))).drop("x")


def run_id(now: datetime | None = None) -> str:
    return (now or datetime.now(timezone.utc)).strftime("%Y%m%d_%H%M%S")


def latest_runs(runs: DataFrame) -> DataFrame:
    """The last run of each symbol; run ids sort as text."""
    return runs.groupBy("symbol").agg(F.max("run_id").alias("run_id"))


def symbols_with_missing(scaled: DataFrame) -> DataFrame:
    """Symbols whose scaled features hold a missing value, as a stored table."""
    return materialize(
        scaled.where(has_missing(FEATURE_COLS)).select("symbol").distinct(), "bad-symbols"
    )


def scaled_without_missing(scaled: DataFrame, bad: DataFrame | None = None) -> DataFrame:
    """Symbols whose scaled features hold no missing value; the others are skipped."""
    return scaled.join(symbols_with_missing(scaled) if bad is None else bad, "symbol", "left_anti")


def training_status(
    symbols: list[str], rows: DataFrame, bad: DataFrame, metrics: DataFrame, at_least: int = MIN_TRAINING_ROWS
) -> DataFrame:
    """(symbol, rows, status): what became of each symbol of a training run.

    ``rows`` is the training layer, ``bad`` the symbols with missing scaled values and ``metrics``
    the run's results. Every one of ``symbols`` has a row, also without any data.
    """
    spark = rows.sparkSession
    wanted = spark.createDataFrame([(s,) for s in symbols], "symbol string")
    counts = rows.groupBy("symbol").agg(F.count(F.lit(1)).alias("rows"))
    found = wanted.join(counts, "symbol", "full") \
        .join(bad.select("symbol", F.lit(True).alias("_bad")), "symbol", "left") \
        .join(metrics.select("symbol", F.lit(True).alias("_measured")), "symbol", "left")
    n = F.coalesce("rows", F.lit(0))
    return found.select(
        "symbol", n.cast("long").alias("rows"),
        F.when(n == 0, "no rows").when(n < at_least, "too few rows").when(F.col("_bad"), "missing values")
        .when(F.col("_measured").isNull(), "no usable prediction").otherwise("trained").alias("status"))


def fit_symbol(
    split: DataFrame, symbol: str, estimator: Estimator | None = None, newest: int | None = None
) -> Model:
    """Fit on the symbol's training part, or its ``newest`` sequences; the other parts stay out."""
    train = split.where((F.col("symbol") == symbol) & (F.col("part") == "train"))
    if newest is not None:
        train = train.where(F.col("seq_no") > last_trained() - newest)
    return (estimator or next_price_regressor()).fit(as_vectors(train).select("features", "y"))


def predict_test(split: DataFrame, models: Mapping[str, Model], scaler: DataFrame) -> DataFrame:
    """Actual and predicted test prices of every symbol with a model, in price units."""
    test = split.where(F.col("part") == "test")
    scored = score(test, models).select("symbol", "seq_no", "y", "y_hat")
    return inverse_scale(scored, scaler, {"y": "actual", "y_hat": "predicted"})


def score(windows: DataFrame, models: Mapping[str, Model]) -> DataFrame:
    """Apply each symbol's model to its windows; symbols without a model produce nothing.

    Models in a table are joined to the windows, which are read once whatever their number. Other
    models take one transform each; their number is that of the contract's symbols.
    """
    if isinstance(models, WindowModels):
        scored = score_with_table(windows, models.table)
        return scored.unionByName(score(windows, models.others)) if models.others else scored
    vectors = as_vectors(windows)
    parts = [
        model.transform(vectors.where(F.col("symbol") == symbol))
        for symbol, model in sorted(models.items())
    ]
    if not parts:
        raise ValueError("no model to score with")
    scored = parts[0]
    for part in parts[1:]:
        scored = scored.unionByName(part)
    return scored.drop("features")


def evaluate(split: DataFrame, models: Mapping[str, Model], scaler: DataFrame) -> DataFrame:
    """One metrics row per symbol; symbols with a NaN prediction are skipped."""
    predicted = predict_test(split, models, scaler)
    unusable = F.isnan("predicted") | F.col("predicted").isNull()
    errors = forecast_errors(predicted, F.count_if(unusable).alias("unusable"))
    trained = split.where(F.col("part") != "test").groupBy("symbol").agg(
        F.count(F.lit(1)).alias("train_records")
    )
    return errors.where("unusable = 0").join(trained, "symbol").select(
        "symbol", "mae", "rmse", "mape", "train_records", "test_records"
    )


def evaluate_series(series: Ordered, coefficients: DataFrame, scaler: DataFrame) -> DataFrame:
    """``evaluate`` for models in a table, over the blocks of the scaled series."""
    predicted = predict_tests(series, coefficients, scaler)
    unusable = F.isnan("predicted") | F.col("predicted").isNull()
    errors = forecast_errors(
        predicted, F.count_if(unusable).alias("unusable"), F.max(trained_sequences()).alias("train_records"))
    return errors.where("unusable = 0").select(
        "symbol", "mae", "rmse", "mape", "train_records", "test_records"
    )


def score_windows(windows: DataFrame, models: Mapping[str, Model], scaler: DataFrame) -> DataFrame:
    """Score scaled live windows and return prices in price units."""
    scored = score(windows, models)
    return inverse_scale(scored, scaler, {"y_hat": "predicted_price"}).drop("y_hat")

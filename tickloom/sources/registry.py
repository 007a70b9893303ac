"""Model runs on shared storage: models, their scalers and their metrics, by symbol and run id."""

from pyspark.ml import Model, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.models import latest_runs
from tickloom.operators.windows import MOMENTS, WindowModels
from tickloom.session import folder_names, materialize


def _table(root: str, name: str) -> str:
    return f"{root}/models/{name}"


def model_path(root: str, symbol: str, run: str) -> str:
    return f"{root}/models/fitted/{symbol}/{run}"


def _write_run(df: DataFrame, root: str, name: str, run: str) -> None:
    """Replace this run's rows; a rerun with the same id leaves one copy."""
    (
        df.withColumn("run_id", F.lit(run)).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("run_id")
        .parquet(_table(root, name))
    )


def save_scaler(scaler: DataFrame, root: str, run: str) -> DataFrame:
    _write_run(scaler, root, "scalers", run)
    return read_scaler(scaler.sparkSession, root).where(F.col("run_id") == run).drop("run_id")


def read_scaler(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(
        "symbol string, feature string, min double, max double, run_id string"
    ).parquet(_table(root, "scalers"))


def save_models(models: dict[str, Model], root: str, run: str) -> None:
    for symbol, model in models.items():
        model.write().overwrite().save(model_path(root, symbol, run))


def save_coefficients(coefficients: DataFrame, root: str, run: str) -> DataFrame:
    """Store the run's models of windows, a row for each symbol, and read them back."""
    _write_run(coefficients, root, "coefficients", run)
    return read_coefficients(coefficients.sparkSession, root).where(F.col("run_id") == run).drop("run_id")


def read_coefficients(spark: SparkSession, root: str) -> DataFrame:
    types = "symbol string, windows long, intercept double, weights array<double>, run_id string"
    if "coefficients" not in folder_names(spark, f"{root}/models"):
        return spark.createDataFrame([], types)
    return spark.read.schema(types).parquet(_table(root, "coefficients"))


def read_moments(spark: SparkSession, root: str) -> DataFrame:
    """Sums by symbol and day that earlier runs have kept, in the units of the first run's scaler."""
    types = f"{MOMENTS}, rows long, mark long, before long, run_id string"
    if "moments" not in folder_names(spark, f"{root}/models"):
        return spark.createDataFrame([], types)
    return spark.read.schema(types).parquet(_table(root, "moments"))


def save_moments(moments: DataFrame, root: str, run: str) -> None:
    _write_run(moments, root, "moments", run)


def first_scaler(scaler: DataFrame, root: str) -> DataFrame:
    """The scaler whose units kept sums are in; for a symbol without one ``scaler``, kept from now on."""
    spark = scaler.sparkSession
    if "units" not in folder_names(spark, f"{root}/models"):
        scaler.write.parquet(_table(root, "units"))
        return spark.read.parquet(_table(root, "units"))
    known = spark.read.parquet(_table(root, "units"))
    fresh = materialize(scaler.join(known.select("symbol").distinct(), "symbol", "left_anti"), "new-units")
    if not fresh.isEmpty():
        fresh.write.mode("append").parquet(_table(root, "units"))
        known = spark.read.parquet(_table(root, "units"))
    return known


def save_metrics(metrics: DataFrame, root: str, run: str) -> None:
    """Written last: a run is visible to scoring once its metrics exist."""
    _write_run(metrics, root, "metrics", run)


def read_metrics(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(
        "symbol string, mae double, rmse double, mape double, train_records long,"
        " test_records long, epochs_trained long, trained_at string, run_id string"
    ).parquet(_table(root, "metrics"))


def save_status(status: DataFrame, root: str, run: str) -> None:
    _write_run(status, root, "status", run)


def read_status(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema("symbol string, rows long, status string, run_id string").parquet(_table(root, "status"))


def load_latest(spark: SparkSession, root: str) -> tuple[WindowModels, DataFrame]:
    """The latest model of every symbol that has one, and the scalers those models expect."""
    latest = materialize(latest_runs(read_metrics(spark, root)), "latest-runs")
    rows = materialize(read_coefficients(spark, root).join(latest, ["symbol", "run_id"]), "latest-models")
    # What an estimator has fitted is a file of its own, one for a symbol.
    fitted = {
        row["symbol"]: PipelineModel.load(model_path(root, row["symbol"], row["run_id"]))
        for row in latest.join(rows, ["symbol", "run_id"], "left_anti").toLocalIterator()
    }
    scaler = read_scaler(spark, root).join(latest, ["symbol", "run_id"]).drop("run_id")
    return WindowModels(rows.drop("run_id"), fitted), scaler

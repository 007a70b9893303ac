"""Checks between stages; a failed one stops the run."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tickloom.operators.quality import layer_size, missing_columns
from tickloom.schemas import FEATURE_COLS
from tickloom.sources.footers import footer_profile, footer_rows
from tickloom.sources.lake import layer_folders, layer_path, raw_day_path, read_layer

MIN_TRAINING_BYTES = 1024


class GateError(RuntimeError):
    """A stage's input or output is missing or not as declared."""


def raw_files_exist(spark: SparkSession, root: str, topic: str, date: str) -> int:
    path = raw_day_path(root, topic, date)
    try:
        files = (
            spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
            .select("path").count()
        )
    except AnalysisException:
        files = 0
    if files == 0:
        raise GateError(f"no raw files for {topic} on {date}")
    return files


def layer_has_rows(spark: SparkSession, root: str, layer: str, date: str | None = None) -> None:
    """Of a layer with versions the footers tell, others are looked into."""
    folders = layer_folders(spark, root, layer, date)
    try:
        empty = footer_rows(spark, folders) == 0 if folders else read_layer(spark, root, layer, date).isEmpty()
    except AnalysisException:
        empty = True
    if empty:
        raise GateError(f"layer {layer} has no rows" + (f" for {date}" if date else ""))


def columns_filled(spark: SparkSession, root: str, layer: str, columns: list[str], date: str | None = None) -> None:
    """No null in the columns, by the footers of the layer's files."""
    profile = footer_profile(spark, layer_folders(spark, root, layer, date))
    gaps = {r["column"]: r["nulls"] for r in profile.collect() if r["column"] in columns and r["nulls"]}
    if gaps:
        raise GateError(f"layer {layer} has nulls: {gaps}")


def has_rows(rows: DataFrame, name: str) -> None:
    if rows.isEmpty():
        raise GateError(f"{name} has no rows")


def feature_columns_present(df: DataFrame) -> None:
    missing = missing_columns(df, ["symbol", *FEATURE_COLS])
    if missing:
        raise GateError(f"feature columns missing: {missing}")


def training_layer_usable(spark: SparkSession, root: str, layer: str) -> None:
    try:
        size = layer_size(spark, layer_path(root, layer)).first()
    except AnalysisException:
        raise GateError(f"layer {layer} has no files") from None
    if size["files"] == 0:
        raise GateError(f"layer {layer} has no files")
    if size["bytes"] < MIN_TRAINING_BYTES:
        raise GateError(f"layer {layer} has only {size['bytes']} bytes, too small to train on")


def expectations_met(report: DataFrame) -> None:
    failed = report.where(~F.col("passed")).agg(F.sort_array(F.collect_list("name"))).first()[0]
    if failed:
        raise GateError(f"expectations failed: {failed}")

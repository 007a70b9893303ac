"""Topics to predictions: both topics, their contracts, live scoring, and the prediction topic."""

from collections.abc import Mapping

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tickloom.schemas import BOOK_TOPIC, PREDICTION_TOPIC, TRADE_TOPIC
from tickloom.sources.lake import checked_lines, read_topic
from tickloom.operators.contract import valid_records
from tickloom.streaming.landing import publish_or_keep, resend
from tickloom.streaming.live import prediction_rows, start_live


def valid_topic(
    spark: SparkSession, location: str, topic: str, start: str = "latest", connector: str = "kafka"
) -> DataFrame:
    """A topic's valid records; landing takes care of the others."""
    return valid_records(checked_lines(read_topic(spark, location, topic, start, connector), topic))


def start_predicting(
    spark: SparkSession,
    location: str,
    models: Mapping[str, Model],
    scaler: DataFrame,
    out: str,
    checkpoint: str,
    connector: str = "kafka",
    at: Column | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Score what arrives in the trade and book topics and publish the predictions.

    Predictions are stored under ``out`` too, and a batch that can't be published below
    ``out-errors``, from where it is sent with a later one.
    """
    def send(predictions: DataFrame, batch_id: int) -> None:
        resend(spark, location, PREDICTION_TOPIC, f"{out}-errors", connector)
        publish_or_keep(
            predictions, location, PREDICTION_TOPIC, f"{out}-errors", connector, batch_id)

    return start_live(
        valid_topic(spark, location, TRADE_TOPIC, connector=connector),
        valid_topic(spark, location, BOOK_TOPIC, connector=connector),
        prediction_rows(models, scaler, at=at), out, checkpoint, trigger, send,
    )

"""The daily stages chained as lazy frames, from the derived test streams."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.contracts import book_contract, trade_contract
from tickloom.functions.numbers import event_date
from tickloom.operators.contract import conforming
from tickloom.operators.features import build_features, order_ticks
from tickloom.operators.joins import asof_join, band_join
from tickloom.operators.ordered import Ordered
from tickloom.sources.events import books_of, read_events, trades_of


def valid_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conforming(trades_of(read_events(spark, sf_dir)), trade_contract())


def valid_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conforming(books_of(read_events(spark, sf_dir)), book_contract())


def joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = band_join(valid_trades(spark, sf_dir), valid_books(spark, sf_dir))
    return pairs.withColumn("date", event_date(F.col("timestamp")))


def joined_ticks(spark: SparkSession, sf_dir: str) -> Ordered:
    return order_ticks(joined(spark, sf_dir))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_features(joined_ticks(spark, sf_dir))


def latest_book_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return asof_join(valid_trades(spark, sf_dir), valid_books(spark, sf_dir))


def derived_predictions(trades: DataFrame) -> DataFrame:
    """Forecasts that miss the price by a multiple of 0.25, some of them exactly right."""
    return trades.select(
        "symbol",
        F.col("price").alias("current_price"),
        (F.col("price") + (F.col("trade_id") % 7 - 3) * 0.25).alias("predicted_price"),
        "timestamp",
        "trade_id",
    )

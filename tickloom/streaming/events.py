"""Event-time operators on streams: dedup, interval join, latest price."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.functions.numbers import event_time, whole_seconds
from tickloom.schemas import BOOK_MATCH_COLS


def with_event_time(stream: DataFrame, lateness: str) -> DataFrame:
    return stream.withColumn("event_ts", event_time(F.col("timestamp"))).withWatermark(
        "event_ts", lateness
    )


def late_rows(query: StreamingQuery) -> int:
    """Rows that came after the watermark and are in no result, as far as progress is kept."""
    return sum(
        operator.numRowsDroppedByWatermark
        for progress in query.recentProgress for operator in progress.stateOperators
    )


def dedup_stream(
    stream: DataFrame, keys: tuple[str, ...] = ("symbol", "trade_id"), lateness: str = "10 minutes"
) -> DataFrame:
    """Drop redelivered records that come within ``lateness`` of the first.

    A record later than that is dropped too; ``late_rows`` counts them.
    """
    return with_event_time(stream, lateness).dropDuplicatesWithinWatermark([*keys])


def interval_join(
    trades: DataFrame, books: DataFrame, band: int = 1, lateness: str = "10 seconds"
) -> DataFrame:
    """The band join on streams; a trade without a book comes out once the watermark passes it.

    A book is repeated for the seconds it reaches, so the state is keyed by (symbol, second) and
    a busy symbol is not one task. The range on the event times only tells Spark how long rows
    must stay in the state. Rows later than the watermark are dropped, ``late_rows`` counts them.
    """
    left = with_event_time(trades, lateness).withColumn("second", whole_seconds(F.col("timestamp")))
    second = whole_seconds(F.col("timestamp"))
    right = with_event_time(
        books.select("symbol", "timestamp", *BOOK_MATCH_COLS), lateness
    ).select(
        F.col("symbol").alias("_symbol"),
        F.explode(F.sequence(second - band, second + band)).alias("_second"),
        F.col("timestamp").alias("book_timestamp"),
        F.col("event_ts").alias("book_ts"),
        *BOOK_MATCH_COLS,
    )
    reach = F.expr(f"interval {band + 1} seconds")
    return left.join(
        right,
        (F.col("symbol") == F.col("_symbol"))
        & (F.col("second") == F.col("_second"))
        & (F.col("book_ts") >= F.col("event_ts") - reach)
        & (F.col("book_ts") <= F.col("event_ts") + reach),
        "leftOuter",
    ).select(
        "symbol", "timestamp", "price", "size", *BOOK_MATCH_COLS, "trade_id", "book_timestamp",
    )


def latest_prices(stream: DataFrame) -> DataFrame:
    """Running latest price per symbol, for a complete-mode sink."""
    return stream.groupBy("symbol").agg(
        F.max_by("price", F.struct("timestamp", "trade_id")).alias("price"),
        F.max("timestamp").alias("timestamp"),
    )

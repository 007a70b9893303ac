"""The live chart: prices and predictions of one time as one point, the newest of each symbol in a view."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.schemas import VIEW_POINTS
from tickloom.session import materialize, scratch_scope
from tickloom.streaming.events import with_event_time
from tickloom.streaming.live import LiveState, advance_view

POINT = "symbol string, t long, actual_price double, predicted_price double"
NEWEST = ("t", "actual_price", "predicted_price")
PRICED = "symbol string"


def chart_points(prices: DataFrame, predictions: DataFrame, lateness: str = "10 seconds") -> DataFrame:
    """``symbol, t, actual_price, predicted_price``: both streams in a full outer join on symbol and time.

    The state is keyed by both, so a busy symbol is not one task, and a point without a partner comes
    out when the watermark has passed it. Rows later than that are dropped, ``late_rows`` counts them.
    """
    left = with_event_time(prices.select("symbol", "timestamp", F.col("price").alias("actual_price")), lateness)
    right = with_event_time(predictions.select("symbol", "timestamp", "predicted_price"), lateness).select(
        F.col("symbol").alias("_symbol"), F.col("timestamp").alias("_timestamp"),
        F.col("event_ts").alias("_event_ts"), "predicted_price")
    same = (F.col("symbol") == F.col("_symbol")) & (F.col("event_ts") == F.col("_event_ts"))
    return left.join(right, same, "fullOuter").select(
        F.coalesce("symbol", "_symbol").alias("symbol"), F.coalesce("timestamp", "_timestamp").alias("t"),
        "actual_price", "predicted_price")


def advance_chart(points: DataFrame, batch_id: int, state: LiveState, n: int = VIEW_POINTS) -> None:
    """Fold a micro-batch of points into the newest ``n`` per symbol, and note which symbols have prices."""
    with scratch_scope(points.sparkSession):
        stored = materialize(points, "points")
        priced = stored.where(F.col("actual_price").isNotNull()).select("symbol")
        state.write(batch_id, "priced", state.read(batch_id - 1, "priced", PRICED).unionByName(priced).distinct())
        advance_view(stored, batch_id, state, POINT, NEWEST, n)


def start_chart(
    points: DataFrame, view: str, checkpoint: str, n: int = VIEW_POINTS, trigger: dict | None = None,
) -> StreamingQuery:
    """Keep the chart of a stream of ``chart_points`` under ``view``."""
    state = LiveState(points.sparkSession, view)
    return (
        points.writeStream.foreachBatch(lambda batch, batch_id: advance_chart(batch, batch_id, state, n))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 second"}))
        .start()
    )


def read_chart(spark: SparkSession, view: str) -> DataFrame:
    """The chart after the last finished micro-batch; symbols without a price have none."""
    state = LiveState(spark, view)
    return state.newest("points", POINT).join(state.newest("priced", PRICED), "symbol", "left_semi")

"""Live features and predictions: micro-batches that carry a small state from one to the next.

Events wait in a log until the watermark passes them (see ``reorder``), so they may arrive in any
order. What comes out is in event order, and of the books before the watermark only the last of a
symbol can still be needed. The state of a symbol is that book and its newest ticks, a fixed number.
A micro-batch prepends them to its own rows and runs the batch operators, so a symbol with most of
the traffic is spread over blocks here too; keyed Python state would give it one task.

State and results are written under the number of the step, a micro-batch or the end of a bounded
run. A micro-batch replayed after a failure finds the state of the step before it and replaces its own
first attempt.
"""

from collections.abc import Callable, Mapping

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.operators.evaluate import prediction_records
from tickloom.operators.features import CONTINUOUS, live_features, order_ticks
from tickloom.operators.joins import asof_join
from tickloom.operators.models import score_windows
from tickloom.operators.ordered import Ordered
from tickloom.operators.recent import most_recent
from tickloom.operators.training import live_windows
from tickloom.schemas import BOOK_MATCH_COLS, LONGEST_LAG, SEQUENCE_LENGTH, SYMBOLS, VIEW_POINTS
from tickloom.session import folder_names, make_folder, materialize, scratch_scope
from tickloom.streaming.events import latest_prices
from tickloom.streaming.reorder import CLOCK, RETENTION, Reorder

TICK_COLS = [
    "symbol", "timestamp", "price", "size", "trade_id", "book_timestamp", "spread",
    "bid_ask_ratio", "total_bid_volume", "total_ask_volume",
]
TICK_TYPES = (
    "symbol string, timestamp long, price double, size double, trade_id long,"
    " book_timestamp long, spread double, bid_ask_ratio double, total_bid_volume double,"
    " total_ask_volume double"
)
BOOK_TYPES = "symbol string, timestamp long, " + ", ".join(f"{c} double" for c in BOOK_MATCH_COLS)
CARRIED_TICKS = SEQUENCE_LENGTH + LONGEST_LAG - 1
NEW = "is_new"
BATCH = "_batch"
POINTS = "points"
#: How far behind the newest trade events may arrive on a live run, in milliseconds.
LATENESS = 10_000


def tagged_events(trades: DataFrame, books: DataFrame) -> DataFrame:
    """Both streams as one, told apart by ``kind``; symbols off the list are dropped."""
    known = F.col("symbol").isin(*SYMBOLS)
    return trades.where(known).select(
        F.lit("trade").alias("kind"), "symbol", "timestamp", "price", "size", "trade_id"
    ).unionByName(
        books.where(known).select(
            F.lit("book").alias("kind"), "symbol", "timestamp", *BOOK_MATCH_COLS
        ),
        allowMissingColumns=True,
    )


def merge_batch(
    events: DataFrame, old_ticks: DataFrame, old_books: DataFrame, settled: int | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """New ticks with their latest book, late events, and the books to carry on.

    A trade older than the newest tick already emitted for its symbol is late: it goes to a side
    table and does not change what was emitted. Books newer than a symbol's last trade all stay, of
    the others the last. Later trades come at ``settled`` or after it, so of the books before that
    time too only the last stays.
    """
    seen = old_ticks.groupBy("symbol").agg(F.max("timestamp").alias("_seen"))
    dated = events.join(seen, "symbol", "left")
    late_trade = (F.col("kind") == "trade") & (F.col("timestamp") < F.col("_seen"))
    late = dated.where(late_trade).drop("_seen")
    trades = dated.where((F.col("kind") == "trade") & ~F.coalesce(late_trade, F.lit(False)))
    books = old_books.unionByName(
        events.where(F.col("kind") == "book").select(*old_books.columns)
    )
    merged = asof_join(
        trades.select("symbol", "timestamp", "price", "size", "trade_id"), books
    ).select(*TICK_COLS)
    emitted = seen.unionByName(trades.select("symbol", F.col("timestamp").alias("_seen"))) \
        .groupBy("symbol").agg(F.max("_seen").alias("_last"))
    placed = books.join(emitted, "symbol", "left")
    if settled is not None:
        placed = placed.withColumn("_last", F.greatest("_last", F.lit(settled - 1)))
    ahead = placed.where(F.col("_last").isNull() | (F.col("timestamp") > F.col("_last")))
    record = F.struct("timestamp", *BOOK_MATCH_COLS)
    reached = placed.where(F.col("timestamp") <= F.col("_last")) \
        .groupBy("symbol").agg(F.max(record).alias("r")).select("symbol", "r.*")
    return merged, late, reached.unionByName(ahead.drop("_last"))


class LiveState:
    """The carried rows, in two slots so that the previous batch's stay until the next is done."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _path(self, batch_id: int, table: str) -> str:
        return f"{self.folder}/slot={batch_id % 2}/{table}"

    def read(self, batch_id: int, table: str, types: str) -> DataFrame:
        if batch_id < 0:
            return self.spark.createDataFrame([], types)
        return self.spark.read.schema(types).parquet(self._path(batch_id, table))

    def write(self, batch_id: int, table: str, df: DataFrame) -> None:
        stamped = df.withColumn(BATCH, F.lit(batch_id).cast("long"))
        stamped.write.mode("overwrite").parquet(self._path(batch_id, table))

    def newest(self, table: str, types: str) -> DataFrame:
        """The table after the last finished batch, for readers outside the stream."""
        both = self.spark.read.schema(f"{types}, {BATCH} long") \
            .parquet(f"{self.folder}/slot=*/{table}")
        last = both.agg(F.max(BATCH)).first()[0]
        return both.where(F.col(BATCH) == F.lit(last)).drop(BATCH)


def _write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def advance_view(
    points: DataFrame, batch_id: int, state: LiveState, types: str,
    order: tuple[str, ...], n: int,
) -> None:
    """Fold a micro-batch of points into the view of the newest ``n`` per symbol."""
    with scratch_scope(points.sparkSession):
        old = state.read(batch_id - 1, POINTS, types)
        both = materialize(old.unionByName(points.select(*old.columns)), "points")
        state.write(batch_id, POINTS, most_recent(both, n, order=order))


def start_view(
    points: DataFrame, types: str, view: str, checkpoint: str,
    order: tuple[str, ...] = ("timestamp",), n: int = VIEW_POINTS, trigger: dict | None = None,
) -> StreamingQuery:
    """Keep the newest ``n`` points per symbol of a stream under ``view``."""
    state = LiveState(points.sparkSession, view)
    return (
        points.writeStream.foreachBatch(
            lambda batch, batch_id: advance_view(batch, batch_id, state, types, order, n)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 second"}))
        .start()
    )


def start_latest_prices(
    trades: DataFrame, view: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Keep every symbol's latest price of a stream under ``view``."""
    state = LiveState(trades.sparkSession, view)
    return (
        latest_prices(trades).writeStream.outputMode("complete")
        .foreachBatch(lambda batch, batch_id: state.write(batch_id, POINTS, batch))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 second"}))
        .start()
    )


def read_view(spark: SparkSession, view: str, types: str) -> DataFrame:
    """What a view shows now: its points after the last finished micro-batch."""
    return LiveState(spark, view).newest(POINTS, types)


Emit = Callable[[Ordered], DataFrame]
After = Callable[[DataFrame, int], object]


def advance(
    events: DataFrame, batch_id: int, state: LiveState, out: str, late_out: str, emit: Emit,
    after: After | None = None, behind: DataFrame | None = None, settled: int | None = None,
) -> None:
    """Process one micro-batch: write its results and late events, then the state after it.

    ``after`` gets the written results and the batch number, before the state moves on. ``behind``
    are trades that are late already, ``settled`` the time before which no trade will come.
    """
    spark = events.sparkSession
    with scratch_scope(spark):
        if behind is None:  # else they lie in the log
            events = materialize(events, "events")
        old_ticks = state.read(batch_id - 1, "ticks", TICK_TYPES)
        old_books = state.read(batch_id - 1, "books", BOOK_TYPES)
        if behind is not None and events.isEmpty():
            _write_batch(behind, late_out, batch_id)
            state.write(batch_id, "ticks", old_ticks)
            state.write(batch_id, "books", old_books)
            return
        merged, late, books = merge_batch(events, old_ticks, old_books, settled)
        if behind is not None:
            late = late.unionByName(behind)
        ticks = materialize(
            old_ticks.withColumn(NEW, F.lit(False)).unionByName(
                merged.withColumn(NEW, F.lit(True))
            ),
            "ticks",
        )
        results = emit(order_ticks(ticks, CONTINUOUS)).where(NEW).drop(NEW)
        _write_batch(results, out, batch_id)
        _write_batch(late, late_out, batch_id)
        if after is not None:
            after(spark.read.schema(results.schema).parquet(f"{out}/batch={batch_id}"), batch_id)
        newest = most_recent(
            ticks.drop(NEW), CARRIED_TICKS, order=("timestamp", "trade_id")
        )
        state.write(batch_id, "ticks", newest)
        state.write(batch_id, "books", books)


def feature_rows(convention: str = "batch") -> Emit:
    return lambda ticks: live_features(ticks, convention)


def prediction_rows(
    models: Mapping[str, Model], scaler: DataFrame, convention: str = "batch",
    at: Column | None = None,
) -> Emit:
    """Score every tick that completes a window; ``at`` defaults to the wall clock."""
    clock = at if at is not None else F.unix_millis(F.current_timestamp())

    def emit(ticks: Ordered) -> DataFrame:
        windows = live_windows(ticks, convention=convention, scaler=scaler).where(NEW)
        scored = score_windows(windows, models, scaler)
        return prediction_records(scored, clock).withColumn(NEW, F.lit(True))

    return emit


class LiveQuery:
    """A running live query; a bounded one lets out what still waits when it ends."""

    def __init__(self, query: StreamingQuery, finish: Callable[[], None] | None):
        self._query, self._finish = query, finish

    def awaitTermination(self, timeout: int | None = None) -> bool | None:  # noqa: N802 - as Spark's
        ended = self._query.awaitTermination(timeout)
        if self._finish is not None and (timeout is None or ended):
            finish, self._finish = self._finish, None
            finish()
        return ended

    def __getattr__(self, name: str):
        return getattr(self._query, name)


def start_live(
    trades: DataFrame,
    books: DataFrame,
    emit: Emit,
    out: str,
    checkpoint: str,
    trigger: dict | None = None,
    after: After | None = None,
    lateness: int | None = None,
    patience: int | None = None,
    retention: int = RETENTION,
) -> LiveQuery:
    """Run ``emit`` on both streams in event order; results go to ``out/batch=<step>``.

    Events may arrive in any order within ``lateness`` milliseconds; trades that come later go to
    ``out-late``. By default it is ``LATENESS``, and for a bounded trigger all that the run finds:
    its results then come at its end, when ``awaitTermination`` returns. Books that run more than
    ``retention`` ahead of the trades stop waiting for them. With a ``patience`` what still waits comes
    out after so many milliseconds without any event; the clock for that is one more source, so it
    is to be given on every start with the same checkpoint, or on none, and bounded runs have none.
    """
    spark = trades.sparkSession
    trigger = trigger or {"processingTime": "1 second"}
    bounded = bool(trigger.get("availableNow") or trigger.get("once"))
    state = LiveState(spark, f"{checkpoint}/live-state")
    patience = None if bounded else patience
    order = Reorder(state, lateness if bounded or lateness is not None else LATENESS, patience, retention)
    ends = f"{checkpoint}/live-ends"
    events = tagged_events(trades, books)
    if patience is not None:
        beat = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
        events = events.unionByName(beat.select(
            F.lit(CLOCK).alias("kind"), F.unix_millis("timestamp").alias("timestamp")), allowMissingColumns=True)

    def step(number: int, ready: DataFrame, marks, late: DataFrame) -> None:
        advance(ready, number, state, out, f"{out}-late", emit, after, late, marks.released)
        order.commit(number, marks)

    def process(batch: DataFrame, batch_id: int) -> None:
        # The ends of bounded runs are steps too, so that each step follows the one before it.
        number = batch_id + sum(int(name) < batch_id for name in folder_names(spark, ends))
        ready, late, marks = order.take(batch, number)
        step(number, ready, marks, late)

    def finish() -> None:
        last = order.last_step()
        if last < 0:
            return
        ready, marks = order.drain(last + 1, events.schema)
        if not ready.isEmpty():
            step(last + 1, ready, marks, ready.limit(0))
            make_folder(spark, f"{ends}/{last - len(folder_names(spark, ends))}")

    query = events.writeStream.foreachBatch(process) \
        .option("checkpointLocation", f"{checkpoint}/offsets").trigger(**trigger).start()
    return LiveQuery(query, finish if bounded else None)

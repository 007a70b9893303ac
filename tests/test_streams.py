import contextlib
import json
import os
import time
from pathlib import Path

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tickloom.operators.features import CONTINUOUS, live_features, order_ticks
from tickloom.operators.joins import asof_join, band_join
from tickloom.operators.training import live_windows
from tickloom.session import materialize
from tickloom.sources.events import books_of, read_events, trades_of
from tickloom.sources.lake import read_raw_day, read_topic
from tickloom.streaming import chart, live
from tickloom.streaming.events import dedup_stream, interval_join, late_rows, latest_prices
from tickloom.streaming.flushing import start_flushed
from tickloom.streaming.landing import (
    publish, publish_or_keep, resend, route, start_landing, start_topic_landing, waiting, write_routed,
)
from tickloom.schemas import BOOK_TOPIC, FEATURE_COLS, PREDICTION_TOPIC, SYMBOLS, TRADE, TRADE_TOPIC
from tickloom.streaming.lateness import LateRows, total_late
from tickloom.streaming.predicting import start_predicting
from tickloom.streaming.reorder import Reorder

NOW = {"availableNow": True}
COLS = ["symbol", "timestamp", "trade_id", "price_lag_10", "rolling_avg_10", "spread"]


def in_files(df, folder, bounds):
    """Write ``df`` cut by time into one file per stretch, in order."""
    for i, (low, high) in enumerate(zip(bounds, bounds[1:])):
        part = df.where((F.col("timestamp") >= low) & (F.col("timestamp") < high))
        part.coalesce(1).write.mode("append").parquet(f"{folder}/part={i}")
    return [f"{folder}/part={i}" for i in range(len(bounds) - 1)]


@pytest.fixture(scope="module")
def market(spark):
    base = read_events(spark, "/root/testdata/sf0.001")
    known = F.col("symbol").isin(*SYMBOLS)
    return (
        materialize(trades_of(base).where(known), "test-trades"),
        materialize(books_of(base).where(known), "test-books"),
    )


def stream_of(spark, df, folder):
    return (
        spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1)
        .option("recursiveFileLookup", "true").parquet(folder)
    )


def batch_features(trades, books):
    ticks = asof_join(trades, books)
    return live_features(order_ticks(ticks, CONTINUOUS), "batch")


def rows(df, cols=COLS):
    return sorted(
        tuple(round(v, 6) if isinstance(v, float) else v for v in r)
        for r in df.select(*cols).collect()
    )


def test_live_features_over_many_batches_equal_one_batch(spark, market, tmp_path):
    """Each micro-batch is a stretch of time; the state must bridge all cuts."""
    trades, books = market
    start = trades.agg(F.min("timestamp")).first()[0]
    cuts = [start - 1, start + 3_000, start + 40_000, start + 41_000, start + 200_000, 1 << 60]
    state = live.LiveState(spark, str(tmp_path / "state"))
    for i, (low, high) in enumerate(zip(cuts, cuts[1:])):
        inside = (F.col("timestamp") >= low) & (F.col("timestamp") < high)
        events = live.tagged_events(trades.where(inside), books.where(inside))
        live.advance(events, i, state, f"{tmp_path}/out", f"{tmp_path}/late", live.feature_rows())
        if i == 2:  # a replay after a failure changes nothing
            live.advance(
                events, i, state, f"{tmp_path}/out", f"{tmp_path}/late", live.feature_rows())
    assert rows(spark.read.parquet(f"{tmp_path}/out")) == rows(batch_features(trades, books))
    assert spark.read.parquet(f"{tmp_path}/late").count() == 0


def test_late_trades_go_to_their_own_table(spark, market, tmp_path):
    trades, books = market
    cut = trades.agg(F.min("timestamp")).first()[0] + 100_000
    later, earlier = F.col("timestamp") >= cut, F.col("timestamp") < cut
    state = live.LiveState(spark, str(tmp_path / "state"))
    for i, part in enumerate([later, earlier]):
        live.advance(
            live.tagged_events(trades.where(part), books.where(part)), i, state,
            f"{tmp_path}/out", f"{tmp_path}/late", live.feature_rows())
    assert spark.read.parquet(f"{tmp_path}/late").count() == trades.where(earlier).count()
    out = spark.read.parquet(f"{tmp_path}/out")
    assert out.where("batch = 1").count() == 0


def test_live_query_restarts_where_it_stopped(spark, market, tmp_path):
    trades, books = market
    start = trades.agg(F.min("timestamp")).first()[0]
    # Same cuts for both topics; the second run finds the files that arrived in between.
    bounds = [0, start + 30_000, start + 90_000, 1 << 60]
    for i in range(len(bounds) - 1):
        in_files(trades, f"{tmp_path}/trades-{i}", bounds[i:i + 2])
    in_files(books, f"{tmp_path}/books", [0, 1 << 60])

    def run(upto):
        for i in upto:
            target = tmp_path / "trades"
            target.mkdir(exist_ok=True)
            for file in (tmp_path / f"trades-{i}").rglob("*.parquet"):
                (target / f"{i}-{file.name}").write_bytes(file.read_bytes())
        live.start_live(
            stream_of(spark, trades, str(tmp_path / "trades")),
            spark.readStream.schema(books.schema).option("recursiveFileLookup", "true")
            .parquet(f"{tmp_path}/books"),
            live.feature_rows(), str(tmp_path / "out"), str(tmp_path / "check"), NOW,
        ).awaitTermination()

    run([0])
    first = spark.read.parquet(f"{tmp_path}/out").count()
    run([1, 2])
    out = spark.read.parquet(f"{tmp_path}/out")
    assert 0 < first < out.count()
    # All books come in the first micro-batch, far ahead of most trades.
    cols = [*COLS, *FEATURE_COLS]
    assert rows(out, cols) == rows(batch_features(trades, books), cols)


def tick(spark, times):
    return spark.createDataFrame(
        [("BTCUSDT", t, 1.0 + t, 1.0, t) for t in times],
        "symbol string, timestamp long, price double, size double, trade_id long")


def book(spark, times):
    return spark.createDataFrame(
        [("BTCUSDT", t, 10.0, 10.0 + t, 1.0, 2.0, 2.0) for t in times], live.BOOK_TYPES)


def test_books_ahead_of_trades_are_kept_for_them(spark, tmp_path):
    """Book 80, not the newest book 100, belongs to the trade at 90 of the next micro-batch."""
    state = live.LiveState(spark, str(tmp_path / "state"))
    merged = []
    for i, (trades, books) in enumerate([(range(0, 81, 8), [5, 80, 100]), ([90, 100, 101], []), ([150], [120, 140, 160])]):
        events = live.tagged_events(tick(spark, trades), book(spark, books))
        live.advance(
            events, i, state, f"{tmp_path}/out", f"{tmp_path}/late",
            lambda ticks: ticks.rows(), lambda df, _: merged.extend(df.collect()))
    spreads = {r["timestamp"]: (r["book_timestamp"], r["spread"]) for r in merged}
    assert spreads[80] == (80, 80.0) and spreads[90] == (80, 80.0)
    assert spreads[100] == (100, 100.0) and spreads[101] == (100, 100.0)
    assert spreads[150] == (140, 140.0)
    kept = [r["timestamp"] for r in state.read(2, "books", live.BOOK_TYPES).collect()]
    assert sorted(kept) == [140, 160]


def test_view_shows_the_last_finished_batch_alone(spark, tmp_path):
    types, view = "symbol string, timestamp long, price double", str(tmp_path / "view")
    state = live.LiveState(spark, view)
    for i in range(3):
        points = tick(spark, range(100 * i, 100 * i + 100))
        live.advance_view(points, i, state, types, ("timestamp",), 150)
        shown = sorted(r["timestamp"] for r in live.read_view(spark, view, types).collect())
        assert shown == list(range(max(0, 100 * i - 50), 100 * i + 100))


def test_late_rows_of_dedup_are_counted(spark, tmp_path):
    first = tick(spark, [10_000_000, 10_000_001])
    later = tick(spark, [20_000_000])
    late = tick(spark, [1, 2, 3])
    for i, part in enumerate([first, later, late]):
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(first.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    query = (
        dedup_stream(stream, lateness="1 second").writeStream.format("parquet")
        .option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/check")
        .trigger(**NOW).start())
    query.awaitTermination()
    assert late_rows(query) == 3
    assert spark.read.parquet(f"{tmp_path}/out").count() == 3


@pytest.mark.parametrize("n, expected", [(69, 0), (70, 1), (75, 6)])
def test_windows_start_with_the_seventieth_tick(spark, n, expected):
    ticks = spark.range(n).select(
        F.lit("BTCUSDT").alias("symbol"), (F.col("id") * 10).alias("timestamp"),
        F.col("id").cast("double").alias("price"), F.lit(1.0).alias("size"),
        F.col("id").alias("trade_id"), F.lit(None).cast("long").alias("book_timestamp"),
        *[F.lit(0.0).alias(c) for c in
          ("spread", "bid_ask_ratio", "total_bid_volume", "total_ask_volume")])
    windows = live_windows(order_ticks(ticks, CONTINUOUS, blocks=4)).orderBy("timestamp").collect()
    assert len(windows) == expected
    if expected:
        assert [s[0] for s in windows[0]["x"]] == [float(i) for i in range(10, 70)]
        assert windows[0]["current_price"] == 69.0


def test_stream_dedup(spark, market, tmp_path):
    trades, _ = market
    in_files(trades.unionByName(trades), str(tmp_path / "in"), [0, 1 << 60])
    out = dedup_stream(stream_of(spark, trades, str(tmp_path / "in")))
    (out.writeStream.format("parquet").option("path", str(tmp_path / "out"))
     .option("checkpointLocation", str(tmp_path / "check")).trigger(**NOW).start()
     .awaitTermination())
    assert spark.read.parquet(str(tmp_path / "out")).count() == trades.count()


def test_stream_interval_join_equals_the_batch_join(spark, market, tmp_path):
    trades, books = market
    far = 10_000_000_000
    for name, df in (("t", trades), ("b", books)):
        flush = df.limit(1).withColumn("timestamp", F.col("timestamp") + far)
        in_files(df.unionByName(flush), str(tmp_path / name), [0, 1 << 60])
    joined = interval_join(
        stream_of(spark, trades, str(tmp_path / "t")),
        stream_of(spark, books, str(tmp_path / "b")))
    (joined.writeStream.format("parquet").option("path", str(tmp_path / "out"))
     .option("checkpointLocation", str(tmp_path / "check")).trigger(**NOW).start()
     .awaitTermination())
    got = spark.read.parquet(str(tmp_path / "out")).where(F.col("timestamp") < 1_800_000_000_000)
    cols = ["symbol", "timestamp", "trade_id", "book_timestamp", "top_bid_price"]
    key = lambda df: sorted(map(str, df.select(*cols).collect()))
    assert key(got) == key(band_join(trades, books))


def record(**changes):
    base = {"symbol": "BTCUSDT", "price": 1.0, "size": 1.0, "timestamp": 1_704_067_200_000,
            "trade_id": 1}
    return json.dumps(base | changes)


def test_landing_splits_valid_and_dead_letters(spark, tmp_path):
    source = tmp_path / "topics" / "crypto-prices"
    source.mkdir(parents=True)
    good, extra, bad = record(), record(venue="x", price="2.5"), record(price=-1)
    (source / "1.txt").write_text("\n".join([good, extra, bad, "{broken"]) + "\n")

    def run():
        start_landing(
            read_topic(spark, str(tmp_path / "topics"), "crypto-prices", connector="files"),
            "crypto-prices", str(tmp_path / "lake"), str(tmp_path / "check"), NOW,
        ).awaitTermination()

    run()
    (source / "2.txt").write_text(record(trade_id=2) + "\n")
    run()
    landed = spark.read.text(str(tmp_path / "lake"))
    raw = [r["value"] for r in landed.where("zone = 'raw'").collect()]
    assert sorted(raw) == sorted([good, extra, record(trade_id=2)])
    errors = landed.where("zone = 'errors'")
    assert {r["topic"] for r in errors.collect()} == {"crypto-prices-dlq"}
    letters = [json.loads(r["value"]) for r in errors.collect()]
    assert sorted(letter["error"] for letter in letters) == [
        "price: price must be positive", "record: not a JSON object"]
    day = landed.first()
    date = f"{day['year']}-{int(day['month']):02d}-{int(day['day']):02d}"
    read = read_raw_day(spark, str(tmp_path / "lake"), "crypto-prices", date)
    assert read.schema == TRADE and read.count() == 3


def test_writing_a_batch_again_replaces_it(spark, tmp_path):
    messages = spark.createDataFrame([(record(),), (record(price=-1),)], "value string").withColumn(
        "ingested_at", F.timestamp_seconds(F.lit(1_704_067_200)))
    for _ in range(2):
        write_routed(route(messages, "crypto-prices"), str(tmp_path), "q-0")
    write_routed(route(messages, "crypto-prices"), str(tmp_path), "q-1")
    assert spark.read.text(str(tmp_path)).count() == 4


def test_dead_letter_topics_land_untouched(spark):
    messages = spark.createDataFrame([("anything",)], "value string").withColumn(
        "ingested_at", F.current_timestamp())
    row = route(messages, "crypto-prices-dlq").first()
    assert (row["zone"], row["topic"], row["value"]) == (
        "errors", "crypto-prices-dlq", "anything")


def test_publish_and_its_failure(spark, tmp_path):
    df = spark.createDataFrame([("BTCUSDT", 1.5)], "symbol string, price double")
    publish(df, str(tmp_path), "crypto-predictions", connector="files")
    assert json.loads(spark.read.text(f"{tmp_path}/crypto-predictions").first()[0]) == {
        "symbol": "BTCUSDT", "price": 1.5}
    assert not publish_or_keep(df, "nowhere:1", "t", f"{tmp_path}/errors")  # no Kafka connector
    kept = spark.read.parquet(f"{tmp_path}/errors").first()
    assert json.loads(kept["original_payload"])["symbol"] == "BTCUSDT"
    for _ in range(2):  # a batch that is sent or kept again replaces itself
        publish(df, str(tmp_path), "again", "files", 7)
        publish_or_keep(df, "nowhere:1", "t", f"{tmp_path}/kept", batch_id=7)
    assert spark.read.text(f"{tmp_path}/again").count() == 1
    assert spark.read.parquet(f"{tmp_path}/kept").count() == 1


class LastPrice:
    """Stands for a fitted model: the last scaled price of the window."""

    def transform(self, df):
        last = vector_to_array("features")[59 * len(FEATURE_COLS)]
        return df.withColumn("y_hat", last)


def test_topics_to_published_predictions(spark, tmp_path):
    topics = tmp_path / "topics"
    for topic in (TRADE_TOPIC, BOOK_TOPIC):
        (topics / topic).mkdir(parents=True)
    lines = [record(timestamp=1_704_067_200_000 + 10 * i, trade_id=i, price=str(1.0 + i)) for i in range(72)]
    (topics / TRADE_TOPIC / "1.txt").write_text("\n".join([*lines, record(price=-1), "{cut"]) + "\n")
    (topics / BOOK_TOPIC / "1.txt").write_text("{}\n")
    bounds = [("BTCUSDT", c, 0.0, 100.0) for c in FEATURE_COLS]
    scaler = spark.createDataFrame(bounds, "symbol string, feature string, min double, max double")
    start_predicting(
        spark, str(topics), {"BTCUSDT": LastPrice()}, scaler, f"{tmp_path}/out", f"{tmp_path}/check",
        "files", F.col("timestamp"), NOW).awaitTermination()
    sent = [json.loads(r["value"]) for r in spark.read.text(f"{topics}/{PREDICTION_TOPIC}").collect()]
    assert sorted(round(s["current_price"], 6) for s in sent) == [70.0, 71.0, 72.0]
    assert all(abs(s["current_price"] - s["predicted_price"]) < 1e-9 for s in sent)


def test_latest_prices_stream(spark, market, tmp_path):
    trades, _ = market
    in_files(trades, str(tmp_path / "in"), [0, 1 << 60])
    (latest_prices(stream_of(spark, trades, str(tmp_path / "in"))).writeStream
     .outputMode("complete").format("memory").queryName("latest_prices_test")
     .trigger(**NOW).start().awaitTermination())
    got = {r["symbol"]: r["timestamp"] for r in spark.table("latest_prices_test").collect()}
    wanted = trades.groupBy("symbol").agg(F.max("timestamp").alias("t")).collect()
    assert got == {r["symbol"]: r["t"] for r in wanted}




def live_run(spark, folder, trades, books, **more):
    return live.start_live(
        stream_of(spark, trades, f"{folder}/trades"), stream_of(spark, books, f"{folder}/books"),
        live.feature_rows(), f"{folder}/out", f"{folder}/check", **more)


def arriving(df, folder, bounds, order):
    """Write one file per stretch of time, with modification times in the given order."""
    for i in order:
        part = df.where((F.col("timestamp") >= bounds[i]) & (F.col("timestamp") < bounds[i + 1]))
        part.coalesce(1).write.mode("append").parquet(f"{folder}/part={i}")
    now = time.time() - 1000
    for place, i in enumerate(order):
        for file in Path(f"{folder}/part={i}").glob("*.parquet"):
            os.utime(file, (now + place, now + place))


@pytest.mark.parametrize("lateness", [None, 500_000])
def test_files_in_the_wrong_order_give_the_rows_of_the_batch_run(spark, market, tmp_path, lateness):
    trades, books = market
    start = trades.agg(F.min("timestamp")).first()[0]
    bounds = [0, start + 30_000, start + 90_000, start + 200_000, 1 << 60]
    arriving(trades, f"{tmp_path}/trades", bounds, [2, 0, 3, 1])
    arriving(books, f"{tmp_path}/books", bounds, [3, 1, 0, 2])
    live_run(spark, tmp_path, trades, books, trigger=NOW, lateness=lateness).awaitTermination()
    cols = [*COLS, *FEATURE_COLS]
    assert rows(spark.read.parquet(f"{tmp_path}/out"), cols) == rows(batch_features(trades, books), cols)
    assert spark.read.parquet(f"{tmp_path}/out-late").count() == 0


def test_only_what_comes_behind_the_watermark_is_late(spark, market, tmp_path):
    trades, books = market
    start = trades.agg(F.min("timestamp")).first()[0]
    bounds = [0, start + 30_000, start + 90_000, start + 200_000, 1 << 60]
    arriving(trades, f"{tmp_path}/trades", bounds, [0, 2, 1, 3])
    arriving(books, f"{tmp_path}/books", [0, 1 << 60], [0])
    live_run(spark, tmp_path, trades, books, trigger=NOW, lateness=20_000).awaitTermination()
    # The third stretch comes second and takes the watermark past all of the second.
    late = [r["timestamp"] for r in spark.read.parquet(f"{tmp_path}/out-late").collect()]
    inside = trades.where((F.col("timestamp") >= bounds[1]) & (F.col("timestamp") < bounds[2])).count()
    assert 0 < len(late) <= inside and all(bounds[1] <= t < bounds[2] for t in late)
    on_time = trades.join(spark.read.parquet(f"{tmp_path}/out-late").select("trade_id"), "trade_id", "left_anti")
    assert rows(spark.read.parquet(f"{tmp_path}/out")) == rows(batch_features(on_time, books))


def test_the_second_run_takes_what_the_first_has_left(spark, market, tmp_path):
    """A trade of the last millisecond is not late, books ahead of the trades are kept."""
    _, books = market
    ticks = tick(spark, range(0, 200))
    for i, (low, high) in enumerate([(0, 100), (99, 200)]):
        part = ticks.where((F.col("timestamp") >= low) & (F.col("timestamp") < high))
        part = part.withColumn("trade_id", F.col("trade_id") + 1000 * i)
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/trades")
        if not i:
            book(spark, [5, 80, 150]).coalesce(1).write.parquet(f"{tmp_path}/books")
        live_run(spark, tmp_path, ticks, book(spark, [1]), trigger=NOW).awaitTermination()
    both = spark.read.parquet(f"{tmp_path}/trades")
    assert rows(spark.read.parquet(f"{tmp_path}/out")) == rows(batch_features(both, book(spark, [5, 80, 150])))
    assert spark.read.parquet(f"{tmp_path}/out-late").count() == 0


def live_schema(spark):
    return live.tagged_events(tick(spark, [1]), book(spark, [1])).schema


def test_books_without_trades_leave_a_state_of_bounded_size(spark, tmp_path):
    """Twenty micro-batches; what comes out of them is one book a symbol for the state."""
    state = live.LiveState(spark, str(tmp_path / "state"))
    order = Reorder(state, 1_000, retention=5_000)
    parts, last = [], None
    for i in range(20):
        events = live.tagged_events(tick(spark, []), book(spark, range(1000 * i, 1000 * i + 1000, 100)).coalesce(1))
        ready, _, marks = order.take(events, i)
        order.commit(i, marks)
        parts.append(len(list((tmp_path / "state" / "log").iterdir())))
        last = ready
    assert max(parts[10:]) == max(parts[16:]) < 12 and len(marks.parts) < 8
    old = book(spark, [0, 10])
    _, _, books = live.merge_batch(last, spark.createDataFrame([], live.TICK_TYPES), old, marks.released)
    assert [r["timestamp"] for r in books.collect()] == [marks.released - 100]


def test_a_step_that_runs_again_changes_nothing(spark, market, tmp_path):
    trades, books = market
    start = trades.agg(F.min("timestamp")).first()[0]
    state = live.LiveState(spark, str(tmp_path / "state"))
    order = Reorder(state, 5_000)
    cuts = [start - 1, start + 50_000, start + 120_000, 1 << 60]
    for i, (low, high) in enumerate(zip(cuts, cuts[1:])):
        inside = (F.col("timestamp") >= low) & (F.col("timestamp") < high)
        for _ in range(2 if i == 1 else 1):
            ready, late, marks = order.take(live.tagged_events(trades.where(inside), books.where(inside)), i)
            live.advance(
                ready, i, state, f"{tmp_path}/out", f"{tmp_path}/late", live.feature_rows(), None, late, marks.released)
            order.commit(i, marks)
    ready, marks = order.drain(3, live_schema(spark))
    live.advance(ready, 3, state, f"{tmp_path}/out", f"{tmp_path}/late", live.feature_rows(), None, ready.limit(0), marks.released)
    assert rows(spark.read.parquet(f"{tmp_path}/out")) == rows(batch_features(trades, books))


def test_what_waits_comes_out_after_a_silence(spark, tmp_path):
    ticks = tick(spark, range(0, 200, 10))
    ticks.coalesce(1).write.parquet(f"{tmp_path}/trades")
    book(spark, [5]).coalesce(1).write.parquet(f"{tmp_path}/books")
    query = live_run(spark, tmp_path, ticks, book(spark, [1]), lateness=60_000, patience=3_000)
    try:
        deadline, found = time.time() + 90, 0
        while found < 10 and time.time() < deadline:
            time.sleep(1)
            with contextlib.suppress(AnalysisException):
                found = spark.read.parquet(f"{tmp_path}/out").count()
        assert found == 10
    finally:
        query.stop()


def test_late_rows_are_counted_over_more_batches_than_progress_is_kept_for(spark, tmp_path):
    """Every file after the first is late."""
    tick(spark, [10_000_000]).coalesce(1).write.parquet(f"{tmp_path}/in")
    now = time.time() - 10_000
    first = next((tmp_path / "in").glob("*.parquet"))
    os.utime(first, (now, now))
    tick(spark, [20_000_000]).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    late = tmp_path / "late"
    tick(spark, [1, 2, 3]).coalesce(1).write.parquet(str(late))
    body = next(late.glob("*.parquet")).read_bytes()
    for i in range(14):
        file = tmp_path / "in" / f"late-{i}.parquet"
        file.write_bytes(body)
        os.utime(file, (time.time() + i, time.time() + i))
    listener = LateRows(spark, f"{tmp_path}/counts")
    spark.streams.addListener(listener)
    settings = {"spark.sql.shuffle.partitions": "1", "spark.sql.streaming.numRecentProgressUpdates": "5"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        stream = spark.readStream.schema(tick(spark, [1]).schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        query = dedup_stream(stream, lateness="1 second").writeStream.format("noop") \
            .option("checkpointLocation", f"{tmp_path}/check").trigger(**NOW).start()
        query.awaitTermination()
        deadline = time.time() + 60
        while total_late(spark, f"{tmp_path}/counts", query) < 42 and time.time() < deadline:
            time.sleep(1)
        assert total_late(spark, f"{tmp_path}/counts", query) == 42 > late_rows(query)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
        spark.streams.removeListener(listener)


def test_chart_points_without_a_partner_come_out_when_the_watermark_has_passed(spark, tmp_path):
    prices = tick(spark, [1_000, 2_000, 2_000, 3_000, 90_000_000])
    predictions = spark.createDataFrame(
        [("BTCUSDT", 2_000, 5.0), ("BTCUSDT", 2_500, 6.0), ("ETHUSDT", 2_000, 7.0), ("BTCUSDT", 90_000_000, 8.0)],
        "symbol string, timestamp long, predicted_price double")
    for name, df in (("prices", prices), ("predictions", predictions)):
        in_files(df, f"{tmp_path}/{name}", [0, 2_400, 1 << 60])
    points = chart.chart_points(
        stream_of(spark, prices, f"{tmp_path}/prices"), stream_of(spark, predictions, f"{tmp_path}/predictions"))
    chart.start_chart(points, f"{tmp_path}/view", f"{tmp_path}/check", 4, NOW).awaitTermination()
    found = sorted((r["t"], r["actual_price"], r["predicted_price"]) for r in chart.read_chart(spark, f"{tmp_path}/view").collect())
    # The four newest of BTCUSDT; ETHUSDT has no price. Rows at the end still wait unless they met.
    assert found == [(2_000, 2_001.0, 5.0), (2_500, None, 6.0), (3_000, 3_001.0, None), (90_000_000, 90_000_001.0, 8.0)]


def test_a_sink_that_fails_twice_has_each_record_once_in_the_end(spark, tmp_path):
    got, failures, errors = [], iter([1, 2]), f"{tmp_path}/errors"

    def sink(messages, batch_id):
        if next(failures, None):
            raise OSError("away")
        got.extend((batch_id, r["key"], r["value"]) for r in messages.collect())

    batches = [spark.createDataFrame([("BTCUSDT", float(i)), ("ETHUSDT", float(i))], "symbol string, price double")
               for i in range(4)]
    assert not publish_or_keep(batches[0], "", "t", errors, sink, 0)
    assert resend(spark, "", "t", errors, sink) == [] and waiting(spark, errors) == [0]
    assert publish_or_keep(batches[1], "", "t", errors, sink, 1)
    assert resend(spark, "", "t", errors, sink) == [0] and resend(spark, "", "t", errors, sink) == []
    assert sorted(b for b, _, _ in got) == [0, 0, 1, 1] and len({k for _, k, _ in got}) == 4
    kept = spark.read.parquet(errors)  # marks are no rows
    assert kept.count() == 2 and waiting(spark, errors) == []
    assert (tmp_path / "errors" / "_sent" / "0").read_text() == "3"


def lines_file(folder, name, first, n):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{name}.txt").write_text("".join(record(trade_id=i) + "\n" for i in range(first, first + n)))


def landed_in(folder):
    """Records of each flush."""
    return sorted(sum(len(f.read_text().splitlines()) for f in d.glob("*.txt")) for d in Path(folder).rglob("batch=flush-*"))


def test_files_are_flushed_when_they_are_many_or_at_the_end_of_a_run(spark, tmp_path):
    topic = tmp_path / "topics" / TRADE_TOPIC
    now = time.time() - 100
    for i, n in enumerate([3, 4, 5, 2]):
        lines_file(topic, i, 10 * i, n)
        os.utime(topic / f"{i}.txt", (now + i, now + i))

    def run():
        reader = spark.readStream.option("maxFilesPerTrigger", 1).text(str(topic))
        start_flushed(
            reader, lambda messages, name: write_routed(route(messages, TRADE_TOPIC), f"{tmp_path}/lake", f"flush-{name}"),
            f"{tmp_path}/check", 7, 3_600_000, NOW).awaitTermination()
    run()
    assert landed_in(f"{tmp_path}/lake") == [7, 7]  # 3 + 4, and 5 + 2
    lines_file(topic, 9, 90, 1)
    run()
    assert landed_in(f"{tmp_path}/lake") == [1, 7, 7]
    ids = [json.loads(r["value"])["trade_id"] for r in spark.read.text(f"{tmp_path}/lake").collect()]
    assert len(ids) == len(set(ids)) == 15


def test_old_messages_are_flushed_without_new_ones(spark, tmp_path):
    lines_file(tmp_path / "topics" / TRADE_TOPIC, 0, 0, 3)
    query = start_topic_landing(
        spark, f"{tmp_path}/topics", TRADE_TOPIC, f"{tmp_path}/lake", f"{tmp_path}/check", "files", records=1000, age=3_000)
    try:
        deadline = time.time() + 60
        while landed_in(f"{tmp_path}/lake") != [3] and time.time() < deadline:
            time.sleep(0.5)
        assert landed_in(f"{tmp_path}/lake") == [3]
    finally:
        query.stop()

"""One query per operator over the driver's tables: ``name -> (spark, sf_dir) -> DataFrame``."""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.contracts import book_contract, trade_contract
from tickloom.operators import (
    contract, dedup, evaluate, features, joins, models, parse, quality, recent, training, views,
    windows,
)
from tickloom.plans import daily, market
from tickloom.schemas import (
    BOOK, BOOK_TOPIC, FEATURE_COLS, PREDICTION_TOPIC, SEQUENCE_LENGTH, TRADE, TRADE_TOPIC,
)
from tickloom.session import materialize, scratch_path
from tickloom.sources import events as ev
from tickloom.sources import footers, lake, registry
from tickloom.streaming import events as stream_ops
from tickloom.streaming import chart, landing, live

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

TOP_N = 500
TICK_KEY = ["symbol", "timestamp", "trade_id", "book_timestamp"]
TRADE_ORDER = ("timestamp", "trade_id")


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def fixed(column: str | Column, digits: int = 6) -> Column:
    """Rounded by plain double arithmetic, which gives the same in every SQL engine."""
    unit = float(10 ** digits)
    value = F.col(column) if isinstance(column, str) else column
    return F.floor(value * unit + 0.5) / unit


def _rounded(df: DataFrame) -> DataFrame:
    """All doubles to 6 digits, deviations (summed in engine order) to 4."""
    return df.select(*[
        fixed(f.name, 4 if "stddev" in f.name else 6).alias(f.name)
        if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in df.schema
    ])


def _depth_sums(df: DataFrame) -> DataFrame:
    """Each depth array as its number of levels and its prices and quantities, weighted by level."""
    def weighted(side: str, field: int) -> Column:
        parts = F.transform(side, lambda level, i: level[field] * (i + 1))
        return fixed(F.aggregate(parts, F.lit(0.0), lambda total, x: total + x), 3)

    sums = {}
    for side in ("bid_depth", "ask_depth"):
        sums |= {f"{side}_levels": F.size(side), f"{side}_prices": weighted(side, 0),
                 f"{side}_quantities": weighted(side, 1)}
    return df.withColumns(sums).drop("bid_depth", "ask_depth")


def _date_text(df: DataFrame) -> DataFrame:
    return df.withColumn("date", F.col("date").cast("string"))


# --- parsing ---

@query
def parse_trades(spark, sf_dir):
    return _rounded(parse.parse_trades(ev.trade_messages(ev.read_events(spark, sf_dir))))


@query
def parse_depth(spark, sf_dir):
    books = parse.parse_depth(ev.depth_messages(ev.read_events(spark, sf_dir)))
    return _rounded(_depth_sums(parse.parsed_ok(books)))


@query
def parse_depth_status(spark, sf_dir):
    books = parse.parse_depth(ev.depth_messages(ev.read_events(spark, sf_dir)))
    return books.groupBy("symbol", "parse_status").agg(F.count(F.lit(1)).alias("messages"))


@query
def book_totals(spark, sf_dir):
    books = ev.books_of(ev.read_events(spark, sf_dir))
    return _rounded(books.select(
        "symbol",
        "timestamp",
        parse.total_quantity(F.col("bid_depth")).alias("bid_total"),
        parse.total_quantity(F.col("ask_depth")).alias("ask_total"),
    ))


# --- contracts ---

def _checked_trades(spark, sf_dir):
    trades = ev.spoiled_trades(ev.trades_of(ev.read_events(spark, sf_dir)))
    return contract.check(trades, trade_contract())


def _checked_books(spark, sf_dir):
    books = ev.spoiled_books(ev.books_of(ev.read_events(spark, sf_dir)))
    return contract.check(books, book_contract())


def _letters(letters: DataFrame, schema: T.StructType) -> DataFrame:
    """Envelopes with the received record, which is in ``raw``, in its fields."""
    read = letters.select(
        "topic", "error", F.col("timestamp").alias("seen_at"), "original_payload",
        F.from_json("raw", schema).alias("r"))
    return _rounded(read.select("topic", "error", "seen_at", "original_payload", "r.*"))


@query
def contract_trade_valid(spark, sf_dir):
    return _rounded(contract.valid_records(_checked_trades(spark, sf_dir)))


@query
def contract_trade_dlq(spark, sf_dir):
    checked = _checked_trades(spark, sf_dir)
    return _letters(contract.dead_letters(checked, "crypto-prices-dlq"), TRADE)


@query
def contract_orderbook_valid(spark, sf_dir):
    return _rounded(_depth_sums(contract.valid_records(_checked_books(spark, sf_dir))))


@query
def contract_orderbook_dlq(spark, sf_dir):
    checked = _checked_books(spark, sf_dir)
    return _depth_sums(_letters(contract.dead_letters(checked, "crypto-orderbook-dlq"), BOOK))


@query
def contract_violation_counts(spark, sf_dir):
    trades = contract.violation_counts(_checked_trades(spark, sf_dir))
    books = contract.violation_counts(_checked_books(spark, sf_dir))
    return trades.withColumn("entity", F.lit("trade")).unionByName(
        books.withColumn("entity", F.lit("book"))
    )


# --- dedup and concatenation ---

@query
def dedup_exact(spark, sf_dir):
    trades = ev.with_copies(ev.trades_of(ev.read_events(spark, sf_dir)), "trade_id")
    return _rounded(dedup.drop_exact_duplicates(trades))


@query
def dedup_books(spark, sf_dir):
    books = ev.with_copies(ev.books_of(ev.read_events(spark, sf_dir)), "timestamp", every=4000)
    return _rounded(_depth_sums(dedup.drop_exact_duplicates(books)))


@query
def dedup_report(spark, sf_dir):
    trades = ev.with_copies(ev.trades_of(ev.read_events(spark, sf_dir)), "trade_id")
    return dedup.dedup_report(trades)


@query
def union_parts(spark, sf_dir):
    trades = ev.trades_of(ev.read_events(spark, sf_dir))
    small = trades.where("size < 5.0")
    rest = trades.where("size >= 5.0").select(*reversed(trades.columns))
    return _rounded(dedup.union_parts([small, rest]))


# --- joins ---

@query
def band_join(spark, sf_dir):
    return _rounded(_date_text(market.joined(spark, sf_dir)))


@query
def join_quality(spark, sf_dir):
    return _rounded(quality.join_quality(market.joined(spark, sf_dir)))


@query
def asof_join(spark, sf_dir):
    return _rounded(market.latest_book_ticks(spark, sf_dir))


# --- features ---

@query
def lag_features(spark, sf_dir):
    table = market.features(spark, sf_dir)
    return _rounded(table.select(
        *TICK_KEY, "price", "price_lag_1", "price_lag_5", "price_lag_10",
        "price_change", "price_change_pct", "volume_change",
    ))


@query
def features_by_date(spark, sf_dir):
    """The windows begin anew on each date: here the date changes after 100 seconds of data."""
    joined = market.joined(spark, sf_dir).withColumn("date", F.when(
        F.col("timestamp") < ev.START_MS + 100_000, F.col("date")).otherwise(F.date_add("date", 1)))
    table = features.build_features(features.order_ticks(joined))
    return _rounded(_date_text(table.select(
        *TICK_KEY, "date", "price", "price_lag_1", "price_lag_10", "rolling_avg_5",
        "rolling_avg_10", "volume_change",
    )))


@query
def rolling_features(spark, sf_dir):
    table = market.features(spark, sf_dir)
    return _rounded(table.select(
        *TICK_KEY, "rolling_avg_5", "rolling_avg_10", "rolling_stddev_10"
    ))


@query
def feature_projection(spark, sf_dir):
    return _rounded(market.features(spark, sf_dir).drop("date"))


@query
def serving_features(spark, sf_dir):
    ticks = features.order_ticks(market.latest_book_ticks(spark, sf_dir), features.CONTINUOUS)
    return _rounded(features.live_features(ticks))


# --- reports and gates ---

@query
def null_counts(spark, sf_dir):
    return quality.null_counts(market.joined(spark, sf_dir))


@query
def nan_counts(spark, sf_dir):
    return quality.nan_counts(_with_gaps(market.features(spark, sf_dir)))


@query
def profile_joined(spark, sf_dir):
    return quality.profile(market.joined(spark, sf_dir).drop("date"))


@query
def symbol_distribution(spark, sf_dir):
    return quality.symbol_distribution(ev.trades_of(ev.read_events(spark, sf_dir)))


@query
def price_range(spark, sf_dir):
    return _rounded(quality.price_range(training.prepare_training(_series(spark, sf_dir))))


@query
def quality_expectations(spark, sf_dir):
    return _rounded(quality.expectations(market.features(spark, sf_dir)))


@query
def sample_rows(spark, sf_dir):
    return _rounded(quality.sample_rows(
        market.valid_trades(spark, sf_dir), ["timestamp", "trade_id"]
    ))


@query
def missing_columns(spark, sf_dir):
    """Required feature columns that the joined table does not have yet."""
    joined = market.joined(spark, sf_dir)
    absent = quality.missing_columns(joined, ["symbol", *FEATURE_COLS])
    return joined.agg(*[F.count(F.lit(1)).alias(c) for c in absent]).unpivot(
        [], absent, "column", "rows_without"
    )


@query
def dropped_rows(spark, sf_dir):
    """Rows a cleaning step drops, counted while its result is written."""
    gappy = _with_gaps(_series(spark, sf_dir))
    cleaned, counts = quality.observed_step(gappy, training.drop_incomplete, "dropped_rows")
    written = materialize(cleaned, "cleaned")
    return written.groupBy("symbol").agg(F.count(F.lit(1)).alias("kept")).withColumns(
        {name: F.lit(rows).cast("long") for name, rows in counts().items()}
    )


# --- training rows ---

def _with_gaps(table: DataFrame, infinite: bool = True) -> DataFrame:
    """Put nulls, NaN and (or else null) infinities into some features, by trade id."""
    infinity = float("inf") if infinite else None

    def put(column: str, every: int, bad: float | None) -> Column:
        return F.when(F.col("trade_id") % every == 0, F.lit(bad)).otherwise(F.col(column))

    return table.withColumns({
        "size": put("size", 17, None),
        "price_change": put("price_change", 13, float("nan")),
        "rolling_avg_5": put("rolling_avg_5", 11, infinity),
        "bid_ask_ratio": put("bid_ask_ratio", 7, float("nan")),
        "spread": put("spread", 19, infinity),
    })


def _series(spark, sf_dir):
    """Training columns of the feature table, stored once as the daily run does."""
    table = market.features(spark, sf_dir)
    return materialize(table.select(*training.training_columns(table)), "features")


@query
def top_n_recent(spark, sf_dir):
    rows = _series(spark, sf_dir)
    return _rounded(recent.most_recent(rows, TOP_N, order=tuple(training.tick_order(rows))))


@query
def clean_training(spark, sf_dir):
    gappy = _with_gaps(_series(spark, sf_dir), infinite=False)
    return _rounded(training.prepare_training(gappy))


@query
def ffill_features(spark, sf_dir):
    return _rounded(training.clean_series(_with_gaps(_series(spark, sf_dir))))


@query
def residual_bad_values(spark, sf_dir):
    rows = _with_gaps(_series(spark, sf_dir))
    before = training.bad_values(rows).withColumn("stage", F.lit("before"))
    after = training.bad_values(training.clean_series(rows)).withColumn("stage", F.lit("after"))
    return before.unionByName(after)


@query
def scaler_fit(spark, sf_dir):
    return _rounded(training.fit_scaler(_series(spark, sf_dir)))


def _scaled(spark, sf_dir):
    rows = _series(spark, sf_dir)
    scaler = materialize(training.fit_scaler(rows), "scaler")
    return rows, scaler, training.scale(rows, scaler)


@query
def scaled_features(spark, sf_dir):
    _, _, scaled = _scaled(spark, sf_dir)
    return scaled.select(*TICK_KEY, *[fixed(c, 4).alias(c) for c in FEATURE_COLS])


@query
def inverse_scale(spark, sf_dir):
    _, scaler, scaled = _scaled(spark, sf_dir)
    back = training.inverse_scale(scaled, scaler, {"price": "restored_price"})
    return back.select(*TICK_KEY, fixed("restored_price").alias("restored_price"))


@query
def trainable_symbols(spark, sf_dir):
    return training.trainable_symbols(_series(spark, sf_dir))


@query
def sequences(spark, sf_dir):
    built = training.build_sequences(training.order_series(_series(spark, sf_dir)))
    return _rounded(built.select(
        "symbol", "seq_no", "seq_total", "timestamp", "y",
        F.size("x").alias("steps"),
        F.col("x")[0][0].alias("first_price"),
        F.col("x")[59][0].alias("last_price"),
        F.col("x")[30][14].alias("middle_ask_volume"),
        *_window_sums("price", "total_ask_volume"),
    ))


def _window_sums(*names: str) -> list[Column]:
    """The sum of a feature over all rows of a window, to 3 digits."""
    def total(name: str) -> Column:
        at = FEATURE_COLS.index(name)
        return F.aggregate("x", F.lit(0.0), lambda s, row: s + row[at])
    return [fixed(total(n), 3).alias(f"{n}_sum") for n in names]


@query
def train_test_split(spark, sf_dir):
    index = training.index_sequences(training.order_series(_series(spark, sf_dir)))
    split = training.validation_part(
        training.split_sequences(index.rows().where("seq_no > 0"))
    )
    return split.groupBy("symbol", "part").agg(
        F.count(F.lit(1)).alias("sequences"),
        F.min("seq_no").alias("first_seq"),
        F.max("seq_no").alias("last_seq"),
    )


@query
def walk_forward(spark, sf_dir):
    index = training.index_sequences(training.order_series(_series(spark, sf_dir)))
    folds = training.walk_forward(index.rows().where("seq_no > 0"), 5)
    return folds.groupBy("symbol", F.col("fold").cast("long").alias("fold")).agg(
        F.count(F.lit(1)).alias("sequences"), F.max("seq_no").alias("last_seq")
    )


@query
def live_windows(spark, sf_dir):
    ticks = features.order_ticks(market.latest_book_ticks(spark, sf_dir), features.CONTINUOUS)
    windows = training.live_windows(ticks)
    return _rounded(windows.select(
        "symbol", "timestamp", "trade_id", "current_price",
        F.size("x").alias("steps"),
        F.col("x")[0][0].alias("first_price"),
        F.col("x")[59][0].alias("last_price"),
        *_window_sums("price", "total_bid_volume"),
    ))


# --- forecasts ---

@query
def eval_metrics(spark, sf_dir):
    forecast = training.persistence_forecast(training.order_series(_series(spark, sf_dir)))
    test = training.split_sequences(forecast).where("part = 'test'")
    return _rounded(evaluate.forecast_errors(test))


@query
def prediction_records(spark, sf_dir):
    predictions = market.derived_predictions(market.valid_trades(spark, sf_dir))
    return _rounded(evaluate.prediction_records(predictions, F.col("timestamp")))


@query
def latest_model_run(spark, sf_dir):
    runs = ev.read_events(spark, sf_dir).select(
        "symbol", F.date_format("ts", "yyyyMMdd_HHmmss").alias("run_id")
    )
    return models.latest_runs(runs)


# --- serving views ---

@query
def latest_price(spark, sf_dir):
    return _rounded(recent.latest_value(
        market.valid_trades(spark, sf_dir), "price", order=TRADE_ORDER
    ))


@query
def last_200(spark, sf_dir):
    points = views.last_points(market.valid_trades(spark, sf_dir), TRADE_ORDER)
    return _rounded(points.select("symbol", "timestamp", "price"))


@query
def top_200(spark, sf_dir):
    trades = market.valid_trades(spark, sf_dir)
    return _rounded(recent.newest(trades, 200, TRADE_ORDER).select("symbol", "timestamp", "price"))


def _predictions(spark, sf_dir):
    derived = market.derived_predictions(market.valid_trades(spark, sf_dir))
    return evaluate.prediction_records(derived, F.col("timestamp"))


@query
def recent_predictions(spark, sf_dir):
    return _rounded(views.recent_predictions(_predictions(spark, sf_dir), ("timestamp",)))


def _some_later(predictions: DataFrame) -> DataFrame:
    """Predictions that go up come 100 ms after their price."""
    up = F.col("direction") == "UP"
    return predictions.withColumn(
        "timestamp", F.when(up, F.col("timestamp") + 100).otherwise(F.col("timestamp")))


@query
def chart_outer_join(spark, sf_dir):
    predictions = _some_later(_predictions(spark, sf_dir))
    return _rounded(views.chart(market.valid_trades(spark, sf_dir), predictions))


@query
def live_board(spark, sf_dir):
    return views.live_board(market.valid_trades(spark, sf_dir), _predictions(spark, sf_dir))


# --- models ---

RUN = "20240101_000000"


#: The last scaled price of a window; a line through it is what SQL can fit too.
LAST_PRICE = [(SEQUENCE_LENGTH - 1) * len(FEATURE_COLS) + FEATURE_COLS.index("price")]


def _trained_root(spark, sf_dir) -> str:
    """Train on the derived features under a scratch root; returns the root."""
    root = scratch_path(spark, "models")
    rows = training.prepare_training(_series(spark, sf_dir))
    clean = materialize(training.clean_series(rows), "clean")
    metrics = daily.train_and_evaluate(spark, root, RUN, clean, ridge=0.0, inputs=LAST_PRICE)
    registry.save_metrics(metrics, root, RUN)
    return root


def _scaled_series(spark, sf_dir):
    rows = training.prepare_training(_series(spark, sf_dir))
    clean = materialize(training.clean_series(rows), "clean")
    scaler = materialize(training.fit_scaler(clean), "scaler")
    return training.order_series(training.scale(clean, scaler))


#: Added before rounding, so that sums that are exact halves don't stand on its edge.
OFF_EDGE = 0.0001234


@query
def window_moments(spark, sf_dir):
    """What all models are solved from: sums of lagged products over the training windows."""
    moments = windows.window_moments(_scaled_series(spark, sf_dir))
    return moments.select(
        "symbol", F.col("day").cast("string").alias("day"), "lag", "term",
        *[fixed(F.col(t) + OFF_EDGE, 3).alias(t) for t in windows.TERMS])


@query
def fit_all_inputs(spark, sf_dir):
    """Models on all inputs of a window, with how far they are from the least squares: not at all."""
    series = _scaled_series(spark, sf_dir)
    fitted = materialize(windows.fit_windows(series), "fitted")
    used = training.build_sequences(series).where(windows.trained_range(None))
    return windows.optimality(used, fitted).select(
        "symbol", "inputs", "windows", fixed("residual").alias("residual"),
        fixed("gradient").alias("gradient"))


def _coarse(predictions: DataFrame) -> DataFrame:
    """Predictions to 3 digits: two fits of one line differ in the last bits."""
    return predictions.withColumns({
        "current_price": fixed("current_price"), "predicted_price": fixed("predicted_price", 3),
        "diff": fixed("diff", 3)})


@query
def fit_and_evaluate(spark, sf_dir):
    metrics = registry.read_metrics(spark, _trained_root(spark, sf_dir)).drop("trained_at")
    return metrics.withColumns({c: fixed(c, 4) for c in ("mae", "rmse", "mape")})


@query
def score_batch(spark, sf_dir):
    fitted, scaler = registry.load_latest(spark, _trained_root(spark, sf_dir))
    ticks = features.order_ticks(market.latest_book_ticks(spark, sf_dir), features.CONTINUOUS)
    complete = training.live_windows(ticks, convention="batch", scaler=scaler)
    scored = models.score_windows(complete, fitted, scaler)
    return _coarse(evaluate.prediction_records(scored, F.col("timestamp")))


# --- the lake ---

DATE = "2024-01-01"


def _landed_day(spark, sf_dir) -> str:
    """A lake with the derived topics landed on one day, copies included; returns its root.

    Some trades send numbers as text or have a field that no one declared, and some lines are
    stored once more, cut short.
    """
    root = scratch_path(spark, "lake")
    base = ev.read_events(spark, sf_dir)
    day = F.timestamp_millis(F.lit(ev.START_MS))
    trades = ev.with_copies(ev.trades_of(base), "trade_id")
    text = F.to_json(F.struct(
        "symbol", "size", "timestamp", "trade_id", F.lit("x").alias("venue"),
        F.col("price").cast("string").alias("price")))
    sent = trades.select("trade_id", F.when(F.col("trade_id") % 5 == 0, text).otherwise(
        F.to_json(F.struct(*trades.columns))).alias("value"), day.alias("ingested_at"))
    landing.write_routed(landing.route(sent.drop("trade_id"), TRADE_TOPIC), root, "q-0")
    cut = sent.where(F.col("trade_id") % 29 == 0).select(
        F.substring("value", 1, 30).alias("value"), "ingested_at",
        F.lit("raw").alias("zone"), F.lit(TRADE_TOPIC).alias("topic"))
    landing.write_routed(cut, root, "q-1")
    books = ev.books_of(base).select(F.to_json(F.struct("*")).alias("value"), day.alias("ingested_at"))
    landing.write_routed(landing.route(books, BOOK_TOPIC), root, "q-0")
    return root


@query
def merge_raw_day(spark, sf_dir):
    """Landed text to the merged layer; ``unreadable`` counts the lines that were cut short."""
    root = _landed_day(spark, sf_dir)
    report = daily.merge_topic(spark, root, TRADE_TOPIC, DATE)
    merged = lake.read_layer(spark, root, daily.merged_layer(TRADE_TOPIC), DATE)
    return _rounded(merged.select(*TRADE.names)).withColumn(
        "unreadable", F.lit(report["unreadable"]).cast("long"))


@query
def dedup_incremental(spark, sf_dir):
    """The merged layer after three landings that repeat each other's records, merged one by one."""
    root = scratch_path(spark, "lake")
    day = F.timestamp_millis(F.lit(ev.START_MS))
    trades = ev.with_copies(ev.trades_of(ev.read_events(spark, sf_dir)), "trade_id")
    for i in range(3):
        part = trades.where(F.col("trade_id") % 3 != i)
        sent = part.select(F.to_json(F.struct("*")).alias("value"), day.alias("ingested_at"))
        landing.write_routed(landing.route(sent, TRADE_TOPIC), root, f"q-{i}")
        daily.merge_landed(spark, root, TRADE_TOPIC, DATE)
    merged = lake.read_layer(spark, root, daily.merged_layer(TRADE_TOPIC), DATE)
    return _rounded(merged.select(*TRADE.names))


@query
def footer_profile(spark, sf_dir):
    """Rows, nulls and bounds of the joined layer's columns from the footers of its files."""
    root = scratch_path(spark, "lake")
    lake.write_table(market.joined(spark, sf_dir).drop("date"), root, daily.JOINED)
    found = footers.footer_profile(spark, lake.layer_folders(spark, root, daily.JOINED))
    return found.where(F.col("column").isin("symbol", "timestamp", "price", "top_bid_price", "trade_id"))


@query
def daily_layers(spark, sf_dir):
    """Rows of every layer after the daily run, which passed its gates."""
    root = _landed_day(spark, sf_dir)
    daily.run_daily(spark, root, DATE)
    layers = [daily.merged_layer(TRADE_TOPIC), daily.merged_layer(BOOK_TOPIC), daily.JOINED, daily.FEATURES]
    counts = [
        lake.read_layer(spark, root, layer, DATE).agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("layer", F.lit(layer)) for layer in layers]
    return reduce(DataFrame.unionByName, counts)


# --- streams, each run to the end of the available data ---

AVAILABLE = {"availableNow": True}


def _run_to_table(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    out = scratch_path(spark, name)
    (
        stream.writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", scratch_path(spark, f"{name}-offsets"))
        .trigger(**AVAILABLE).start().awaitTermination()
    )
    return spark.read.schema(stream.schema).parquet(out)


def _stream(spark, sf_dir, flush: bool = False, disorder: int = 0) -> DataFrame:
    return ev.stream_events(
        spark, sf_dir, scratch_path(spark, "arriving"), flush, disorder=disorder)


@query
def stream_contract_split(spark, sf_dir):
    """What lands where, by the routed text."""
    trades = ev.spoiled_trades(ev.trades_of(_stream(spark, sf_dir)))
    root = scratch_path(spark, "lake")
    landing.start_landing(
        trades.select(F.to_json(F.struct("*")).alias("value")), TRADE_TOPIC, root,
        scratch_path(spark, "landing"), AVAILABLE,
    ).awaitTermination()
    landed = spark.read.text(root)
    raw = F.when(F.col("zone") == "raw", F.col("value")) \
        .otherwise(F.get_json_object("value", "$.raw"))
    read = landed.select(
        "zone", "topic", F.get_json_object("value", "$.error").alias("error"),
        F.get_json_object("value", "$.topic").alias("from_topic"),
        F.from_json(raw, TRADE).alias("r"))
    return _rounded(read.select("zone", "topic", "error", "from_topic", "r.*"))


@query
def stream_dedup(spark, sf_dir):
    trades = ev.with_copies(ev.trades_of(_stream(spark, sf_dir)), "trade_id")
    unique = stream_ops.dedup_stream(trades).drop("event_ts")
    return _rounded(_run_to_table(spark, unique, "stream-dedup"))


@query
def stream_interval_join(spark, sf_dir):
    base = _stream(spark, sf_dir, flush=True)
    trades = contract.conforming(ev.trades_of(base), trade_contract())
    books = contract.conforming(ev.books_of(base), book_contract())
    table = _run_to_table(spark, stream_ops.interval_join(trades, books), "stream-join")
    far = ev.START_MS + ev.FAR_EVENTS * ev.STEP_MS
    return _rounded(table.where(F.col("timestamp") < far))


#: Places that events arrive out of order, and the lateness in milliseconds that covers them.
DISORDER, COVERED = 100, 60_000


@query
def stream_features(spark, sf_dir):
    """From shuffled arrivals; the rows are those of the batch run."""
    base = _stream(spark, sf_dir, disorder=DISORDER)
    out = scratch_path(spark, "live-features")
    live.start_live(
        ev.trades_of(base),
        contract.conforming(ev.books_of(base), book_contract()),
        live.feature_rows(), out, scratch_path(spark, "live"), AVAILABLE, lateness=COVERED,
    ).awaitTermination()
    return _rounded(spark.read.parquet(out).drop("batch"))


@query
def stream_scoring(spark, sf_dir):
    fitted, scaler = registry.load_latest(spark, _trained_root(spark, sf_dir))
    base = _stream(spark, sf_dir)
    out = scratch_path(spark, "live-predictions")
    live.start_live(
        ev.trades_of(base), ev.books_of(base),
        live.prediction_rows(fitted, materialize(scaler, "scaler"), at=F.col("timestamp")),
        out, scratch_path(spark, "live"), AVAILABLE, lateness=COVERED,
    ).awaitTermination()
    return _coarse(spark.read.parquet(out).drop("batch"))


@query
def stream_publish(spark, sf_dir):
    """Predictions sent to a file topic and read back from it."""
    trades = contract.conforming(ev.trades_of(_stream(spark, sf_dir)), trade_contract())
    records = evaluate.prediction_records(market.derived_predictions(trades), F.col("timestamp"))
    topics = scratch_path(spark, "topics")
    landing.start_publishing(
        records, topics, PREDICTION_TOPIC, scratch_path(spark, "errors"),
        scratch_path(spark, "publishing"), "files", AVAILABLE,
    ).awaitTermination()
    sent = spark.read.text(f"{topics}/{PREDICTION_TOPIC}")
    return _rounded(sent.select(F.from_json("value", records.schema).alias("r")).select("r.*"))


@query
def stream_resend(spark, sf_dir):
    """Predictions through a topic that fails twice, then all of them once."""
    trades = contract.conforming(ev.trades_of(_stream(spark, sf_dir)), trade_contract())
    records = evaluate.prediction_records(market.derived_predictions(trades), F.col("timestamp"))
    topics, errors, failures = scratch_path(spark, "topics"), scratch_path(spark, "errors"), iter([1, 2])

    def sink(messages: DataFrame, batch_id: int) -> None:
        if next(failures, None):
            raise OSError("the topic is away")
        messages.select("value").write.mode("overwrite").text(f"{topics}/batch={batch_id}")

    landing.start_publishing(
        records, "", PREDICTION_TOPIC, errors, scratch_path(spark, "publishing"), sink, AVAILABLE,
    ).awaitTermination()
    landing.resend(spark, "", PREDICTION_TOPIC, errors, sink)
    sent = spark.read.text(topics)
    return _rounded(sent.select(F.from_json("value", records.schema).alias("r")).select("r.*"))


@query
def stream_latest_price(spark, sf_dir):
    trades = contract.conforming(ev.trades_of(_stream(spark, sf_dir)), trade_contract())
    view = scratch_path(spark, "latest")
    live.start_latest_prices(
        trades, view, scratch_path(spark, "latest-offsets"), AVAILABLE).awaitTermination()
    return _rounded(live.read_view(spark, view, "symbol string, price double, timestamp long"))


@query
def stream_last_points(spark, sf_dir):
    trades = contract.conforming(ev.trades_of(_stream(spark, sf_dir)), trade_contract())
    view, types = scratch_path(spark, "view"), "symbol string, timestamp long, price double"
    live.start_view(
        trades, types, view, scratch_path(spark, "view-offsets"), trigger=AVAILABLE
    ).awaitTermination()
    return _rounded(live.read_view(spark, view, types))


@query
def stream_chart(spark, sf_dir):
    """The chart as both topics have left it; the flush is no part of it."""
    base = _stream(spark, sf_dir, flush=True)
    trades = contract.conforming(ev.trades_of(base), trade_contract())
    records = evaluate.prediction_records(market.derived_predictions(trades), F.col("timestamp"))
    points = chart.chart_points(trades, _some_later(records)).where(
        F.col("t") < ev.START_MS + ev.FAR_EVENTS * ev.STEP_MS)
    view = scratch_path(spark, "chart")
    chart.start_chart(points, view, scratch_path(spark, "chart-offsets"), trigger=AVAILABLE).awaitTermination()
    return _rounded(chart.read_chart(spark, view))

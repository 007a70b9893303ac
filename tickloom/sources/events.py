"""Market streams derived from the ``events`` test table.

Events are minutes apart, so time is compressed to one event per 400 ms; two event types stand
for order-book snapshots, the others for trades. Unknown symbols stay in, for the contracts.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.numbers import computed_once
from tickloom.session import files_arrive_in_order

# --- fixed values: derivation of test streams ---
START_MS = 1_704_067_200_000
STEP_MS = 400
BOOK_EVENTS = ("purchase", "signup")
DERIVED_SYMBOLS = ("BTCUSDT", "ETHUSDT", "SOLUSDT", "XYZUSDT")
BOOK_LEVELS = 20
FAR_EVENTS = 25_000_000
# --- end of fixed values ---

EVENTS = (
    "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
)


def base_events(events: DataFrame) -> DataFrame:
    user = F.col("user_id")
    index = F.when(user % 20 == 19, 4).otherwise((user % 3 + 1).cast("int"))
    number = F.get_json_object("props", "$.k").cast("long")
    return computed_once(events, "k", number).select(
        "event_id",
        "event_type",
        "value",
        "k",
        F.element_at(F.array(*[F.lit(s) for s in DERIVED_SYMBOLS]), index).alias("symbol"),
        (F.col("event_id") * STEP_MS + START_MS).alias("ts_ms"),
        "ts",
    )


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base_events(spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet"))


def stream_events(
    spark: SparkSession, sf_dir: str, folder: str, flush: bool = False,
    batches: int = 5, ahead: int = 50, disorder: int = 0,
) -> DataFrame:
    """All events as a stream that arrives under ``folder`` in about ``batches`` micro-batches.

    Books come ``ahead`` events before the trades of their time, as a topic that runs ahead, and
    with ``disorder`` every event up to so many places later than its time. The arrivals are
    written in as many files as a shuffle has partitions, at least one for each micro-batch. With ``flush``
    the last of them repeats some events ``FAR_EVENTS`` later, which moves watermarks past all others.
    """
    events = spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")
    early = F.when(F.col("event_type").isin(*BOOK_EVENTS), F.lit(ahead)).otherwise(F.lit(0))
    held = F.pmod(F.xxhash64("event_id"), F.lit(disorder + 1)) if disorder else F.lit(0)
    arriving = events.withColumn("arrival", F.col("event_id") - early + held)
    if flush:
        far = events.where(F.col("event_id") % 10 == 0).withColumn("event_id", F.col("event_id") + FAR_EVENTS)
        arriving = arriving.unionByName(far.withColumn("arrival", F.col("event_id")))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    each = -(-partitions // batches)
    arriving.repartitionByRange(each * batches, "arrival").sortWithinPartitions("arrival") \
        .drop("arrival").write.parquet(folder)
    files_arrive_in_order(spark, folder)
    return base_events(
        spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", each).parquet(folder)
    )


def trades_of(base: DataFrame) -> DataFrame:
    return base.where(~F.col("event_type").isin(*BOOK_EVENTS)).select(
        "symbol",
        F.col("value").alias("price"),
        ((F.col("k") + 1) / 10.0).alias("size"),
        F.col("ts_ms").alias("timestamp"),
        F.col("event_id").alias("trade_id"),
    )


def books_of(base: DataFrame, levels: int = BOOK_LEVELS) -> DataFrame:
    top = base.where(F.col("event_type").isin(*BOOK_EVENTS)).select(
        "symbol",
        F.col("ts_ms").alias("timestamp"),
        F.col("value").alias("top_bid_price"),
        (F.col("value") + (F.col("k") - 5) / 100.0).alias("top_ask_price"),
        ((F.col("k") + 1) * 20.0).alias("total_bid_volume"),
        (((F.col("k") * 7) % 100 + 1) * 20.0).alias("total_ask_volume"),
    )

    def depth(price: str, total: str, step: float):
        return F.transform(
            F.sequence(F.lit(0), F.lit(levels - 1)),
            lambda i: F.array(F.col(price) + i * F.lit(step), F.col(total) / 20.0),
        )

    return top.select(
        "symbol",
        "timestamp",
        "top_bid_price",
        (F.col("total_bid_volume") / 20.0).alias("top_bid_qty"),
        "top_ask_price",
        (F.col("total_ask_volume") / 20.0).alias("top_ask_qty"),
        depth("top_bid_price", "total_bid_volume", -0.01).alias("bid_depth"),
        depth("top_ask_price", "total_ask_volume", 0.01).alias("ask_depth"),
        "total_bid_volume",
        "total_ask_volume",
        (F.col("total_bid_volume") / F.col("total_ask_volume")).alias("bid_ask_ratio"),
    )


def with_copies(df: DataFrame, id_column: str, every: int = 10) -> DataFrame:
    """Add an exact copy of every tenth record, as a redelivered message would."""
    return df.unionByName(df.where(F.col(id_column) % every == 0))


def spoiled_trades(trades: DataFrame) -> DataFrame:
    """Break some records, one way per remainder of the id, for the contract to find."""
    kind = F.col("trade_id") % 53
    return trades.select(
        "symbol",
        F.when(kind == 7, -F.col("price")).otherwise(F.col("price")).alias("price"),
        F.when(kind.isin(7, 11), F.lit(0.0)).otherwise(F.col("size")).alias("size"),
        F.when(kind == 13, F.lit(999).cast("long")).otherwise(F.col("timestamp"))
        .alias("timestamp"),
        F.when(kind == 17, F.lit(None)).otherwise(F.col("trade_id")).alias("trade_id"),
    )


def spoiled_books(books: DataFrame) -> DataFrame:
    kind = F.call_function("div", F.col("timestamp"), F.lit(STEP_MS)) % 53
    return books.withColumns({
        "top_bid_price": F.when(kind.isin(3, 5), F.lit(-1.0)).otherwise(F.col("top_bid_price")),
        "top_ask_price": F.when(kind == 5, F.lit(-2.0)).otherwise(F.col("top_ask_price")),
        "total_bid_volume": F.when(kind == 11, F.lit(0.0)).otherwise(F.col("total_bid_volume")),
        "bid_ask_ratio": F.when(kind == 11, F.lit(0.0))
        .when(kind == 17, F.lit(None)).otherwise(F.col("bid_ask_ratio")),
    })


def trade_messages(base: DataFrame) -> DataFrame:
    """Exchange messages of the trades, some of another kind, without a price, or cut short."""
    kind = F.col("trade_id") % 53
    trades = trades_of(base)
    data = F.to_json(F.struct(F.struct(
        F.when(kind == 3, "aggTrade").otherwise("trade").alias("e"),
        F.col("symbol").alias("s"),
        F.when(kind != 5, F.col("price").cast("string")).alias("p"),
        F.when(kind == 9, "n/a").otherwise(F.col("size").cast("string")).alias("q"),
        F.col("timestamp").alias("T"),
        F.col("trade_id").alias("t_id"),
    ).alias("data")))
    text = F.replace(data, F.lit('"t_id"'), F.lit('"t"'))
    return trades.select(
        F.when(kind == 11, F.substring(text, 1, 20)).otherwise(text).alias("value")
    )


def depth_messages(base: DataFrame) -> DataFrame:
    """Depth messages of the books, some with an empty side, zero quantities or a bad level."""
    kind = F.call_function("div", F.col("timestamp"), F.lit(STEP_MS)) % 53

    def as_text(side: str):
        return F.transform(side, lambda level: F.transform(level, lambda x: x.cast("string")))

    empty = F.array().cast("array<array<string>>")
    no_volume = F.transform(
        "ask_depth", lambda level: F.array(F.get(level, F.lit(0)).cast("string"), F.lit("0"))
    )
    asks = (
        F.when(kind == 3, empty).when(kind == 5, no_volume)
        .when(kind == 7, F.array(F.array(F.lit("1.0"))))
        .otherwise(as_text("ask_depth"))
    )
    return books_of(base).select(
        F.to_json(F.struct(
            F.concat(F.lower("symbol"), F.lit("@depth20@1000ms")).alias("stream"),
            F.struct(as_text("bid_depth").alias("bids"), asks.alias("asks")).alias("data"),
        )).alias("value"),
        F.col("timestamp").alias("ingest_ts"),
    )

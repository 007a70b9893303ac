"""Table schemas and the fixed names shared by every stage."""

from pyspark.sql import types as T

# --- fixed values: symbols, topics, time floor, model input layout ---
SYMBOLS = ("BTCUSDT", "ETHUSDT", "SOLUSDT")
TRADE_TOPIC = "crypto-prices"
BOOK_TOPIC = "crypto-orderbook"
PREDICTION_TOPIC = "crypto-predictions"
MIN_TIMESTAMP_MS = 1_577_836_800_000  # 2020-01-01T00:00:00Z
SEQUENCE_LENGTH = 60
LONGEST_LAG = 10
MIN_TRAINING_ROWS = SEQUENCE_LENGTH + 10
TRAIN_SHARE = 0.8
ROWS_PER_SYMBOL = 10_000
VIEW_POINTS = 200

FEATURE_COLS = [
    "price", "size",
    "price_lag_1", "price_lag_5", "price_lag_10",
    "price_change", "price_change_pct",
    "rolling_avg_5", "rolling_avg_10",
    "rolling_stddev_10", "volume_change",
    "spread", "bid_ask_ratio",
    "total_bid_volume", "total_ask_volume",
]
BOOK_FILL_COLS = ["bid_ask_ratio", "total_bid_volume", "total_ask_volume", "spread"]
CORE_PRICE_COLS = ["price", "price_lag_1", "price_change", "rolling_avg_5"]
# --- end of fixed values ---

BOOK_MATCH_COLS = [
    "top_bid_price", "top_ask_price", "bid_ask_ratio", "total_bid_volume", "total_ask_volume",
]

# The band join gives one trade several rows with one timestamp, so the event time alone does
# not order them. These columns do; rows equal in all of them are interchangeable.
JOINED_ORDER = [
    "timestamp", "trade_id", "book_timestamp", "top_bid_price", "top_ask_price",
    "total_bid_volume", "total_ask_volume", "price", "size",
]

_DEPTH = T.ArrayType(T.ArrayType(T.DoubleType()))

TRADE = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("size", T.DoubleType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("trade_id", T.LongType()),
])

BOOK = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("top_bid_price", T.DoubleType()),
    T.StructField("top_bid_qty", T.DoubleType()),
    T.StructField("top_ask_price", T.DoubleType()),
    T.StructField("top_ask_qty", T.DoubleType()),
    T.StructField("bid_depth", _DEPTH),
    T.StructField("ask_depth", _DEPTH),
    T.StructField("total_bid_volume", T.DoubleType()),
    T.StructField("total_ask_volume", T.DoubleType()),
    T.StructField("bid_ask_ratio", T.DoubleType()),
])

DEAD_LETTER = T.StructType([
    T.StructField("error", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("raw", T.StringType()),
    T.StructField("original_payload", T.StringType()),
    T.StructField("timestamp", T.StringType()),
])

TOPIC_SCHEMAS = {TRADE_TOPIC: TRADE, BOOK_TOPIC: BOOK}

"""Raw exchange messages to typed events.

``parse_status`` says what happened to a message; only ``ok`` rows go on. Unreadable messages are
skipped, not dead-lettered: the contract has not seen them yet.
"""

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.numbers import computed_once, text_to_double, text_to_long

_TRADE_MESSAGE = "data map<string,string>, _corrupt_record string"
_DEPTH_MESSAGE = (
    "stream string, data struct<bids:array<array<string>>,asks:array<array<string>>>,"
    " _corrupt_record string"
)

_LEVELS = "array<array<double>>"
# Number texts in a list that only Java reads: "1.5d", "0x1p3". Messages without these letters
# next to a quote or zero need no regular expression.
_JAVA_NUMBER = r'[\[,]\s*"\s*[+-]?(0[xX][^"]*|[0-9.][0-9.eE+-]*[dDfF])\s*"'
_JAVA_LETTERS = ('d"', 'D"', 'f"', 'F"', "0x", "0X")


def parse_trades(df: DataFrame, value: str = "value") -> DataFrame:
    """``symbol, price, size, timestamp, trade_id, parse_status`` beside the other columns."""
    # A map keeps "T" (trade time) and "t" (trade id) apart; struct fields ignore case.
    message = F.from_json(F.col(value), _TRADE_MESSAGE)

    def field(name: str) -> Column:
        return F.try_element_at(F.col("_m.data"), F.lit(name))

    price, size = text_to_double(field("p")), text_to_double(field("q"))
    status = (
        F.when(F.col("_m._corrupt_record").isNotNull() | F.col("_m").isNull(), "unparseable")
        .when(~field("e").eqNullSafe(F.lit("trade")), "not_trade")
        .when(price.isNull() | size.isNull(), "unparseable")
        .otherwise("ok")
    )
    kept = [c for c in df.columns if c != value]
    return computed_once(df, "_m", message).select(
        *kept,
        field("s").alias("symbol"),
        price.alias("price"),
        size.alias("size"),
        text_to_long(field("T")).alias("timestamp"),
        text_to_long(field("t")).alias("trade_id"),
        status.alias("parse_status"),
    )


def _bad_levels(side: Column) -> Column:
    """Any level that is not two numbers. Nulls are counted over the flat list, which is cheap."""
    numbers = F.size(F.array_compact(F.flatten(side)))
    all_numbers = F.coalesce(numbers == F.size(side) * 2, F.lit(False))
    return ~all_numbers | F.exists(side, lambda level: F.size(level) != 2)


def total_quantity(side: Column) -> Column:
    return F.aggregate(side, F.lit(0.0), lambda total, level: total + F.get(level, F.lit(1)))


def parse_depth(df: DataFrame, value: str = "value", ingest_ts: str = "ingest_ts") -> DataFrame:
    """Order-book snapshot with top of book, totals and ratio; the time is the ingest time.

    The top of book is the first level of a side, as the exchange sends them best-first.
    """
    kept = [c for c in df.columns if c not in (value, ingest_ts)]
    message = computed_once(df, "_m", F.from_json(F.col(value), _DEPTH_MESSAGE))
    sides = F.struct(
        *[F.col(f"_m.data.{side}").try_cast(_LEVELS).alias(side) for side in ("bids", "asks")]
    )
    suspect = reduce(or_, [F.contains(F.col(value), F.lit(text)) for text in _JAVA_LETTERS])
    parsed = computed_once(message, "_sides", sides).select(
        *kept,
        F.upper(F.split_part(F.coalesce("_m.stream", F.lit("")), F.lit("@"), F.lit(1)))
        .alias("symbol"),
        F.col(ingest_ts).alias("timestamp"),
        F.col("_sides.bids").alias("bid_depth"),
        F.col("_sides.asks").alias("ask_depth"),
        (
            F.col("_m._corrupt_record").isNotNull() | F.col("_m").isNull()
            | (suspect & F.col(value).rlike(_JAVA_NUMBER))
        ).alias("_unreadable"),
    )

    def first(side: str, i: int) -> Column:
        return F.get(F.get(F.col(side), F.lit(0)), F.lit(i))

    def has_levels(side: str) -> Column:
        return F.coalesce(F.size(side) > 0, F.lit(False))

    totals = parsed.withColumns({
        "total_bid_volume": total_quantity(F.col("bid_depth")),
        "total_ask_volume": total_quantity(F.col("ask_depth")),
    })
    ratio = F.try_divide("total_bid_volume", "total_ask_volume")
    status = (
        F.when(F.col("_unreadable"), "unparseable")
        .when(~(has_levels("bid_depth") & has_levels("ask_depth")), "empty_book")
        .when(_bad_levels(F.col("bid_depth")) | _bad_levels(F.col("ask_depth")), "unparseable")
        .when(ratio.isNull(), "unparseable")
        .otherwise("ok")
    )
    return totals.select(
        *kept, "symbol", "timestamp",
        first("bid_depth", 0).alias("top_bid_price"),
        first("bid_depth", 1).alias("top_bid_qty"),
        first("ask_depth", 0).alias("top_ask_price"),
        first("ask_depth", 1).alias("top_ask_qty"),
        "bid_depth", "ask_depth", "total_bid_volume", "total_ask_volume",
        ratio.alias("bid_ask_ratio"),
        status.alias("parse_status"),
    )


def parsed_ok(df: DataFrame) -> DataFrame:
    return df.where(F.col("parse_status") == "ok").drop("parse_status")

"""Trades joined to order books: by time band, and to the latest book."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.numbers import whole_seconds
from tickloom.operators.ordered import lay_out
from tickloom.schemas import BOOK_MATCH_COLS

BAND_SECONDS = 1


def band_join(
    trades: DataFrame,
    books: DataFrame,
    band: int = BAND_SECONDS,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Every trade with every book of its symbol at most ``band`` whole seconds away.

    Left join semantics: a trade without a book stays, with null book columns. Each book is
    repeated for the seconds it reaches, which turns the band into the equality (symbol, second).

    The join itself is an inner join: seconds that have trades but no book get one guard row, so
    no trade is lost. Unlike a left join, AQE may then split a crowded second on both sides.
    """
    carried = [c for c in keep if c in trades.columns]
    left = trades.select(
        "symbol", "timestamp", "price", "size", "trade_id", *carried,
        whole_seconds(F.col("timestamp")).alias("second"),
    )
    second = whole_seconds(F.col("timestamp"))
    reach = F.explode(F.sequence(second - band, second + band))
    near = (
        books.where(F.col("symbol").isNotNull() & F.col("timestamp").isNotNull())
        .select(
            F.col("symbol").alias("_symbol"),
            reach.alias("_second"),
            F.col("timestamp").alias("book_timestamp"),
            *BOOK_MATCH_COLS,
        )
    )
    seconds = (
        left.select(F.col("symbol").alias("_symbol"), F.col("second").alias("_second"),
                    F.lit(False).alias("_book"))
        .unionByName(near.select("_symbol", "_second", F.lit(True).alias("_book")))
    )
    guards = (
        seconds.groupBy("_symbol", "_second").agg(F.bool_or("_book").alias("_covered"))
        .where("not _covered").drop("_covered")
    )
    right = near.unionByName(guards, allowMissingColumns=True)
    joined = left.join(
        right,
        F.col("symbol").eqNullSafe(F.col("_symbol"))
        & F.col("second").eqNullSafe(F.col("_second")),
    )
    return joined.select(
        "symbol", "timestamp", "price", "size", *BOOK_MATCH_COLS,
        "trade_id", "book_timestamp", *carried,
    )


def asof_join(
    trades: DataFrame,
    books: DataFrame,
    group: tuple[str, ...] = ("symbol",),
    blocks: int | None = None,
) -> DataFrame:
    """Each trade with the latest book of its symbol at or before it; one row per trade.

    Before the first book the spread is 0 and the other book values are 0.0. A book counts
    before a trade of the same millisecond.
    """
    book = F.struct(
        F.col("timestamp").alias("book_timestamp"), *[F.col(c) for c in BOOK_MATCH_COLS]
    )
    passed = [c for c in trades.columns if c not in ("symbol", "timestamp")]
    events = trades.select(
        "symbol", "timestamp", *passed, F.lit(1).alias("_kind"),
    ).unionByName(
        books.select("symbol", "timestamp", F.lit(0).alias("_kind"), book.alias("_book"),
                     *[c for c in group if c != "symbol"]),
        allowMissingColumns=True,
    )
    tie = [f"_book.{c}" for c in BOOK_MATCH_COLS]
    order = ["timestamp", "_kind", *[c for c in ("trade_id",) if c in passed], *tie]
    ordered = lay_out(events, group, order, blocks).filled(["_book"])

    def known(name: str) -> Column:
        return F.coalesce(F.col(f"_book.{name}"), F.lit(0.0))

    return ordered.rows().where(F.col("_kind") == 1).select(
        "symbol", "timestamp", *passed,
        F.col("_book.book_timestamp").alias("book_timestamp"),
        (known("top_ask_price") - known("top_bid_price")).alias("spread"),
        *[known(c).alias(c) for c in
          ("bid_ask_ratio", "total_bid_volume", "total_ask_volume")],
    )


def outer_join_points(prices: DataFrame, predictions: DataFrame, key: list[str]) -> DataFrame:
    """Full outer join of price and prediction points; repeated keys multiply, as in any join."""
    return prices.join(predictions, key, "full")

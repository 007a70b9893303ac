"""Feature tables from joined ticks."""

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.features import (
    CONVENTIONS, book_features, market_pressure, tick_features,
)
from tickloom.operators.ordered import CARRIED, Ordered, lay_out
from tickloom.schemas import FEATURE_COLS, JOINED_ORDER, LONGEST_LAG

BY_DATE = ("symbol", "date")
CONTINUOUS = ("symbol",)
COMPLETE = "complete"
LAG_COLS = ["price_lag_1", "price_lag_5", "price_lag_10"]


def order_ticks(
    joined: DataFrame,
    group: tuple[str, ...] = BY_DATE,
    blocks: int | None = None,
) -> Ordered:
    """Lay joined ticks out in event order, per symbol and date or per symbol."""
    return lay_out(joined, group, [c for c in JOINED_ORDER if c in joined.columns], blocks)


def build_features(ticks: Ordered) -> DataFrame:
    """The daily feature table; the first ten rows of a group have no full history and go."""
    seen = ticks.with_history(LONGEST_LAG)
    kept = joined_columns(ticks)
    added = [c for c in FEATURE_COLS if c not in kept]
    return (
        seen.df.withColumns(tick_features(seen.window, CONVENTIONS["batch"]) | book_features())
        .where(~F.col(CARRIED))
        .dropna(subset=LAG_COLS)
        .select(*kept, *added, market_pressure().alias("market_pressure"))
    )


def joined_columns(ticks: Ordered) -> list[str]:
    return ticks.rows().columns


def live_features(ticks: Ordered, convention: str = "serving") -> DataFrame:
    """Features of as-of joined ticks, from a symbol's eleventh tick on.

    ``convention`` picks the rolling frames: those of live scoring, or those of the daily table.
    """
    seen, kept = with_live_features(ticks, LONGEST_LAG, convention), joined_columns(ticks)
    return seen.df.where(F.col(COMPLETE) & ~F.col(CARRIED)).select(
        *kept, *[c for c in FEATURE_COLS if c not in kept]
    )


def with_live_features(ticks: Ordered, history: int, convention: str) -> Ordered:
    """The ordered ticks with features and, in ``complete``, whether ten ticks came before."""
    seen = ticks.with_history(history)
    # A null price_lag_10 would not tell a missing tick from a missing price.
    reach = seen.window.rowsBetween(-LONGEST_LAG, 0)
    complete = F.count(F.lit(1)).over(reach) > LONGEST_LAG
    added = tick_features(seen.window, CONVENTIONS[convention]) | {COMPLETE: complete}
    return replace(seen, df=seen.df.withColumns(added))

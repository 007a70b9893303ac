"""Feature expressions over a tick window: lags, changes, rolling statistics, book values."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Convention:
    """How many rows before the current one the rolling values span, and which deviation."""

    short_frame: int
    long_frame: int
    deviation: Callable[[Column], Column]


# The daily job's frames reach 5 and 10 rows back (6 and 11 rows, sample deviation); live scoring
# uses the last 5 and 10 rows (population deviation).
BATCH = Convention(5, 10, F.stddev_samp)
SERVING = Convention(4, 9, F.stddev_pop)
CONVENTIONS = {"batch": BATCH, "serving": SERVING}


def lagged(window: WindowSpec, name: str, rows: int) -> Column:
    return F.lag(name, rows).over(window)


def change(value: Column, previous: Column) -> Column:
    return F.when(previous.isNull(), 0.0).otherwise(value - previous)


def change_pct(value: Column, previous: Column) -> Column:
    return F.when(previous.isNull() | (previous == 0), 0.0).otherwise(
        (value - previous) / previous * 100
    )


def tick_features(window: WindowSpec, convention: Convention) -> dict[str, Column]:
    price, size = F.col("price"), F.col("size")
    previous = lagged(window, "price", 1)
    short = window.rowsBetween(-convention.short_frame, 0)
    long = window.rowsBetween(-convention.long_frame, 0)
    return {
        "price_lag_1": previous,
        "price_lag_5": lagged(window, "price", 5),
        "price_lag_10": lagged(window, "price", 10),
        "price_change": change(price, previous),
        "price_change_pct": change_pct(price, previous),
        "rolling_avg_5": F.avg(price).over(short),
        "rolling_avg_10": F.avg(price).over(long),
        "rolling_stddev_10": F.coalesce(convention.deviation(price).over(long), F.lit(0.0)),
        "volume_change": change(size, lagged(window, "size", 1)),
    }


def book_features() -> dict[str, Column]:
    """Nulls (no book matched) become 0; NaN stays."""
    zero = F.lit(0.0)
    return {
        "spread": F.coalesce(F.col("top_ask_price") - F.col("top_bid_price"), zero),
        "bid_ask_ratio": F.coalesce("bid_ask_ratio", zero),
        "total_bid_volume": F.coalesce("total_bid_volume", zero),
        "total_ask_volume": F.coalesce("total_ask_volume", zero),
    }


def market_pressure() -> Column:
    return F.when(F.col("bid_ask_ratio") > 1, "buy").otherwise("sell")

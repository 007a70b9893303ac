"""Serving views over prices and predictions."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.operators.joins import outer_join_points
from tickloom.operators.recent import latest_value, most_recent
from tickloom.schemas import VIEW_POINTS
from tickloom.session import materialize


def last_points(df: DataFrame, order: tuple[str, ...], n: int = VIEW_POINTS) -> DataFrame:
    return most_recent(df, n, order=order)


def chart(
    prices: DataFrame,
    predictions: DataFrame,
    price_order: tuple[str, ...] = ("timestamp",),
    prediction_order: tuple[str, ...] = ("timestamp",),
    n: int = VIEW_POINTS,
) -> DataFrame:
    """``symbol, t, actual_price, predicted_price``: the last points of both series, outer joined.

    Symbols without a price have no chart. Each side is cut to ``n`` points per symbol first and
    stored, so the join and the last cut are small whatever the history.
    """
    actual = materialize(last_points(prices, price_order, n).select(
        "symbol", F.col("timestamp").alias("t"), F.col("price").alias("actual_price")
    ), "chart-prices")
    expected = materialize(last_points(predictions, prediction_order, n).select(
        "symbol", F.col("timestamp").alias("t"), "predicted_price"
    ), "chart-predictions")
    charted = expected.join(actual.select("symbol").distinct(), "symbol", "left_semi")
    points = outer_join_points(actual, charted, ["symbol", "t"])
    newest = Window.partitionBy("symbol").orderBy(
        *[F.col(c).desc() for c in ("t", "actual_price", "predicted_price")]
    )
    return points.withColumn("_rank", F.row_number().over(newest)) \
        .where(F.col("_rank") <= n).drop("_rank")


def recent_predictions(predictions: DataFrame, order: tuple[str, ...], n: int = 10) -> DataFrame:
    """The last predictions per symbol, newest first, under their display names."""
    return most_recent(predictions, n, order=order).orderBy(
        "symbol", *[F.col(c).desc() for c in order]
    ).select(
        "symbol",
        F.col("current_price").alias("Actual"),
        F.col("predicted_price").alias("Predicted"),
        F.col("diff").alias("Diff"),
        F.col("direction").alias("Direction"),
    )


def live_board(
    prices: DataFrame, predictions: DataFrame, order: tuple[str, ...] = ("timestamp",)
) -> DataFrame:
    """Headline texts per symbol that has a price; prediction texts are null without one."""
    price = latest_value(prices, "price", order=order).select("symbol", "price")
    forecast = most_recent(predictions, 1, order=order) \
        .select("symbol", "predicted_price", "diff", "direction")
    return price.join(forecast, "symbol", "left").select(
        "symbol",
        F.concat(F.lit("$"), F.format_number("price", 4)).alias("live_price"),
        F.concat(F.lit("$"), F.format_number("predicted_price", 4))
        .alias("predicted_next"),
        F.when(F.col("diff").isNotNull(), F.format_string("%+.4f", "diff"))
        .alias("delta"),
        "direction",
    )

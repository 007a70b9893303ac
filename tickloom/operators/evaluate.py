"""Forecast errors and prediction records."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def forecast_errors(
    predicted: DataFrame, *more: Column, actual: str = "actual", forecast: str = "predicted"
) -> DataFrame:
    """MAE, RMSE and MAPE (%) per symbol; rows whose actual is 0 are left out of MAPE.

    ``more`` aggregates are taken in the same pass.
    """
    error = F.col(actual) - F.col(forecast)
    return predicted.groupBy("symbol").agg(
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (F.avg(F.abs(F.try_divide(error, F.col(actual)))) * 100).alias("mape"),
        F.count(F.lit(1)).alias("test_records"),
        *more,
    )


def direction(current: str = "current_price", predicted: str = "predicted_price") -> Column:
    """A tie counts as DOWN."""
    return F.when(F.col(predicted) > F.col(current), "UP").otherwise("DOWN")


def prediction_records(scored: DataFrame, at: Column) -> DataFrame:
    """The published record; ``at`` is the prediction time in epoch ms."""
    return scored.select(
        "symbol",
        "current_price",
        "predicted_price",
        direction().alias("direction"),
        F.bround(F.col("predicted_price") - F.col("current_price"), 4).alias("diff"),
        at.cast("long").alias("timestamp"),
    )

"""Column expressions for numbers that arrive as text, and for missing values."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Decimal notation with optional exponent, or inf / nan; excludes Java-only forms such as "1d".
_NUMBER_TEXT = r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity|nan)\s*$"

_FRACTIONAL = (T.DoubleType, T.FloatType)


def text_to_double(text: Column) -> Column:
    return F.when(text.rlike(_NUMBER_TEXT), text.try_cast("double"))


def text_to_long(text: Column) -> Column:
    """Whole numbers only: "12" and "12.0" convert, "12.5" and "x" give null."""
    exact = text.try_cast("decimal(38,9)")
    return F.when(exact == F.floor(exact), exact.try_cast("long"))


def computed_once(df: DataFrame, name: str, column: Column) -> DataFrame:
    """Add a costly column that filters above it do not evaluate again.

    Spark pushes a filter below the projection it refers to, copying the expression; a generator
    with one element per row is not crossed.
    """
    return df.select("*", F.explode(F.array(column)).alias(name))


def is_fractional(data_type: T.DataType) -> bool:
    return isinstance(data_type, _FRACTIONAL)


def missing(df: DataFrame, name: str) -> Column:
    """Null, or NaN where the type has NaN (``isnan`` fails on strings and arrays)."""
    column = F.col(name)
    if is_fractional(df.schema[name].dataType):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def finite_or_null(column: Column) -> Column:
    return F.when(~F.isnan(column) & (F.abs(column) != float("inf")), column)


def event_time(timestamp_ms: Column) -> Column:
    return F.timestamp_millis(timestamp_ms)


def event_date(timestamp_ms: Column) -> Column:
    """UTC date, whatever the session time zone."""
    return F.date_from_unix_date(F.floor(timestamp_ms / 86_400_000).cast("int"))


def whole_seconds(timestamp_ms: Column) -> Column:
    """Truncated seconds; integer division, so no detour through double."""
    return F.call_function("div", timestamp_ms, F.lit(1000))

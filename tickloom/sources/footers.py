"""What parquet footers tell of a layer: rows, nulls and bounds without reading a column."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Types whose bounds a footer holds exactly; text may be cut there, and fractions may be NaN.
BOUNDED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType)
COUNTED = (*BOUNDED, T.BooleanType, T.FloatType, T.DoubleType, T.StringType, T.BinaryType, T.TimestampType)
PROFILE = "column string, type string, rows long, nulls long, least string, most string"


def _footer_session(spark: SparkSession) -> SparkSession:
    """A session that answers aggregates of parquet columns from footers; the given one stays as it is."""
    session = spark.newSession()
    first = spark.conf.get("spark.sql.sources.useV1SourceList")
    session.conf.set("spark.sql.sources.useV1SourceList", ",".join(s for s in first.split(",") if s != "parquet"))
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session


def _leaves(kind: T.DataType) -> int:
    """Parquet columns that a column is stored as."""
    if isinstance(kind, T.ArrayType):
        return _leaves(kind.elementType)
    if isinstance(kind, T.MapType):
        return _leaves(kind.keyType) + _leaves(kind.valueType)
    return sum(_leaves(f.dataType) for f in kind) if isinstance(kind, T.StructType) else 1


def _table(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The folders in a footer session. Spark finds a column's footer by its place, so all are declared."""
    types = spark.read.parquet(paths[0]).schema
    wide = [f.name for f in types if _leaves(f.dataType) != 1]
    if wide:
        raise ValueError(f"columns stored as several: {wide}")
    return _footer_session(spark).read.schema(types).parquet(*paths)


def footer_counts(table: DataFrame, names: list[str]) -> DataFrame:
    """One row of a table's rows and of the values of plain columns, from the footers."""
    return table.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count(F.col(f"`{name}`")).alias(f"n_{i}") for i, name in enumerate(names)])


def footer_bounds(table: DataFrame, names: list[str]) -> DataFrame:
    """One row of the bounds of columns without a null, from the footers."""
    return table.agg(*[
        bound(F.col(f"`{name}`")).alias(f"{which}_{name}") for name in names for which, bound in (("least", F.min), ("most", F.max))])


def footer_rows(spark: SparkSession, paths: list[str]) -> int:
    return footer_counts(_table(spark, paths), []).first()["rows"] or 0  # files without rows count nothing


def footer_profile(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``column, type, rows, nulls, least, most`` of each plain column, a row for each.

    ``least`` and ``most`` are text. They are null for types whose bounds footers don't hold exactly and
    for columns with a null, since the footer of a file with nothing but nulls has none.
    """
    table = _table(spark, paths)
    fields = [f for f in table.schema if isinstance(f.dataType, COUNTED)]
    counts = {k: n or 0 for k, n in footer_counts(table, [f.name for f in fields]).first().asDict().items()}
    rows = counts["rows"]
    filled = [f.name for i, f in enumerate(fields) if isinstance(f.dataType, BOUNDED) and 0 < rows == counts[f"n_{i}"]]
    bounds = footer_bounds(table, filled).first().asDict() if filled else {}

    def text(name: str) -> str | None:
        return None if bounds.get(name) is None else str(bounds[name])

    return spark.createDataFrame([
        (f.name, f.dataType.simpleString(), rows, rows - counts[f"n_{i}"], text(f"least_{f.name}"), text(f"most_{f.name}"))
        for i, f in enumerate(fields)], PROFILE)

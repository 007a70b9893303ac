"""Contract checks and dead-letter routing."""

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.contracts import Contract
from tickloom.functions.numbers import computed_once, text_to_double, text_to_long

_UNREADABLE = "_unreadable"


def _coerced(column: Column, actual: T.DataType, declared: T.DataType) -> Column:
    """``column`` as its declared type, null where it cannot be read as that type."""
    if actual == declared:
        return column
    if isinstance(actual, T.StringType):
        if isinstance(declared, T.DoubleType):
            return text_to_double(column)
        if isinstance(declared, T.LongType):
            return text_to_long(column)
        return F.from_json(column, declared, {"mode": "PERMISSIVE"})
    if isinstance(declared, T.LongType) and isinstance(actual, (T.DoubleType, T.FloatType)):
        return F.when(column == F.floor(column), column.try_cast("long"))
    return column.try_cast(declared)


def _typed(df: DataFrame, contract: Contract) -> dict[str, Column]:
    present = {f.name: f.dataType for f in df.schema}
    return {
        f.name: _coerced(F.col(f.name), present[f.name], f.dataType)
        if f.name in present else F.lit(None).cast(f.dataType)
        for f in contract.schema
    }


def _passes(typed: dict[str, Column], contract: Contract) -> Column:
    """True when every field has a value and no rule is broken; never null."""
    tests = [column.isNotNull() for column in typed.values()]
    for rules in contract.rules.values():
        tests += [~F.coalesce(rule.broken(typed), F.lit(False)) for rule in rules]
    return reduce(and_, tests)


def _violations(df: DataFrame, typed: dict[str, Column], contract: Contract) -> Column:
    found = []
    for field in contract.schema:
        name = field.name
        failures = [
            (F.col(name).isNull() if name in df.columns else F.lit(True), "field required"),
            (typed[name].isNull(), f"not a valid {field.dataType.simpleString()}"),
            *[(rule.broken(typed), rule.message) for rule in contract.rules.get(name, ())],
        ]
        message = F.lit(None).cast("string")
        for condition, text in reversed(failures):
            message = F.when(condition, text).otherwise(message)
        found.append(F.when(
            message.isNotNull(), F.struct(F.lit(name).alias("field"), message.alias("message"))
        ))
    return F.array_compact(F.array(*found))


def check(df: DataFrame, contract: Contract) -> DataFrame:
    """Add ``typed`` (the coerced record), ``valid`` and ``violations`` (one per failed field).

    ``valid`` is a plain boolean, so readers that only want valid rows never build violations.
    """
    typed = _typed(df, contract)
    return df.withColumns({
        "typed": F.struct(*[typed[c].alias(c) for c in contract.columns]),
        "valid": _passes(typed, contract),
        "violations": _violations(df, typed, contract),
    })


def conforming(df: DataFrame, contract: Contract) -> DataFrame:
    """The valid records alone, coerced, when nobody asks for the others."""
    typed = _typed(df, contract)
    return df.where(_passes(typed, contract)).select(
        *[typed[c].alias(c) for c in contract.columns]
    )


def check_json(df: DataFrame, contract: Contract, value: str = "value") -> DataFrame:
    """Check JSON text records. ``raw`` keeps the text as received, extra fields included."""
    as_text = T.StructType(
        [T.StructField(c, T.StringType()) for c in contract.columns]
        + [T.StructField(_UNREADABLE, T.StringType())]
    )
    parsed = F.from_json(
        F.col("raw"), as_text, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _UNREADABLE}
    )
    kept = [c for c in df.columns if c != value]
    fields = computed_once(
        df.select(*kept, F.col(value).alias("raw")), "_record", parsed
    ).select(*kept, "raw", "_record.*")
    checked = check(fields, contract)
    unreadable = F.array(
        F.struct(F.lit("record").alias("field"), F.lit("not a JSON object").alias("message"))
    )
    broken = F.col(_UNREADABLE).isNotNull() | F.col("raw").isNull()
    return checked.select(
        *kept, "raw", "typed",
        (F.col("valid") & ~broken).alias("valid"),
        F.when(broken, unreadable).otherwise(F.col("violations")).alias("violations"),
    )


def error_text() -> Column:
    return F.concat_ws(
        "; ", F.transform("violations", lambda v: F.concat(v["field"], F.lit(": "), v["message"]))
    )


def valid_records(checked: DataFrame) -> DataFrame:
    """Publish side: the coerced record with undeclared fields dropped."""
    return checked.where("valid").select("typed.*")


def dead_letters(checked: DataFrame, topic: str, seen_at: Column | None = None) -> DataFrame:
    """Envelopes of the failed records, in the superset layout of all dead-letter writers.

    ``raw`` is the record as received: its text, or else its columns with the values that failed.
    """
    received = [c for c in checked.columns if c not in ("typed", "valid", "violations")]
    raw = F.col("raw") if "raw" in received else F.to_json(
        F.struct(*received), {"ignoreNullFields": "false"}
    )
    return checked.where("not valid").select(
        error_text().alias("error"),
        F.lit(topic).alias("topic"),
        raw.alias("raw"),
        F.lit(None).cast("string").alias("original_payload"),
        (seen_at if seen_at is not None else F.lit(None)).cast("string").alias("timestamp"),
    )


def violation_counts(checked: DataFrame) -> DataFrame:
    return (
        checked.select(F.explode("violations").alias("v"))
        .groupBy(F.col("v.field").alias("field"), F.col("v.message").alias("message"))
        .agg(F.count(F.lit(1)).alias("violations"))
    )

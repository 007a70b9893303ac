"""From feature tables to scaled, windowed training rows."""

from dataclasses import replace
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from tickloom.functions.numbers import finite_or_null, missing
from tickloom.operators.features import COMPLETE, with_live_features
from tickloom.operators.ordered import CARRIED, Ordered, lay_out
from tickloom.operators.recent import most_recent
from tickloom.schemas import (
    BOOK_FILL_COLS, CORE_PRICE_COLS, FEATURE_COLS, JOINED_ORDER, LONGEST_LAG,
    MIN_TRAINING_ROWS, SEQUENCE_LENGTH, TRAIN_SHARE,
)

TIE_BREAK = ["trade_id", "book_timestamp"]
VALIDATION_SHARE = 0.1


def training_columns(df: DataFrame) -> list[str]:
    return ["symbol", "timestamp", *FEATURE_COLS, *[c for c in TIE_BREAK if c in df.columns]]


def tick_order(df: DataFrame) -> list[str]:
    return [c for c in JOINED_ORDER if c in df.columns]


def recent_days(features: DataFrame, days: int | None) -> DataFrame:
    """Only the newest ``days`` dates of the table; all of them by default."""
    if days is None:
        return features
    last = features.agg(F.max("date").alias("d")).first()["d"]
    return features.where(F.col("date") > F.date_sub(F.lit(last), days))


def drop_incomplete(df: DataFrame) -> DataFrame:
    return df.dropna(subset=CORE_PRICE_COLS)


def fill_book_values(df: DataFrame) -> DataFrame:
    """0 for missing (null or NaN) book values."""
    return df.fillna(0, subset=BOOK_FILL_COLS)


def prepare_training(
    features: DataFrame, rows_per_symbol: int | None = None, days: int | None = None
) -> DataFrame:
    """Rows without core prices dropped, then book values filled.

    With ``rows_per_symbol`` only the newest rows of each symbol are taken, before the drop.
    """
    chosen = recent_days(features, days).select(*training_columns(features))
    if rows_per_symbol is not None:
        chosen = most_recent(chosen, rows_per_symbol, order=tuple(tick_order(chosen)))
    return fill_book_values(drop_incomplete(chosen))


def trainable_symbols(df: DataFrame, at_least: int = MIN_TRAINING_ROWS) -> DataFrame:
    """Symbols with enough rows to cut sequences from, and their row counts."""
    counts = df.groupBy("symbol").agg(F.count(F.lit(1)).alias("rows"))
    return counts.where(F.col("rows") >= at_least)


def clean_series(df: DataFrame, blocks: int | None = None) -> DataFrame:
    """Infinite to missing; book values 0; the rest forward-filled in time order, then 0."""
    finite = df.withColumns({c: finite_or_null(F.col(c)) for c in FEATURE_COLS})
    booked = finite.fillna(0, subset=BOOK_FILL_COLS)
    carried = [c for c in FEATURE_COLS if c not in BOOK_FILL_COLS]
    filled = lay_out(booked, ["symbol"], tick_order(booked), blocks).filled(carried).rows()
    return filled.fillna(0, subset=carried).dropna(subset=FEATURE_COLS)


def bad_values(df: DataFrame) -> DataFrame:
    """NaN (or null) and infinite values left over all features."""
    def total(counts: list[Column]) -> Column:
        return reduce(add, counts)

    return df.agg(
        total([F.count_if(missing(df, c)) for c in FEATURE_COLS]).alias("nan_values"),
        total([F.count_if(F.abs(c) == float("inf")) for c in FEATURE_COLS])
        .alias("infinite_values"),
    )


def fit_scaler(df: DataFrame) -> DataFrame:
    """Min and max of every feature per symbol, one row per (symbol, feature)."""
    wide = df.groupBy("symbol").agg(*[
        F.struct(F.min(c).alias("min"), F.max(c).alias("max")).alias(c) for c in FEATURE_COLS
    ])
    return wide.unpivot("symbol", FEATURE_COLS, "feature", "bounds").select(
        "symbol", "feature", F.col("bounds.min").alias("min"), F.col("bounds.max").alias("max")
    )


def _wide(scaler: DataFrame) -> DataFrame:
    """One row per symbol: ``_min_<feature>`` and ``_max_<feature>``."""
    bounds = [("min", c) for c in FEATURE_COLS] + [("max", c) for c in FEATURE_COLS]
    return scaler.groupBy("symbol").agg(*[
        F.max(F.when(F.col("feature") == c, F.col(bound))).alias(f"_{bound}_{c}")
        for bound, c in bounds
    ])


def scale(df: DataFrame, scaler: DataFrame) -> DataFrame:
    """Min-max scale with a stored scaler: never refitted, not clipped, constant columns to 0.

    ``scaler`` has 15 rows per symbol; pass a stored table, whose size Spark can see.
    """
    def scaled(name: str) -> Column:
        low, high = F.col(f"_min_{name}"), F.col(f"_max_{name}")
        width = F.when(high == low, F.lit(1.0)).otherwise(high - low)
        return (F.col(name) - low) / width

    return df.join(_wide(scaler), "symbol").select(*[
        scaled(c).alias(c) if c in FEATURE_COLS else F.col(c) for c in df.columns
    ])


def price_bounds(scaler: DataFrame) -> DataFrame:
    return scaler.where(F.col("feature") == "price").select(
        "symbol", F.col("min").alias("price_min"), F.col("max").alias("price_max")
    )


def inverse_scale(df: DataFrame, scaler: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Scaled prices back to prices: ``columns`` maps scaled column -> output column."""
    span = F.col("price_max") - F.col("price_min")
    width = F.when(span == 0, F.lit(1.0)).otherwise(span)
    return df.join(price_bounds(scaler), "symbol").withColumns({
        out: F.col(scaled) * width + F.col("price_min") for scaled, out in columns.items()
    }).drop("price_min", "price_max")


def order_series(df: DataFrame, blocks: int | None = None) -> Ordered:
    return lay_out(df, ["symbol"], tick_order(df), blocks)


def _with_windows(df: DataFrame, window: WindowSpec, vector: Column, length: int, back: int) -> DataFrame:
    """Add ``x``: the ``vector`` of ``length`` consecutive rows, the last of them ``back`` rows ago.

    Rows whose vector is null are left out; ``x`` is null or short where the rows before don't suffice. A few rows at a time
    are collected and these parts put together, which handles a row once for a part and not for each window.
    """
    part = max(n for n in range(1, 11) if length % n == 0)
    collected = F.collect_list(vector).over(window.rowsBetween(1 - part, 0))
    parts = [F.lag("_part", back + after).over(window) for after in range(length - part, -1, -part)]
    return df.withColumn("_part", collected).withColumn("x", F.concat(*parts)).drop("_part")


def index_sequences(
    series: Ordered, length: int = SEQUENCE_LENGTH, horizon: int = 1, target: str = "price"
) -> Ordered:
    """Keep the rows that are the label of a sequence: at least ``length`` rows come before.

    ``seq_no`` counts from 1 per symbol, ``seq_total`` is the symbol's number of sequences and
    ``y`` the target ``horizon`` rows after the sequence.
    """
    reach = length + horizon - 1
    ranked = series.ranked()
    return replace(ranked, df=ranked.df.select(
        *[c for c in ranked.df.columns if c not in ("rn", "group_rows")],
        (F.col("rn") - reach).alias("seq_no"),
        (F.col("group_rows") - reach).alias("seq_total"),
        F.col(target).alias("y"),
    ))


def build_sequences(
    series: Ordered, length: int = SEQUENCE_LENGTH, horizon: int = 1, target: str = "price"
) -> DataFrame:
    """``x``: ``length`` consecutive feature rows, beside the index and label of the sequence."""
    reach = length + horizon - 1
    seen = index_sequences(series, length, horizon, target).with_history(reach)
    vector = F.array(*[F.col(c) for c in FEATURE_COLS])
    return (
        _with_windows(seen.df, seen.window, vector, length, horizon)
        .where(~F.col(CARRIED) & (F.col("seq_no") > 0))
        .select("symbol", "seq_no", "seq_total", "timestamp", "x", "y")
    )


def persistence_forecast(series: Ordered, length: int = SEQUENCE_LENGTH) -> DataFrame:
    """The naive forecast of every sequence's label: the last price of the sequence."""
    seen = index_sequences(series, length).with_history(1)
    return (
        seen.df.withColumn("predicted", F.lag("price", 1).over(seen.window))
        .where(~F.col(CARRIED) & (F.col("seq_no") > 0))
        .select("symbol", "seq_no", "seq_total", "timestamp",
                F.col("y").alias("actual"), "predicted")
    )


def live_windows(
    ticks: Ordered,
    length: int = SEQUENCE_LENGTH,
    convention: str = "serving",
    scaler: DataFrame | None = None,
) -> DataFrame:
    """``x``: a symbol's newest ``length`` feature rows at every tick that has them all.

    One pass over the ordered ticks: features, their scaling and the windows share one
    partitioning, so the rows are shuffled and sorted once.
    """
    kept = [c for c in ticks.rows().columns if c not in FEATURE_COLS]
    seen = with_live_features(ticks, length - 1 + LONGEST_LAG, convention)
    rows = seen.df.withColumn("current_price", F.col("price"))
    if scaler is not None:
        rows = scale(rows, scaler)
    vector = F.when(F.col(COMPLETE), F.array(*[F.col(c) for c in FEATURE_COLS]))
    return (
        _with_windows(rows, seen.window, vector, length, 0)
        .where(~F.col(CARRIED) & (F.size("x") == length))
        .select(*kept, "current_price", "x")
    )


def split_sequences(sequences: DataFrame, train_share: float = TRAIN_SHARE) -> DataFrame:
    """Chronological split: the first share of a symbol's sequences trains, the rest tests."""
    trained = F.col("seq_no") <= trained_sequences(train_share)
    return sequences.withColumn("part", F.when(trained, "train").otherwise("test"))


def trained_sequences(train_share: float = TRAIN_SHARE) -> Column:
    """Number of the last sequence before those that test."""
    return F.floor(F.col("seq_total") * F.lit(train_share))


def last_trained(share: float = VALIDATION_SHARE, train_share: float = TRAIN_SHARE) -> Column:
    """Number of the last sequence that trains, before those that validate and test."""
    return F.floor(trained_sequences(train_share) * F.lit(1.0 - share))


def validation_part(
    split: DataFrame, share: float = VALIDATION_SHARE, train_share: float = TRAIN_SHARE
) -> DataFrame:
    """Mark the last ``share`` of the training part as validation."""
    kept = last_trained(share, train_share)
    return split.withColumn(
        "part",
        F.when((F.col("part") == "train") & (F.col("seq_no") > kept), "validation")
        .otherwise(F.col("part")),
    )


def walk_forward(sequences: DataFrame, folds: int) -> DataFrame:
    """Number the sequences by equal consecutive folds; fold k is tested on folds before it."""
    fold = F.least(
        F.floor((F.col("seq_no") - 1) * folds / F.col("seq_total")), F.lit(folds - 1)
    )
    return sequences.withColumn("fold", fold.cast("int"))


def has_missing(columns: list[str]) -> Column:
    return reduce(or_, [F.col(c).isNull() | F.isnan(c) for c in columns])

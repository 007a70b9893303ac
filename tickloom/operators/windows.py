"""Linear models of windows for all symbols in one pass, without a row for each window.

A window of 60 rows of 15 features has 900 inputs, and the products of any two of them, summed over
consecutive windows, are sums of products of two rows a fixed lag apart; only rows at the two ends of
the range count less often. So 61 matrices of 16 x 16 sums for each symbol (the features and a
column of ones, lags 0 to 60), added up by Spark from all blocks of the ordered series, and the first
and last 60 rows give the normal equations of a symbol exactly.

Models are rows of a table: an intercept and the weights of all inputs. Predictions over a series run
the weights along each block as a filter; live windows are joined to their symbol's weights.
"""

from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Model
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.numbers import event_date
from tickloom.operators.ordered import BLOCK, CARRIED, FROM_END, Ordered
from tickloom.operators.training import index_sequences, inverse_scale, last_trained, trained_sequences
from tickloom.schemas import FEATURE_COLS, MIN_TRAINING_ROWS, SEQUENCE_LENGTH
from tickloom.session import materialize

#: Weight of the squared coefficients beside the mean squared error of scaled prices.
RIDGE = 1e-4
ONE = "one"
TERMS = [ONE, *FEATURE_COLS]
PRICE = FEATURE_COLS.index("price")

MOMENTS = "symbol string, day date, lag int, term string, " + ", ".join(f"{t} double" for t in TERMS)
_COEFFICIENTS = "symbol string, windows long, intercept double, weights array<double>"
_PREDICTED = "symbol string, seq_no long, seq_total long, timestamp long, y double, y_hat double"


def trained_range(newest: int | None) -> Column:
    """True for the labels of a trainable symbol's training sequences, or of the ``newest`` of them."""
    enough = F.col("seq_total") >= MIN_TRAINING_ROWS - SEQUENCE_LENGTH
    inside = enough & (F.col("seq_no") > 0) & (F.col("seq_no") <= last_trained())
    return inside if newest is None else inside & (F.col("seq_no") > last_trained() - newest)


def _in_order(table: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """A block's rows in event order, and a matrix of ones and their features."""
    rows = table.sort_by([(FROM_END, "descending")])
    values = [rows[c].to_numpy() for c in FEATURE_COLS]
    return rows, np.column_stack([np.ones(rows.num_rows), *values])


def _block_moments(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    rows, matrix = _in_order(table)
    days = rows["day"].combine_chunks().cast(pa.int32()).to_numpy(zero_copy_only=False)
    used = rows["used"].to_numpy(zero_copy_only=False)
    found = []
    for day in np.unique(days[used]):
        labels = np.flatnonzero(used & (days == day))  # consecutive: days follow each other
        begin, end = labels[0] - SEQUENCE_LENGTH, labels[-1] + 1 - SEQUENCE_LENGTH
        first = matrix[begin:end].T
        for lag in range(SEQUENCE_LENGTH + 1):
            sums = first @ matrix[begin + lag:end + lag]
            found.append(pa.table({
                "symbol": [key[0].as_py()] * len(TERMS), "day": pa.array([int(day)] * len(TERMS), pa.int32()).cast(pa.date32()),
                "lag": pa.array([lag] * len(TERMS), pa.int32()), "term": TERMS,
                **{t: pa.array(sums[:, i]) for i, t in enumerate(TERMS)}}))
    return pa.concat_tables(found) if found else _empty(table, key)


def _empty(table: pa.Table, key: tuple[pa.Scalar, ...]) -> pa.Table:
    kinds = {"symbol": pa.string(), "day": pa.date32(), "lag": pa.int32(), "term": pa.string()}
    return pa.table({c: pa.array([], kinds.get(c, pa.float64())) for c in [*kinds, *TERMS]})


def window_moments(series: Ordered, newest: int | None = None, known: DataFrame | None = None) -> DataFrame:
    """(symbol, day, lag, term, one column for each term): sums over the windows that train.

    Of a window's first row the ``term`` times each term ``lag`` rows later, by the day of the label.
    ``one`` is 1 in every row. A block of the series gives a fixed number of rows for each day in it.
    Days of ``known`` (symbol, day), a small stored table, are left out.
    """
    indexed = index_sequences(series)
    marked = replace(indexed, df=indexed.df.withColumns({
        "used": trained_range(newest), "day": event_date(F.col("timestamp"))}))
    if known is not None:
        done = known.select(F.col("symbol").alias("_symbol"), F.col("day").alias("_day"))
        same = (F.col("symbol") == F.col("_symbol")) & (F.col("day") == F.col("_day"))
        marked = replace(marked, df=marked.df.join(done, same, "left").withColumn(
            "used", F.col("used") & F.col("_day").isNull()).drop("_symbol", "_day"))
    seen = marked.with_history(SEQUENCE_LENGTH).df.withColumn("used", F.col("used") & ~F.col(CARRIED))
    columns = ["symbol", BLOCK, FROM_END, "day", "used", *FEATURE_COLS]
    parts = seen.select(*columns).groupBy("symbol", BLOCK).applyInArrow(_block_moments, MOMENTS)
    return parts.groupBy("symbol", "day", "lag", "term").agg(*[F.sum(t).alias(t) for t in TERMS])


def whole_days(series: Ordered, newest: int | None = None) -> DataFrame:
    """(symbol, day) of the days all of whose sequences train, so that their sums don't change with the range."""
    labels = index_sequences(series).rows().where(F.col("seq_no") > 0)
    return labels.groupBy("symbol", event_date(F.col("timestamp")).alias("day")) \
        .agg(F.bool_and(trained_range(newest)).alias("whole")).where("whole").drop("whole")


def day_marks(clean: DataFrame) -> DataFrame:
    """(symbol, day, rows, mark, before): what the rows of each day are, and those of the day before it.

    The sums of a day depend on no other rows, as long as 60 rows are fewer than a day has.
    """
    ordered = Window.partitionBy("symbol").orderBy("day")
    rows = F.struct(F.count(F.lit(1)).alias("rows"), F.bit_xor(F.xxhash64("timestamp", *FEATURE_COLS)).alias("mark"))
    days = clean.groupBy("symbol", event_date(F.col("timestamp")).alias("day")).agg(rows.alias("own"))
    return days.withColumn("last", F.lag("own").over(ordered)).select(
        "symbol", "day", F.col("own.rows").alias("rows"), F.col("own.mark").alias("mark"),
        F.xxhash64("last.rows", "last.mark", F.col("last.rows") < SEQUENCE_LENGTH,
                   F.when(F.col("last.rows") < SEQUENCE_LENGTH, F.monotonically_increasing_id())).alias("before"))


def _converted(table: pa.Table, old: pa.Table, new: pa.Table) -> pa.Table:
    """Moments in the units of one scaler in those of another: features are affine in each other."""
    def bounds(scaler: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        rows = {r["feature"]: (r["min"], r["max"]) for r in scaler.to_pylist()}
        low, high = (np.array([rows[c][i] for c in FEATURE_COLS]) for i in (0, 1))
        return low, np.where(high == low, 1.0, high - low)

    (low, wide), (to_low, to_wide) = bounds(old), bounds(new)
    change = np.diag(np.concatenate([[1.0], wide / to_wide]))
    change[0, 1:] = (low - to_low) / to_wide
    table = table.append_column("place", pa.array([TERMS.index(t) for t in table["term"].to_pylist()]))
    table = table.sort_by([("day", "ascending"), ("lag", "ascending"), ("place", "ascending")]).drop(["place"])
    sums = np.column_stack([table[t].to_numpy() for t in TERMS]).reshape(-1, len(TERMS), len(TERMS))
    sums = (change.T @ sums @ change).reshape(-1, len(TERMS))
    for i, t in enumerate(TERMS):
        table = table.set_column(table.schema.get_field_index(t), t, pa.array(sums[:, i]))
    return table


def converted(moments: DataFrame, old: DataFrame, new: DataFrame) -> DataFrame:
    """``moments`` that were taken of features scaled by ``old`` as if ``new`` had scaled them."""
    def run(key: tuple[pa.Scalar, ...], sums: pa.Table, scalers: pa.Table) -> pa.Table:
        if not sums.num_rows:
            return sums
        sides = [scalers.filter(pc.equal(scalers["which"], which)) for which in (0, 1)]
        return _converted(sums, *sides)

    both = old.select("symbol", "feature", "min", "max", F.lit(0).alias("which")).unionByName(
        new.select("symbol", "feature", "min", "max", F.lit(1).alias("which")))
    return moments.select("symbol", "day", "lag", "term", *TERMS).groupBy("symbol") \
        .cogroup(both.select(F.col("symbol").alias("_symbol"), "feature", "min", "max", "which").groupBy("_symbol")) \
        .applyInArrow(run, MOMENTS)


def range_ends(series: Ordered, newest: int | None = None) -> DataFrame:
    """The first rows of the training windows' range and those after its last start, by place."""
    indexed = index_sequences(series).rows().withColumn("rn", F.col("seq_no") + SEQUENCE_LENGTH)
    before = F.lit(0) if newest is None else F.greatest(last_trained() - newest, F.lit(0))
    sides = [("head", before), ("tail", last_trained())]
    found = None
    for side, start in sides:
        place = F.col("rn") - start - 1
        rows = indexed.where(place.between(0, SEQUENCE_LENGTH - 1)).select(
            "symbol", F.lit(side).alias("side"), place.cast("int").alias("place"), *FEATURE_COLS)
        found = rows if found is None else found.unionByName(rows)
    return found


def lagged_sums(moments: np.ndarray, head: np.ndarray, tail: np.ndarray) -> np.ndarray:
    """[a, d]: sums of row a of each window times row a + d, from those of a = 0 and the range's ends."""
    reach = SEQUENCE_LENGTH
    sums = np.zeros((reach + 1, *moments.shape))
    sums[0] = moments
    for a in range(reach):
        # One row on, the first window's row goes and the row after the last window's comes.
        there = reach - a
        sums[a + 1, :there] = sums[a, :there] + tail[a][:, None] * tail[a:a + there, None, :] \
            - head[a][:, None] * head[a:a + there, None, :]
    return sums


def normal_equations(sums: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Number of windows, means of the inputs and the label, and the covariances of all of these."""
    n, width = SEQUENCE_LENGTH, len(FEATURE_COLS)
    count = sums[0, 0, 0, 0]
    means = np.concatenate([*(sums[0, a, 0, 1:] for a in range(n)), [sums[0, n, 0, 1 + PRICE]]]) / count
    products = np.zeros((n * width + 1, n * width + 1))
    for a in range(n):
        for b in range(a, n):
            products[a * width:(a + 1) * width, b * width:(b + 1) * width] = sums[a, b - a, 1:, 1:]
        products[a * width:(a + 1) * width, -1] = sums[a, n - a, 1:, 1 + PRICE]
    products = np.triu(products)
    products = products + np.triu(products, 1).T
    return count, means, products / count - np.outer(means, means)


def solved(sums: np.ndarray, ridge: float, inputs: list[int] | None) -> tuple[int, float, np.ndarray]:
    """Windows, intercept and weights of the least squares with a ridge; inputs not chosen weigh 0."""
    count, means, covariance = normal_equations(sums)
    chosen = np.arange(len(means) - 1) if inputs is None else np.array(inputs)
    among = covariance[np.ix_(chosen, chosen)] + ridge * np.eye(len(chosen))
    weights = np.zeros(len(means) - 1)
    try:
        lower = np.linalg.cholesky(among)
        weights[chosen] = np.linalg.solve(lower.T, np.linalg.solve(lower, covariance[chosen, -1]))
    except np.linalg.LinAlgError:  # without a ridge inputs may depend on each other
        weights[chosen] = np.linalg.lstsq(among, covariance[chosen, -1], rcond=None)[0]
    return round(count), float(means[-1] - weights @ means[:-1]), weights


def _solve(ridge: float, inputs: list[int] | None):
    def run(key: tuple[pa.Scalar, ...], moments: pa.Table, ends: pa.Table) -> pa.Table:
        out = []
        if moments.num_rows:
            width = len(TERMS)
            lagged = np.zeros((SEQUENCE_LENGTH + 1, width, width))
            at = np.array([TERMS.index(t) for t in moments["term"].to_pylist()])
            np.add.at(lagged, (moments["lag"].to_numpy(), at), np.column_stack([moments[t].to_numpy() for t in TERMS]))
            sides = {}
            for side in ("head", "tail"):
                rows = ends.filter(pa.array([s == side for s in ends["side"].to_pylist()])).sort_by("place")
                sides[side] = np.column_stack([np.ones(rows.num_rows), *(rows[c].to_numpy() for c in FEATURE_COLS)])
            count, intercept, weights = solved(lagged_sums(lagged, **sides), ridge, inputs)
            out.append({"symbol": key[0].as_py(), "windows": count, "intercept": intercept, "weights": weights.tolist()})
        return pa.Table.from_pylist(out, pa.schema({
            "symbol": pa.string(), "windows": pa.int64(), "intercept": pa.float64(), "weights": pa.list_(pa.float64())}))
    return run


def fit_windows(
    series: Ordered, ridge: float = RIDGE, newest: int | None = None, inputs: list[int] | None = None,
    moments: DataFrame | None = None,
) -> DataFrame:
    """(symbol, windows, intercept, weights) for every trainable symbol.

    Least squares of the next price on the ``inputs`` of a scaled window (positions of the flattened
    window; all by default), with a ridge on all weights but the intercept, over the sequences that
    train or the ``newest`` of them. ``moments`` are those of the same range if they are known already.
    """
    sums = window_moments(series, newest) if moments is None else moments
    ends = range_ends(series, newest)
    return sums.groupBy("symbol").cogroup(ends.groupBy("symbol")).applyInArrow(_solve(ridge, inputs), _COEFFICIENTS)


def _block_predictions(key: tuple[pa.Scalar, ...], table: pa.Table, model: pa.Table) -> pa.Table:
    rows, matrix = _in_order(table)
    wanted = np.flatnonzero(rows["wanted"].to_numpy(zero_copy_only=False))
    if not model.num_rows or not len(wanted):
        wanted, guess = wanted[:0], np.zeros(0)
    else:
        weights = np.array(model["weights"][0].as_py()).reshape(SEQUENCE_LENGTH, -1)
        by_place = matrix[:, 1:] @ weights.T
        guess = np.full(len(wanted), model["intercept"][0].as_py())
        for a in range(SEQUENCE_LENGTH):
            guess += by_place[wanted - SEQUENCE_LENGTH + a, a]
    found = rows.select(["symbol", "seq_no", "seq_total", "timestamp", "y"]).take(pa.array(wanted))
    return found.append_column("y_hat", pa.array(guess, pa.float64()))


def predict_series(series: Ordered, coefficients: DataFrame, wanted: Column) -> DataFrame:
    """(symbol, seq_no, seq_total, timestamp, y, y_hat) of the sequences that ``wanted`` picks.

    ``coefficients`` should be a stored table; each block gets its symbol's row of it.
    """
    indexed = index_sequences(series)
    marked = replace(indexed, df=indexed.df.withColumn("wanted", wanted & (F.col("seq_no") > 0)))
    seen = marked.with_history(SEQUENCE_LENGTH).df.withColumn("wanted", F.col("wanted") & ~F.col(CARRIED))
    columns = ["symbol", BLOCK, FROM_END, "wanted", "seq_no", "seq_total", "timestamp", "y", *FEATURE_COLS]
    models = series.blocks.select("symbol", BLOCK).join(coefficients, "symbol") \
        .select(F.col("symbol").alias("_symbol"), F.col(BLOCK).alias("_block"), "intercept", "weights")
    return seen.select(*dict.fromkeys(columns)).groupBy("symbol", BLOCK) \
        .cogroup(models.groupBy("_symbol", "_block")).applyInArrow(_block_predictions, _PREDICTED)


def predict_tests(series: Ordered, coefficients: DataFrame, scaler: DataFrame) -> DataFrame:
    """Actual and predicted prices of the test sequences of every symbol with a model."""
    tested = predict_series(series, coefficients, F.col("seq_no") > trained_sequences())
    return inverse_scale(tested, scaler, {"y": "actual", "y_hat": "predicted"})


@F.arrow_udf(T.BinaryType())
def _packed(weights: pa.Array) -> pa.Array:
    """Weights as bytes, which Spark copies beside each window at once and not one by one; null if any is."""
    return pa.array([None if w is None or None in w else np.array(w, np.float64).tobytes()
                     for w in weights.to_pylist()], pa.binary())


def _models(coefficients: DataFrame) -> DataFrame:
    return coefficients.select("symbol", "intercept", _packed("weights").alias("weights"))


@F.arrow_udf(T.DoubleType())
def _weighted(x: pa.Array, weights: pa.Array) -> pa.Array:
    """Sums of the windows' values times the packed weights; null where a value is, or their numbers differ."""
    models = weights.dictionary_encode()
    of = models.indices.fill_null(-1).to_numpy()
    sums, known = np.zeros(len(x)), np.zeros(len(x), bool)
    for i, packed in enumerate(models.dictionary.to_pylist()):
        model, rows = np.frombuffer(packed, np.float64), np.flatnonzero(of == i)
        own = x.take(pa.array(rows))
        sizes = pc.list_value_length(pc.list_flatten(own)).fill_null(0).to_numpy()
        whole = np.bincount(pc.list_parent_indices(own).to_numpy(), sizes, len(rows)) == len(model)
        rows, values = rows[whole], pc.list_flatten(pc.list_flatten(own.filter(pa.array(whole))))
        sums[rows] = values.to_numpy(zero_copy_only=False).reshape(len(rows), len(model)) @ model
        known[rows] = values.is_valid().to_numpy(zero_copy_only=False).reshape(len(rows), len(model)).all(axis=1) \
            if values.null_count else True
    return pa.array(sums, mask=~known)


def _batch_gradients(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        table = pa.Table.from_batches([batch])
        for symbol in table["symbol"].unique().to_pylist():
            rows = table.filter(pc.equal(table["symbol"], symbol))
            x = pc.list_flatten(pc.list_flatten(rows["x"])).to_numpy().reshape(rows.num_rows, -1)
            left = rows["y"].to_numpy() - rows["intercept"][0].as_py() - x @ np.frombuffer(rows["weights"][0].as_py(), np.float64)
            yield from pa.Table.from_pylist([{
                "symbol": symbol, "windows": rows.num_rows, "residual": float(left.sum()), "products": (left @ x).tolist(),
            }], pa.schema({"symbol": pa.string(), "windows": pa.int64(), "residual": pa.float64(),
                           "products": pa.list_(pa.float64())})).to_batches()


def optimality(sequences: DataFrame, coefficients: DataFrame, ridge: float = RIDGE) -> DataFrame:
    """(symbol, inputs, windows, residual, gradient): how far models are from the least squares.

    ``sequences`` are the cut windows that they were fitted on. The mean residual and the largest partial
    derivative of the mean squared error with the ridge are 0 for the least squares and for no
    other model, so this tells them without solving anything.
    """
    joined = sequences.join(_models(coefficients), "symbol").select("symbol", "x", "y", "intercept", "weights")
    # Stored, since both sums read it and the windows are many.
    parts = materialize(joined.mapInArrow(
        _batch_gradients, "symbol string, windows long, residual double, products array<double>"), "gradients")
    totals = parts.groupBy("symbol").agg(F.sum("windows").alias("windows"), F.sum("residual").alias("residual"))
    at = parts.select("symbol", F.posexplode("products").alias("place", "product")) \
        .groupBy("symbol", "place").agg(F.sum("product").alias("product"))
    weights = coefficients.select("symbol", F.posexplode("weights").alias("place", "weight"))
    return at.join(totals, "symbol").join(weights, ["symbol", "place"]).groupBy("symbol").agg(
        F.count("*").alias("inputs"), F.max("windows").alias("windows"),
        F.max(F.abs(F.col("residual") / F.col("windows"))).alias("residual"),
        F.max(F.abs(F.col("product") / F.col("windows") - ridge * F.col("weight"))).alias("gradient"))


def score_with_table(windows: DataFrame, coefficients: DataFrame) -> DataFrame:
    """``y_hat`` of windows in ``x`` by their symbol's row; symbols without one produce nothing."""
    return windows.join(_models(coefficients), "symbol") \
        .withColumn("y_hat", F.col("intercept") + _weighted("x", "weights")).drop("x", "intercept", "weights")


@dataclass
class WindowModels(Mapping):
    """Models by symbol: rows of a table, and fitted ones of other kinds beside them."""

    table: DataFrame
    others: dict[str, Model] = field(default_factory=dict)
    _symbols: list[str] | None = None

    def _named(self) -> list[str]:
        if self._symbols is None:
            self._symbols = sorted({r["symbol"] for r in self.table.select("symbol").toLocalIterator()} | set(self.others))
        return self._symbols

    def __getitem__(self, symbol: str):
        return self.others.get(symbol) or self.table.where(F.col("symbol") == symbol)

    def __iter__(self) -> Iterator[str]:
        return iter(self._named())

    def __len__(self) -> int:
        return len(self._named())


def stored_models(coefficients: DataFrame) -> WindowModels:
    return WindowModels(materialize(coefficients, "coefficients"))

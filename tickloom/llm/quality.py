"""Quality classifier: a regularised quadratic discriminant over document statistics."""

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import materialize, small_batches

#: Documents scored below this are rejected.
THRESHOLD = 0.3
#: Share of the pooled diagonal in each class covariance.
SHRINKAGE = 0.1
#: Standardised statistics are kept within this many deviations.
REACH = 6.0

_CLASS = np.zeros(256, dtype=np.uint8)  # 0 other ASCII sign, 1 space, 2 lower, 3 upper, 4 digit, 5 non-ASCII
_CLASS[[9, 10, 11, 12, 13, 32]] = 1
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 2, 3, 4, 5
_SIGNS_AT_END = re.compile(rb"[!-/:-@\[-`{-~]{2,}(?=\s|$)")
_STATISTICS = 16


def statistics_of(text: str | None) -> np.ndarray:
    """Statistics of a whole text, already transformed to be roughly symmetric.

    Null counts as empty; an empty text has finite values like any other.
    """
    raw = (text or "").encode("utf-8", "replace")
    words, lines = raw.split(), raw.split(b"\n")
    n, signs, pairs = len(words), len(raw), max(0, len(words) - 1)
    counts = np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=6) if raw else np.zeros(6)
    letters = counts[2] + counts[3] + 1
    kinds = Counter(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    share = lambda part, whole: part / max(whole, 1)
    values = np.array([
        np.log1p(n),
        np.log1p(share(lengths.sum(), n)),
        np.log1p(lengths.std()) if n else 0.0,
        np.sqrt(share(counts[0], signs)),
        np.sqrt(counts[3] / letters),
        np.sqrt(share(counts[4], signs)),
        np.sqrt(share(counts[5], signs)),
        share(counts[1], signs),
        np.log1p(len(kinds)) / np.log(2 + n),
        np.log1p(len(set(zip(words, words[1:])))) / np.log(2 + pairs),
        np.sqrt(share(sum(map(bytes.__eq__, words, words[1:])), pairs)),
        np.sqrt(share(max(kinds.values(), default=0), n)),
        np.sqrt(share(sum(1 for w in words if len(w) == 1 and not w.isalnum()), n)),
        np.sqrt(share(len(_SIGNS_AT_END.findall(raw)), n)),
        len(set(lines)) / len(lines),
        np.log1p(share(n, len(lines))),
    ])
    return values


def _matrix(texts: pd.Series) -> np.ndarray:
    return np.stack([statistics_of(t) for t in texts]) if len(texts) else np.zeros((0, _STATISTICS))


def document_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the array ``statistics`` of every row."""
    @F.pandas_udf("array<double>")
    def measured(texts: pd.Series) -> pd.Series:
        return pd.Series(list(_matrix(texts)))

    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       measured(F.col("text").cast("string")).alias("statistics"))


@dataclass(frozen=True)
class Discriminant:
    """Both classes as Gaussians over standardised statistics.

    ``factors`` are the inverted Cholesky factors of the covariances, computed once, so that a score
    takes one small product for each class. With ``means`` None every score is ``prior``.
    """

    prior: float
    centre: np.ndarray | None = None
    scale: np.ndarray | None = None
    means: np.ndarray | None = None
    factors: np.ndarray | None = None
    log_weights: np.ndarray | None = None

    def scores(self, statistics: np.ndarray) -> np.ndarray:
        """Probability of class 1 from the difference of the Mahalanobis log densities."""
        if self.means is None:
            return np.full(len(statistics), self.prior)
        z = np.clip((statistics - self.centre) / self.scale, -REACH, REACH)
        logs = [w - 0.5 * (((z - m) @ f.T) ** 2).sum(axis=1)
                for m, f, w in zip(self.means, self.factors, self.log_weights)]
        return 1.0 / (1.0 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the documents no label is learned from; also for a null id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(True))


def fit(statistics: DataFrame, labels: DataFrame, label: str = "quality",
        shrinkage: float = SHRINKAGE) -> Discriminant:
    """Fit on all labelled documents outside the held-out fifth.

    The sums of products are gathered by Spark, the driver gets one number for each class and pair
    of statistics. A document whose label rows differ, or are null or neither 0 nor 1, teaches
    nothing. Unless both classes have at least two documents, scores are the smoothed share of 1.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col(label).cast("int").alias("_y")) \
        .where(F.col("_id").isNotNull() & F.col("_y").isin(0, 1) & ~held_out(F.col("_id"))) \
        .groupBy("_id").agg(F.min("_y").alias("_y"), F.max("_y").alias("_z")).where("_y = _z")
    rows = statistics.join(known, F.col("doc_id") == F.col("_id")).select("_y", "statistics")

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = {0: 0.0, 1: 0.0}
        for batch in batches:
            x = np.stack(batch["statistics"]) if len(batch) else np.zeros((0, _STATISTICS))
            x = np.hstack([np.ones((len(x), 1)), x])
            for y in sums:
                of = x[batch["_y"].to_numpy() == y]
                sums[y] = sums[y] + of.T @ of
        d = _STATISTICS + 1
        i, j = (a.ravel() for a in np.indices((d, d)))
        for y, s in sums.items():
            if np.ndim(s):
                yield pd.DataFrame({"y": y, "i": i, "j": j, "s": s.ravel()})

    parts = rows.mapInPandas(moments, "y int, i int, j int, s double")
    found = np.zeros((2, _STATISTICS + 1, _STATISTICS + 1))
    for r in parts.groupBy("y", "i", "j").agg(F.sum("s").alias("s")).collect():
        found[r.y, r.i, r.j] = r.s
    return from_moments(found, shrinkage)


def from_moments(found: np.ndarray, shrinkage: float) -> Discriminant:
    """The discriminant from each class's sums of products of (1, statistics)."""
    n = found[:, 0, 0]
    if n.min() < 2:
        return Discriminant(prior=float((n[1] + 1) / (n.sum() + 2)))
    whole = found.sum(axis=0)
    centre = whole[0, 1:] / n.sum()
    scale = np.sqrt(np.maximum(np.diag(whole)[1:] / n.sum() - centre ** 2, 1e-9))
    means = found[:, 0, 1:] / n[:, None]
    covariances = np.stack([
        (f[1:, 1:] / k - np.outer(m, m)) / np.outer(scale, scale)
        for f, k, m in zip(found, n, means)])
    pooled = np.einsum("c,cij->ij", n / n.sum(), covariances)
    target = np.diag(np.diag(pooled)) + 1e-3 * np.eye(_STATISTICS)
    roots = np.linalg.cholesky((1 - shrinkage) * covariances + shrinkage * target)
    return Discriminant(
        prior=float(n[1] / n.sum()), centre=centre, scale=scale, means=(means - centre) / scale,
        factors=np.linalg.inv(roots),
        log_weights=np.log(n / n.sum()) - np.log(np.diagonal(roots, axis1=1, axis2=2)).sum(axis=1))


def scored(statistics: DataFrame, model: Discriminant, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row."""
    @F.pandas_udf("double")
    def score(values: pd.Series) -> pd.Series:
        return pd.Series(model.scores(np.stack(values)) if len(values) else [], dtype=float)

    return statistics.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score("statistics").alias("score")) \
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Learn from ``labels`` and score every row of ``docs`` from its whole text alone.

    Null texts count as empty; empty texts are scored like any other; repeated rows get a row each;
    a null id is scored and never learned from. An empty table gives no rows, no labels a constant
    score. Extra columns are ignored.
    """
    statistics = materialize(document_statistics(docs), "statistics")
    return scored(statistics, fit(statistics, labels), threshold)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are not rejected, all columns unchanged.

    The statistics are taken twice, once for the fit and once beside the rows: that costs less than
    shuffling the texts to join the scores to them.
    """
    model = fit(document_statistics(docs), labels)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(_matrix(texts)))

    return docs.where(score(F.col("text").cast("string")) >= threshold)

"""Exact top-k search with a vector-approximation file.

Every vector has a small approximation, the cell it falls into in each dimension. A scan of the cells
bounds each inner product from both sides. What can still be among a query's best k by its bounds is
read exactly in the order of the upper bounds, best first, until the kth result is certain: first
the best few, which set the kth score, then only what has a bound at least as high.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import arrow_rows, materialize

SCALE = 1024
K = 10
#: Cells in each dimension; a cell number is one byte.
CELLS = 256
#: Vectors in a chunk of the approximation file, and queries in a block.
CHUNK, BLOCK = 2048, 256


def quantised(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and ``v``, the vector's floor(1024 x), a row for each id.

    Vectors that are null or hold a null, NaN or infinite component take no part, nor do rows without
    an id; of an id's different vectors the smallest is taken. Components of 2 ** 42 and more, whose
    products are far beyond a long, count as infinite.
    """
    x = F.col("embedding")
    odd = F.exists(x, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) >= float(1 << 42)))
    whole = F.transform(x, lambda c: F.floor(c.cast("double") * SCALE))
    return vectors.where(F.col("vec_id").isNotNull() & x.isNotNull() & ~odd) \
        .select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v")) \
        .groupBy("vec_id").agg(F.min("v").alias("v"))


def _matrix(rows: pd.Series, d: int) -> np.ndarray:
    out = np.zeros((len(rows), d), np.int64)
    for i, row in enumerate(rows):
        out[i, :len(row)] = row
    return out


def _packed(rows: DataFrame, d: int, size: int, low: np.ndarray, wide: np.ndarray, cells: bool) -> DataFrame:
    """Rows packed ``size`` at a time and stored: ids and either cell numbers or whole vectors as bytes."""
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            v = _matrix(batch["v"], d)
            if cells:
                v = ((v - low) * CELLS // wide).astype(np.uint8)
            yield pd.DataFrame({"ids": [batch["vec_id"].to_numpy(np.int64).tobytes()], "data": [v.tobytes()]})

    with arrow_rows(rows.sparkSession, size):
        return materialize(rows.mapInPandas(pack, "ids binary, data binary"), "packed")


def candidates(blocks: DataFrame, low: np.ndarray, wide: np.ndarray, k: int) -> DataFrame:
    """Scan (query block, chunk) pairs: what the bounds leave of a chunk for each query.

    Whatever has an upper bound below the kth lower bound of the chunks that the task has seen for
    the query is out, so what a task passes on hardly grows with its chunks.
    """
    d = len(low)
    first = -(-np.arange(CELLS)[:, None] * wide // CELLS)  # smallest offset in each cell
    last = np.vstack([first[1:], wide[None, :]]) - 1

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        dims, best = np.arange(d), {}  # best: the k largest lower bounds of each query of a block
        for batch in batches:
            for q_ids, q_data, ids, data in zip(batch["q_ids"], batch["q_data"], batch["ids"], batch["data"]):
                block = q_ids
                q_ids, ids = np.frombuffer(q_ids, np.int64), np.frombuffer(ids, np.int64)
                q = np.frombuffer(q_data, np.int64).reshape(-1, d).astype(float)
                cell = np.frombuffer(data, np.uint8).reshape(-1, d)
                lo, hi = (low + first[cell, dims]).astype(float), (low + last[cell, dims]).astype(float)
                up, down = np.maximum(q, 0), np.minimum(q, 0)
                upper, lower = up @ hi.T + down @ lo.T, up @ lo.T + down @ hi.T
                # Sums of doubles are off by no more than this; whole numbers below 2 ** 53 not at all.
                slack = np.abs(q) @ np.maximum(np.abs(lo), np.abs(hi)).T * ((d + 2) * np.finfo(float).eps)
                upper, lower = upper + slack, lower - slack
                own = q_ids[:, None] == ids[None, :]
                lower[own] = -np.inf
                upper[own] = -np.inf
                seen = np.hstack([best.get(block, np.full((len(q), k), -np.inf)), lower])
                best[block] = np.partition(seen, -k, axis=1)[:, -k:]
                i, j = np.nonzero((upper >= best[block].min(axis=1)[:, None]) & ~own)
                yield pd.DataFrame({"query_id": q_ids[i], "vec_id": ids[j], "upper": upper[i, j], "lower": lower[i, j]})

    return blocks.mapInPandas(scan, "query_id long, vec_id long, upper double, lower double")


def _scores(pairs: DataFrame, vectors: DataFrame, large: bool) -> DataFrame:
    """Exact inner products; a missing component counts as zero.

    ``large`` ones are summed as decimals of 38 digits.
    """
    kind = "decimal(38,0)" if large else "long"

    def times(a: Column, b: Column) -> Column:
        return (a.cast("decimal(19,0)") * b.cast("decimal(19,0)")).cast(kind) if large else a * b

    product = F.aggregate(
        F.zip_with("qv", "v", lambda a, b: F.coalesce(times(a, b), F.lit(0).cast(kind))), F.lit(0).cast(kind),
        lambda s, x: (s + x).cast(kind))
    queries = vectors.select(F.col("vec_id").alias("q"), F.col("v").alias("qv"))
    return pairs.join(vectors, "vec_id").join(queries, F.col("query_id") == F.col("q")) \
        .select("query_id", "vec_id", product.alias("score"))


def top_k(vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the k best other vectors of each query.

    ``is_query`` is a condition on ``vec_id``. Score is the integer inner product, ties go to the smaller
    id; a query with fewer others has them all. Of vectors that are equal, only the k + 1 smallest
    ids can be in any result, so the rest are left out before the scan. Vectors of different lengths
    are filled up with zeros. Scores beyond a long rank by their true value and show the nearest long. An
    empty table gives no rows; extra columns are ignored.
    """
    spark = vectors.sparkSession
    exact = materialize(quantised(vectors), "vectors")
    nearest = Window.partitionBy("v").orderBy("vec_id")
    shown = materialize(exact.withColumn("n", F.row_number().over(nearest)).where(F.col("n") <= k + 1)
                        .select("vec_id", "v"), "candidates")
    ranges = shown.select(F.posexplode("v").alias("pos", "x")).groupBy("pos") \
        .agg(F.min("x").alias("low"), F.max("x").alias("high")).collect()
    d = len(ranges)
    low, wide = np.zeros(max(d, 1), np.int64), np.ones(max(d, 1), np.int64)
    for r in ranges:  # shorter vectors have zeros there
        low[r.pos] = min(r.low, 0)
        wide[r.pos] = max(r.high, 0) - low[r.pos] + 1
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    large = sum(max(abs(int(a)), abs(int(a) + int(w))) ** 2 for a, w in zip(low, wide)) >= 1 << 62
    chunks = _packed(shown.repartition(parts, "vec_id"), len(low), CHUNK, low, wide, cells=True)
    # Queries go to fewer partitions, so that their blocks are filled.
    few = max(1, min(parts, exact.where(is_query).count() // BLOCK))
    asked = _packed(exact.where(is_query).repartition(few, "vec_id"), len(low), BLOCK, low, wide, cells=False)
    # Groups of chunks and of blocks meet in the cells of a grid, about one for each partition.
    across = max(1, min(asked.count(), round(parts ** 0.5)))
    down = -(-parts // across)
    dealt = asked.select(
        F.col("ids").alias("q_ids"), F.col("data").alias("q_data"),
        F.pmod(F.xxhash64("ids"), F.lit(across)).alias("column"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(down - 1).cast("long"))).alias("row"))
    spread = chunks.withColumn("row", F.pmod(F.xxhash64("ids"), F.lit(down))).withColumn(
        "column", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(across - 1).cast("long"))))
    # Spark's estimate misses the copies that explode makes, so it must not choose a broadcast.
    pairs = spread.join(dealt.hint("merge"), ["row", "column"]).select("q_ids", "q_data", "ids", "data")
    with arrow_rows(spark, 16):  # a row holds a block and a chunk
        found = materialize(candidates(pairs, low, wide, k), "bounds")
    by_lower = Window.partitionBy("query_id").orderBy(F.col("lower").desc(), "vec_id")
    floor = found.withColumn("n", F.row_number().over(by_lower)).where(F.col("n") <= k) \
        .groupBy("query_id").agg(F.min("lower").alias("floor"), F.count("*").alias("m")) \
        .select(F.col("query_id").alias("q"), F.when(F.col("m") == k, F.col("floor")).alias("floor"))
    alive = materialize(found.join(floor, F.col("query_id") == F.col("q"), "left").where(
        F.col("floor").isNull() | (F.col("upper") >= F.col("floor"))).select("query_id", "vec_id", "upper"), "alive")
    by_upper = Window.partitionBy("query_id").orderBy(F.col("upper").desc(), "vec_id")
    first = alive.withColumn("n", F.row_number().over(by_upper)).where(F.col("n") <= 2 * k)
    best = materialize(_scores(first.select("query_id", "vec_id"), exact, large), "first-read")
    ranked = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    kth = best.withColumn("n", F.row_number().over(ranked)).where(F.col("n") == k) \
        .select(F.col("query_id").alias("q"), F.col("score").alias("kth"))
    # Queries without a kth score have had all their candidates read already.
    more = alive.join(best.select("query_id", "vec_id"), ["query_id", "vec_id"], "left_anti") \
        .join(kth, (F.col("query_id") == F.col("q")) & (F.col("upper") >= F.col("kth")))
    scores = best.unionByName(_scores(more.select("query_id", "vec_id"), exact, large))
    shown = F.least(F.greatest(F.col("score"), F.lit(-(1 << 63))), F.lit((1 << 63) - 1)).cast("long")
    return scores.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", shown.alias("score"))

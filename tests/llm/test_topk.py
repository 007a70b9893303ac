import numpy as np
from conftest import SF_DIR
from pyspark.sql import functions as F

from tickloom.llm import topk


def expected(rows, queries, k=10):
    out = []
    for q, v in rows:
        if q % queries:
            continue
        scores = sorted(((-sum(a * b for a, b in zip(v, w)), i) for i, w in rows if i != q))[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    return sorted(out)


def check(vectors, queries=100, k=10):
    rows = {}
    for r in vectors.collect():
        if r.vec_id is None or r.embedding is None or not all(x is not None and np.isfinite(x) for x in r.embedding):
            continue
        v = [int(np.floor(1024 * float(x))) for x in r.embedding]
        rows[r.vec_id] = min(v, rows.get(r.vec_id, v))
    found = topk.top_k(vectors, F.col("vec_id") % queries == 0, k).collect()
    assert sorted(map(tuple, found)) == expected(sorted(rows.items()), queries, k)


def test_embeddings(spark):
    check(spark.read.parquet(f"{SF_DIR.replace('sf0.001', 'sf0.01')}/embeddings.parquet").limit(450), 10)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.25]), (1, [0.5, -0.25]), (2, None), (3, [nan, 1.0]), (4, [inf, 0.0]), (5, [None, 1.0]), (None, [1.0, 1.0]),
            (6, []), (7, [3.0]), (8, [0.1, 0.2, 0.3]), (9, [0.0, 0.0]), (10, [0.5, -0.25]), (10, [0.5, -0.25]), (10, [0.75, 0.0]), (20, [-1.0, 2.0])]
    vectors = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, v string, ids int")
    check(vectors, 10, 3)
    check(vectors, 10, 20)
    assert topk.top_k(vectors.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_one_vector_fills_a_third(spark):
    draw = np.random.default_rng(2)
    rows = [(i, ([0.25] * 8 if i % 3 == 0 else draw.normal(size=8).tolist())) for i in range(900)]
    check(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 50)


def test_large_components(spark):
    """Scores of more bits than a double or a long has, and components that a long can't hold."""
    draw = np.random.default_rng(3)
    for size in (1e12, 1e5, 3e9):
        rows = [(i, [float(x) for x in draw.normal(size=4) * size]) for i in range(60)] + [(100, [1e300, 0.0, 0.0, 0.0])]
        vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        q = {i: [int(np.floor(1024 * x)) for x in v] for i, v in rows if max(map(abs, v)) < 1 << 42}
        found = topk.top_k(vectors, F.col("vec_id") % 10 == 0, 5).collect()
        wanted = expected(sorted(q.items()), 10, 5)
        clamped = [(a, b, c, max(-(1 << 63), min((1 << 63) - 1, s))) for a, b, c, s in wanted]
        assert sorted(map(tuple, found)) == clamped

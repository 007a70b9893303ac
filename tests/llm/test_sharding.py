import zlib
from collections import Counter

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from tickloom.llm import sharding
from tickloom.llm.common import documents


def check(docs, shards):
    rows = docs.collect()
    found = sharding.kd_shards(docs, shards).toPandas()
    wanted = Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in rows)
    given = Counter((None if i != i else int(i), s, c) for i, s, c in zip(found.doc_id, found["size"], found.text_crc32))
    assert given == wanted
    assert found.shard.between(0, shards - 1).all()
    for _, g in found.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    return found


def test_sizes_near_equal_and_copies_together(spark):
    docs = documents(spark, SF_DIR.replace("sf0.001", "sf0.1"))
    found = check(docs, 16)
    sums = found.groupby("shard")["size"].sum()
    assert len(sums) == 16 and sums.max() / sums.mean() < 1.03 and sums.min() / sums.mean() > 0.97
    assert (found.groupby(["size", "text_crc32"]).shard.nunique() == 1).all()


def tree(points, names, shards, root=None, first=0):
    """The same cuts over all points in memory: {shard: points}."""
    root = root or {n: (min(p[n] for p in points), max(p[n] for p in points)) for n in names}
    if shards == 1:
        return {first: points}
    total, half = sum(p["size"] for p in points), shards // 2
    goal, found = total * half / shards, []
    for n in names:
        values = sorted({p[n] for p in points})
        cuts = [(abs(sum(p["size"] for p in points if p[n] < v) - goal), v) for v in values[1:]]
        if cuts:
            wide = (values[-1] - values[0]) / max(1, root[n][1] - root[n][0])
            found.append((wide, *min(cuts), n))
    if not found:
        return {first: points}
    found.sort(key=lambda x: -x[0])
    _, _, place, name = next((f for f in found if f[1] <= total / shards * sharding.TOLERANCE), min(found, key=lambda x: x[1]))
    left, right = ([p for p in points if (p[name] < place) == side] for side in (True, False))
    return tree(left, names, half, root, first) | tree(right, names, shards - half, root, first + half)


@pytest.mark.parametrize("shards", [2, 5, 16])
def test_cuts_are_those_of_a_tree_in_memory(spark, shards):
    docs = documents(spark, SF_DIR)
    points, names = sharding.points_of(docs, shards)
    rows = [r.asDict() for r in points.collect()]
    wanted = {(p["doc_id"], p["text_crc32"]): shard for shard, own in tree(rows, names, shards).items() for p in own}
    found = {(r.doc_id, r.text_crc32): r.shard for r in sharding.kd_shards(docs, shards).collect()}
    assert found == wanted


def test_few_jobs(spark):
    points, names = sharding.points_of(documents(spark, SF_DIR.replace("sf0.001", "sf0.01")))
    spark.sparkContext.setJobGroup("tree", "tree")
    try:
        leaves = sharding.kd_tree(points, names)
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("tree"))
    finally:
        spark.sparkContext._jsc.sc().clearJobGroup()
    assert len(leaves) == 16 and jobs <= 40


def test_sizes_differ_by_no_more_than_the_largest_text(spark):
    found = sharding.kd_shards(documents(spark, SF_DIR.replace("sf0.001", "sf0.01"))).groupBy("shard").agg(
        F.sum("size").alias("size"), F.max("size").alias("largest")).collect()
    mean = sum(r["size"] for r in found) / 16
    assert len(found) == 16 and all(abs(r["size"] - mean) <= max(0.01 * mean, r.largest) for r in found)
    assert sum(abs(r["size"] - mean) <= 0.011 * mean for r in found) >= 14


def test_edge_rows(edge_docs, no_docs):
    check(edge_docs, 4)
    assert sharding.kd_shards(no_docs).count() == 0


def test_copies_beyond_a_shard_are_dealt_out(spark):
    copies = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("the same text " * 20).alias("text"))
    others = spark.range(1000, 2000).select(F.col("id").alias("doc_id"), F.concat(F.lit("other " * 30), F.col("id")).alias("text"))
    found = check(copies.union(others), 16)
    sums = found.groupby("shard")["size"].sum()
    assert len(sums) == 16 and sums.max() / sums.mean() < 1.05


def test_one_text_without_ids(spark):
    check(spark.createDataFrame([(None, "x")] * 30, "doc_id long, text string"), 4)


def test_target_bytes(spark):
    docs = documents(spark, SF_DIR)
    total = sum(len(r.text.encode()) + 1 for r in docs.collect())
    found = sharding.kd_shards(docs, target_bytes=total // 5).toPandas()
    assert found.shard.nunique() == 5

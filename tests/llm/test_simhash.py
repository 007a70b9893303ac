from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tickloom.llm import simhash
from tickloom.llm.common import materialize


def slow_fingerprint(text, n=4):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = lower.encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes, distance=4):
    """Smallest label that links lead to, by the fingerprint."""
    label = dict(nodes)
    while True:
        after = {a: min(label[b] for b in label if (a ^ b).bit_count() <= distance) for a in label}
        if after == label:
            return label
        label = after


def test_fingerprints_match_the_definition(edge_docs):
    found = simhash.near_duplicates(edge_docs).collect()
    texts = sorted((repr(r.doc_id), f"{slow_fingerprint(r.text):016x}") for r in edge_docs.collect())
    assert sorted((repr(r.doc_id), r.fingerprint) for r in found) == texts


def test_components_of_edge_rows(edge_docs, no_docs):
    rows = [(r.doc_id, slow_fingerprint(r.text)) for r in edge_docs.collect()]
    far = 1 << 62
    nodes = {fp: min((i if i is not None else far) for i, f in rows if f == fp) for _, fp in rows}
    label = components(nodes)
    wanted = sorted(repr((i, label[fp] if label[fp] != far else None)) for i, fp in rows)
    assert sorted(repr((r.doc_id, r.component_id)) for r in simhash.near_duplicates(edge_docs).collect()) == wanted
    assert simhash.near_duplicates(no_docs).count() == 0


def test_links_lose_no_component(spark):
    draw = np.random.default_rng(5)
    centres = draw.integers(0, 1 << 63, 60, dtype=np.uint64)
    values = set(centres.tolist())
    for c in centres[:30].tolist():  # chains and clusters around some of them
        x = c
        for _ in range(40):
            for b in draw.choice(64, draw.integers(1, 5), replace=False).tolist():
                x ^= 1 << b
            values.add(x)
    values |= {0, (1 << 64) - 1, 15, 16 + 15}
    rows = [(int(np.uint64(v).view(np.int64)), i) for i, v in enumerate(sorted(values))]
    distinct = spark.createDataFrame(rows, "fp long, id long").select("fp", F.struct("id", "fp").alias("label"))
    wanted = components({int(np.int64(fp).view(np.uint64)): i for fp, i in rows})
    for block in (simhash.BLOCK, 8):  # the second cuts buckets into pieces
        found = simhash.components(distinct, simhash.links(distinct, 4, block)).collect()
        assert {int(np.int64(r.fp).view(np.uint64)): r.label.id for r in found} == wanted


@pytest.mark.parametrize("mixed", [False, True])
def test_long_chains_take_few_rounds(spark, monkeypatch, mixed):
    """A chain of a thousand, with labels in the order of the chain and in any other, and a ring."""
    order = np.random.default_rng(8).permutation(1000).tolist() if mixed else list(range(1000))
    distinct = spark.createDataFrame([(i, order[i]) for i in range(1000)] + [(i, i) for i in range(2000, 2040)], "fp long, id long") \
        .select("fp", F.struct("id", "fp").alias("label"))
    edges = spark.createDataFrame(
        [(i, i + 1) for i in range(999)] + [(2000 + i, 2000 + (i + 1) % 40) for i in range(40)], "a long, b long")
    stored = []

    def counting(df, name):
        stored.append(name)
        return materialize(df, name)
    monkeypatch.setattr(simhash, "materialize", counting)
    found = {r.fp: r.label.id for r in simhash.components(distinct, edges).collect()}
    assert len(stored) <= 25
    assert all(found[i] == 0 for i in range(1000)) and all(found[i] == 2000 for i in range(2000, 2040))


def test_plan_covers_every_pair_within_the_distance():
    draw = np.random.default_rng(6)
    sample = draw.integers(0, 1 << 63, 300, dtype=np.uint64)
    for total in (300, 10 ** 7):
        parts = simhash.plan(sample, total)
        masks = simhash._masks(parts)
        for _ in range(300):
            bits = draw.choice(64, 4, replace=False)
            apart = sum(1 << int(b) for b in bits)
            assert any(mask & apart == 0 for mask in masks)
        bits = [b for own, _ in parts for b in own]
        assert len(bits) == len(set(bits))


def test_keep_one_of_each_component(edge_docs, spark):
    more = edge_docs.union(edge_docs)
    kept = simhash.keep_one(more)
    rows = [(r.doc_id, slow_fingerprint(r.text)) for r in edge_docs.collect()]
    far = 1 << 62
    nodes = {fp: (min((i if i is not None else far) for i, f in rows if f == fp), fp) for _, fp in rows}
    label = components(nodes)
    found = [(r.doc_id if r.doc_id is not None else far, slow_fingerprint(r.text)) for r in kept.collect()]
    assert kept.columns == edge_docs.columns
    assert sorted(label[fp] for _, fp in found) == sorted(set(label.values()))
    assert all(i == label[fp][0] for i, fp in found)


def test_near_pairs_are_in_one_component(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(300)) + " end" * (i % 2)) for i in range(6)]
    found = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    near = {(a.doc_id, b.doc_id): (int(a.fingerprint, 16) ^ int(b.fingerprint, 16)).bit_count() <= 4
            for a, b in combinations(found, 2)}
    assert all({r.component_id for r in found if r.doc_id in pair} == {0} for pair, n in near.items() if n)

import re

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from tickloom.llm import mixing
from tickloom.llm.common import documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def wanted_targets(sizes):
    """Share by weight, hold what is above its limit, share the excess again."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    total, held = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in held)
        weights = sum(weight[s] for s in names if s not in held)
        target = {s: 3 * sizes[s] if s in held else left * weight[s] / weights for s in names}
        over = {s for s in names if s not in held and target[s] > 3 * sizes[s]}
        if not over:
            return target
        held |= over


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 1000, "c": 5, None: 70}, {"b": 10, "a": 0, "é": 300, "Z": 2, "😀": 1},
    {"a": 7}, {None: 7}, {"a": 0, "b": 0}, {f"s{i:02d}": 3 ** (i % 9) for i in range(40)}])
def test_targets(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, size long")
    found = {r.source: r.target for r in mixing.targets(rows).collect()}
    assert found == pytest.approx(wanted_targets(sizes))


def check(docs):
    rows = docs.collect()
    found = mixing.mix_counts(docs).collect()
    assert len(found) == len(rows)
    assert sorted(r["size"] for r in found) == sorted(len(WORD.findall(r.text or "")) for r in rows)
    sums = {}
    for r in rows:
        sums[r.source] = sums.get(r.source, 0) + len(WORD.findall(r.text or ""))
    targets = wanted_targets(sums)
    by_target = {}
    for r in found:
        assert 0 <= r.taken <= 3 * r["size"]
        by_target.setdefault(r.target, [0, r.source_size])[0] += r.taken
    assert sorted(by_target) == pytest.approx(sorted(set(targets.values())))
    same = [t for t in targets.values()]
    for target, (taken, _) in by_target.items():
        assert abs(taken - target * sum(abs(target - t) < 1e-9 for t in same)) <= 2 * len(same)
    again = mixing.mix_counts(docs.repartition(5)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, found))


def test_edge_rows(edge_docs, no_docs):
    check(edge_docs)
    assert mixing.mix_counts(no_docs).count() == 0
    assert mixing.mixed_documents(no_docs).count() == 0


def test_no_words_at_all(spark, edge_docs):
    found = mixing.mix_counts(edge_docs.where("text is null or text = ''")).collect()
    assert {(r.target, r.taken) for r in found} == {(0.0, 0)}


def test_slots_read_every_block_once_in_a_pass(spark):
    plan = spark.createDataFrame([("a", 1000, 2300.0), ("b", 64, 64.0), ("c", 5, 15.0), ("d", 640, 100.0)],
                                 "source string, source_size long, target double")
    found = mixing.slots(plan, block=64, shards=4).toPandas()
    for source, size, target in (("a", 1000, 2300), ("b", 64, 64), ("c", 5, 15), ("d", 640, 100)):
        own = found[found.source == source]
        assert own.use.sum() == target and own.slot.is_unique
        for _, g in own.groupby("epoch"):
            assert g["index"].is_unique and g["index"].max() < -(-size // 64)
    assert found.shard.between(0, 3).all()


def test_shards_take_sources_in_proportion(spark):
    docs = spark.createDataFrame([(i, "w " * 640, f"s{i % 3}") for i in range(90)], "doc_id long, text string, source string")
    rows = mixing.sized_rows(docs)
    _, mix = mixing.spans(rows, mixing.targets(rows), block=16, shards=4)
    counts = mix.groupBy("shard", "source").agg(F.sum("n").alias("n")).toPandas().pivot(index="shard", columns="source", values="n")
    share = counts.div(counts.sum(axis=1), axis=0)
    assert ((share - [1 / 6, 2 / 6, 3 / 6]).abs() < 0.05).all().all()


def test_shards_have_the_slots_that_were_drawn_for_them(spark, monkeypatch):
    plan = spark.createDataFrame([("a", 64_000, 150_000.0), ("b", 640, 640.0), (None, 5, 15.0)],
                                 "source string, source_size long, target double")
    drawn = []
    draw = mixing.shard_counts

    def watched(chunks, shards):
        drawn.append(draw(chunks, shards))
        return drawn[-1]
    monkeypatch.setattr(mixing, "shard_counts", watched)
    found = mixing.slots(plan, block=64, shards=4).groupBy("source", "shard").agg(
        F.count("*").alias("n"), F.min("slot").alias("low"), F.max("slot").alias("high")).collect()
    wanted = {(r.source, r.shard): r.slots for r in drawn[0].collect()}
    assert {(r.source, r.shard): r.n for r in found} == wanted
    assert all(r.high - r.low + 1 == r.n for r in found)  # one after the other
    sizes = [n for (source, _), n in wanted.items() if source == "a"]
    assert len(sizes) == 4 and sum(sizes) == 2344 and 500 < min(sizes) and max(sizes) < 680


def test_mixed_documents_hold_the_words_that_are_counted(edge_docs):
    counts = mixing.mix_counts(edge_docs).collect()
    mixed = mixing.mixed_documents(edge_docs)
    rows = mixed.collect()
    assert mixed.columns == edge_docs.columns
    assert sum(len(WORD.findall(r.text)) for r in rows) == sum(r.taken for r in counts)
    for doc_id in (1, 5, 11, 20, 22):
        taken = sum(r.taken for r in counts if r.doc_id == doc_id)
        assert sum(len(WORD.findall(r.text)) for r in rows if r.doc_id == doc_id) == taken
    assert all(r.n_chars == len(r.text) for r in rows)


def test_mixed_texts_come_from_their_documents(spark):
    docs = documents(spark, SF_DIR)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in mixing.mixed_documents(docs).collect():
        whole = texts[r.doc_id]
        assert r.text == whole or set(WORD.findall(r.text)) <= set(WORD.findall(whole))


def test_permutation_scatters_the_blocks_differently_in_each_pass(spark):
    sizes = (2, 3, 6, 7, 14, 154, 2000)
    plan = spark.createDataFrame([(f"s{n}", n * 64 - 5, 2.5 * (n * 64 - 5)) for n in sizes], "source string, source_size long, target double")
    found = mixing.slots(plan, block=64, shards=4).toPandas().sort_values("slot")
    for n in sizes:
        own = [g["index"].to_numpy() for _, g in found[found.source == f"s{n}"].groupby("epoch")]
        assert len(own) == 3 and all(sorted(g) == list(range(n)) for g in own[:2])
        if n > 100:
            assert not any(((g[1:] - g[:-1]) % n == (g[1] - g[0]) % n).mean() > 0.1 for g in own)
            assert (own[0] == own[1]).mean() < 0.1 and abs(own[2].mean() / n - 0.5) < 0.15

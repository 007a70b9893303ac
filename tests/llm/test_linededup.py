import re
from collections import defaultdict

from pyspark.sql import functions as F

from tickloom.llm import linededup


def key_of(line):
    return re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line).translate(
        str.maketrans(linededup.UPPER, linededup.LOWER))


def expected(rows):
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            holders[key_of(line)].add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            ids = holders[key_of(line)]
            first = min((x for x in ids if x is not None), default=None)
            if len(key_of(line)) < 10 or len(ids) < 2 or i == first:
                kept.append(line)
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def check(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = linededup.dedup_lines(docs).collect()
    assert sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in found), key=repr) == expected(rows)


def test_edge_rows(edge_docs, no_docs):
    check(edge_docs)
    assert linededup.dedup_lines(no_docs).count() == 0


def test_long_documents_and_a_hot_line(spark):
    texts = [(i, "\n".join(f"a line that repeats, number {j * (i % 3 + 1)}" for j in range(400)) + "\nthe hot line of them all") for i in range(40)]
    check(spark.createDataFrame(texts, "doc_id long, text string").repartition(7))


def test_bitmap_skips_words_without_drops(spark):
    shared = "a shared line to drop"
    texts = [(1, shared), (2, "\n".join(f"unique line {i:06d}" for i in range(300)) + "\n" + shared)]
    docs = spark.createDataFrame(texts, "id long, text string")
    keep = linededup.keep_bitmaps(docs).collect()
    assert len(keep) == 1 and [x.skip for x in keep[0].keep] == [4] and keep[0].n_dropped == 1
    assert keep[0].keep[0].bits == ~(1 << (300 % 64))


def test_stage_keeps_the_columns(edge_docs):
    found = linededup.kept_documents(edge_docs)
    assert found.columns == edge_docs.columns and found.count() == edge_docs.count()
    assert found.where(F.col("n_chars") != F.char_length("text")).count() == 0

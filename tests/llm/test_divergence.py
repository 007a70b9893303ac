import re
import subprocess
import sys
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

from tickloom.llm import divergence

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(rows, top_terms=200):
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        counts[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
    out = []
    for lang in docs:
        kept = [t for t, n in docs[lang].items() if n >= 3]
        own = {s: {t: c[t] for t in kept} for (x, s), c in counts.items() if x == lang}
        whole = {t: sum(c[t] for c in own.values()) for t in kept}

        def shares(c):
            return {t: 1 + 10 ** 9 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept}

        q = shares(whole)
        for source, c in own.items():
            p = shares(c)
            pairs = [(-sum((p[t] - r) ** 2 // r for t, r in shares(d).items()), s.encode(), s) for s, d in own.items() if s != source]
            terms = [(-((p[t] - q[t]) ** 2 // q[t]), t.encode(), t) for t in kept if c[t] and p[t] > q[t]]
            for part, items in (("pair", pairs), ("term", sorted(terms)[:top_terms])):
                out += [(lang, source, part, item, -value, i + 1) for i, (value, _, item) in enumerate(sorted(items))]
    return sorted(out)


def check(docs, **more):
    rows = [(r.lang, r.source, r.text) for r in docs.select("lang", "source", "text").collect()]
    assert sorted(tuple(r) for r in divergence.audit(docs, **more).collect()) == expected(rows, more.get("top_terms", 200))


def test_edge_rows(edge_docs, no_docs):
    check(edge_docs)
    assert divergence.audit(no_docs).count() == 0


@pytest.fixture(scope="module")
def mixed(spark):
    rng = np.random.default_rng(3)
    words = [f"{a}{b}" for a in "abcdefghijÄé" for b in "klmnopqrst漢ß"]
    rows = []
    for i in range(400):
        source = None if i % 50 == 0 else "hot" if i % 3 == 0 else f"s{i % 7}"
        own = rng.choice(words[:90 + 10 * (i % 7)], rng.integers(0, 60))
        rows.append((["en", "de", None][i % 5 % 3], source, "-".join(own).upper() if i % 2 else " 7".join(own)))
    rows += [("zz", "few", "once only here"), ("zz", "none", "1234 !"), ("one", "alone", "a b a"), ("one", "alone", "a b"), ("one", "alone", "a")]
    return spark.createDataFrame(rows, "lang string, source string, text string").repartition(6)


def test_groups_terms_and_ties(mixed):
    check(mixed)
    check(mixed, top_terms=5)


def test_small_shards_and_early_partial_counts(mixed, monkeypatch):
    monkeypatch.setattr(divergence, "HELD_ROWS", 40)
    check(mixed, cells=64)


def test_share_is_exact_beyond_a_long():
    for count, total in ((1, 3), (8 * 10 ** 15, 8 * 10 ** 15 + 7), (12_345_678_901, 98_765_432_109_876)):
        found = divergence.share(np.array([count]), np.array([total]))
        assert found.tolist() == [1 + 10 ** 9 * count // total]


#: Texts of 2.4 million different terms, and the most that Arrow took to count them, in a process of its own.
MANY_TERMS = """
import pyarrow as pa
from tickloom.llm import divergence
letters = str.maketrans("0123456789", "ghijklmnop")
def batches():
    for i in range(40):
        texts = [" ".join(f"{n:x}".translate(letters) for n in range(60 * j, 60 * j + 60)) for j in range(1000 * i, 1000 * i + 1000)]
        yield pa.RecordBatch.from_pydict({"lang": ["en"] * 1000, "source": ["web"] * 1000, "text": texts})
rows = sum(b.num_rows for b in divergence.partial_counts(batches()))
print(rows, pa.default_memory_pool().max_memory() >> 20)
"""


def test_a_task_holds_few_partial_counts():
    found = subprocess.run([sys.executable, "-c", MANY_TERMS], capture_output=True, text=True, check=True,
                           cwd=Path(divergence.__file__).parents[2])
    rows, megabytes = map(int, found.stdout.split())
    assert rows >= 2_400_000 and megabytes < 128

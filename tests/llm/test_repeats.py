import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tickloom.llm import queries, repeats


def expected(rows, least):
    raws = [(text or "").encode() for _, text in rows]
    held = Counter(r[i:i + least] for r in raws for i in range(len(r) - least + 1))
    out = []
    for (doc_id, _), r in zip(rows, raws):
        gone = np.zeros(len(r), bool)
        for i in range(len(r) - least + 1):
            if held[r[i:i + least]] > 1:
                gone[i:i + least] = True
        edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]])))
        out.append((doc_id, len(r), [tuple(x) for x in edge.reshape(-1, 2).tolist()], bytes(np.frombuffer(r, np.uint8)[~gone])))
    return sorted(out, key=repr)


def check(docs, least, **more):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    found = [(r.doc_id, r.n_bytes, [(x.start, x.end) for x in r.spans], bytes(r.kept))
             for r in repeats.without_repeats(docs, least, **more).collect()]
    assert sorted(found, key=repr) == expected(rows, least)


def test_edge_rows(edge_docs, no_docs):
    check(edge_docs, repeats.LEAST)
    assert repeats.without_repeats(no_docs).count() == 0


def test_no_text_is_long_enough(spark):
    check(spark.createDataFrame([(1, "short"), (2, "short"), (3, None)], "doc_id long, text string"), repeats.LEAST)


def noise(rng, n):
    return "".join(rng.choice(list("abcdefgh ijklm\nnopéq"), n))


@pytest.fixture(scope="module")
def planted(spark):
    """Passages within other text, near copies, copies, periods, and a passage that most texts share."""
    rng = np.random.default_rng(5)
    passages, hot = [noise(rng, 90) for _ in range(4)], noise(rng, 75)
    texts = ["a" * 700, "a" * 300, "ab" * 200, "abc" * 50, "", None, "x", noise(rng, 3000)]
    texts += [noise(rng, int(rng.integers(0, 80))) + passages[i % 4] + noise(rng, int(rng.integers(0, 80))) for i in range(12)]
    texts += [noise(rng, 60) + hot + noise(rng, 60) for _ in range(120)]
    near = noise(rng, 400)
    texts += [near[:k] + "#" + near[k + 1:] for k in range(0, 400, 40)] + [near] * 3 + [passages[0][:50] + passages[0][:50]]
    return spark.createDataFrame([(i % 150, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(6)


@pytest.mark.parametrize("least, gram, block", [(60, 16, 1 << 20), (60, 16, 1500), (60, 60, 300), (7, 3, 4000)])
def test_planted_repeats(planted, least, gram, block):
    check(planted, least, gram=gram, block_bytes=block)


def test_crowded_anchors_are_split_until_they_fit(planted, monkeypatch):
    sizes = []
    find = repeats._block_repeats

    def watched(least):
        sizes.append(least)
        return find(least)
    monkeypatch.setattr(repeats, "_block_repeats", watched)
    check(planted, 60, gram=16, block_bytes=1500)
    assert len(sizes) > 1


def brute_starts(bodies, weights, least):
    held = Counter()
    for b, n in zip(bodies, weights):
        for i in range(len(b) - least + 1):
            held[b[i:i + least]] += n
    return [[i for i in range(len(b) - least + 1) if held[b[i:i + least]] > 1] for b in bodies]


def test_intervals_find_what_counting_finds():
    rng = np.random.default_rng(0)
    for trial in range(60):
        least = int(rng.integers(1, 30))
        base = bytes(rng.integers(97, 100, 200).astype(np.uint8))
        bodies = []
        for _ in range(rng.integers(1, 8)):
            a, b = sorted(rng.integers(0, 200, 2))
            tail = bytes(rng.integers(0, 256 if trial % 2 else 2, rng.integers(0, 40)).astype(np.uint8))
            body = b"a" * int(rng.integers(0, 80)) if rng.random() < 0.3 else base[a:b] + tail
            bodies.append(body if len(body) >= least else body + b"z" * least)
        weights = rng.integers(1, 3, len(bodies))
        assert [x.tolist() for x in repeats.repeated_windows(bodies, weights, least)] == brute_starts(bodies, weights, least)


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(1)
    for _ in range(20):
        least = int(rng.integers(4, 40))
        gram, chunk = int(rng.integers(1, least + 1)), int(rng.choice([50, 1000]))
        texts = [bytes(rng.integers(97, 99, rng.integers(0, 200)).astype(np.uint8)) for _ in range(6)] + [b"a" * 90, b"ab" * 60]
        data = np.frombuffer(b"".join(texts), np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in texts])])
        runs = repeats.anchor_runs(data, offsets, repeats.Grams(chunk, least), gram, least, chunk)
        anchors, starts = {}, []
        for lo, hi, anchor, _ in zip(*(x.tolist() for x in runs)):
            for s in range(lo, hi + 1):
                starts.append(s)
                assert anchors.setdefault(data[s:s + least].tobytes(), anchor) == anchor
        assert sorted(starts) == sorted(o + i for o, x in zip(offsets, texts) for i in range(len(x) - least + 1))


def test_suffixes_are_sorted_to_the_depth_exactly():
    rng = np.random.default_rng(2)
    for _ in range(60):
        text = rng.integers(0, int(rng.integers(1, 4)), int(rng.integers(1, 80))).astype(np.uint16)
        depth = int(rng.integers(1, 30))
        starts = [tuple(text[i:i + depth]) for i in range(len(text))]
        assert repeats.suffix_ranks(text, depth).tolist() == [sorted(starts).index(s) for s in starts]


def test_keys_too_long_to_be_packed_are_in_the_same_order():
    key = np.random.default_rng(3).integers(0, 1 << 40, 500) // 3
    (order, ordered), (wide, same) = repeats._in_order(key, 40), repeats._in_order(key, 63)
    assert order.tolist() == wide.tolist() and ordered.tolist() == same.tolist() == sorted(key.tolist())


def test_fragments_alone_under_their_anchor_are_not_sorted(monkeypatch):
    """Copies of whole texts, merged with their weight, hold nothing that a suffix array could tell."""
    sorted_bodies, find = [], repeats.repeated_windows

    def watched(bodies, weights, least):
        sorted_bodies.extend(bodies)
        return find(bodies, weights, least)
    monkeypatch.setattr(repeats, "repeated_windows", watched)
    table = pa.table({"anchor": [1, 2, 2, 3], "f1": [1, 2, 3, 4], "f2": [0] * 4, "n": [2, 1, 2, 1],
                      "body": pa.array([b"abcdefgh", b"1234567", b"x234567", b"zzzzzz"], pa.binary())})
    found = repeats._block_repeats(5)((pa.scalar(0),), table)
    assert sorted_bodies == [b"1234567", b"x234567", b"zzzzzz"]
    assert sorted(zip(*(found[c].to_pylist() for c in ("f1", "first", "last")))) == [(1, 0, 3), (2, 1, 2), (3, 0, 2), (4, 0, 1)]


def test_the_query_removes_passages_by_their_bytes_not_words(spark, tmp_path):
    """Passages of over 50 words go from 400 bytes on; what was removed is in ``n_removed``, not in ``n_bytes``."""
    rng = np.random.default_rng(6)

    def words(n, letters):
        return " ".join("".join(rng.choice(list("abcdefghijklmnopqrstuvwxyzé"), letters)) for _ in range(n))
    passages = {True: words(90, 5), False: words(60, 4)}
    assert len(passages[True].encode()) >= 400 > len(passages[False].encode()) + 2
    rows, kept, doc_id = [], {}, 0
    for goes, passage in passages.items():
        for edges in ("1", "2", "3"):
            before, after = words(60, 5) + edges, edges + words(60, 5)
            rows.append((doc_id, before + passage + after))
            kept[doc_id] = before + after if goes else before + passage + after
            doc_id += 1
    rows.append((doc_id, words(200, 5)))
    kept[doc_id] = rows[-1][1]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op13_suffix_dedup(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, found)) == [
        (i, len(text.encode()), len(text.encode()) - len(kept[i].encode()), int(kept[i] != text),
         hashlib.sha256(kept[i].encode()).hexdigest()) for i, text in rows]

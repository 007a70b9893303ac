import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tickloom.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "a  b   c\t\td", "don't we'll I'M", "<|endoftext|> inside", "漢字 🙂🙂 ÄÖÜ x", "\r\n\r\n  \n x",
       "12345 67.89", "x" * 5000, " " * 3000, "#" * 3000, "á ‍ ﻿", "\x00\x01"]


def test_encoder_gives_the_ids_of_tokenizers():
    slow, fast = Tokenizer.from_file(PATH), packing.encoder(PATH)
    for text in ODD:
        assert fast(text) == slow.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(), max_size=3))
def test_encoder_on_any_text(texts):
    slow, fast = Tokenizer.from_file(PATH), packing.encoder(PATH)
    for text in texts:
        assert fast(text) == slow.encode(text, add_special_tokens=False).ids


def test_other_tokenizers_are_left_to_their_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    assert packing.encoder(path)("Some Words") == Tokenizer.from_file(path).encode("Some Words", add_special_tokens=False).ids


def filled(runs, sequences, capacity):
    """Each sequence's (offset, length), checked to be gapless and within the capacity."""
    bins, numbers = defaultdict(list), defaultdict(list)
    for length, first, pieces, sequence, in_each, offset in runs:
        numbers[length] += range(first, first + pieces)
        for i in range(pieces):
            bins[sequence + i // in_each].append((offset + length * (i % in_each), length))
    assert sorted(bins) == list(range(sequences))
    for items in bins.values():
        items.sort()
        ends = np.cumsum([n for _, n in items])
        assert [o for o, _ in items] == [0, *ends[:-1]] and ends[-1] <= capacity
        assert sum(n > capacity // 3 for _, n in items) <= 2
    return bins, numbers


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 40), max_size=25))
def test_plan_places_every_piece_once(counts):
    runs, sequences = packing.plan(counts, 60)
    _, numbers = filled(runs, sequences, 60)
    assert {n: len(v) for n, v in numbers.items()} == counts
    assert all(sorted(v) == list(range(len(v))) for v in numbers.values())


def test_plan_is_best_fit_and_matches_the_large():
    assert packing.plan({700: 2, 324: 2}, 1024)[1] == 2
    assert packing.plan({600: 3, 424: 3, 350: 2}, 1024)[1] == 4
    draw = np.random.default_rng(1)
    lengths, counts = np.unique(draw.integers(1, 1025, 20_000), return_counts=True)
    counts = dict(zip(lengths.tolist(), counts.tolist()))
    runs, sequences = packing.plan(counts, 1024)
    assert sequences <= 1.02 * sum(n * c for n, c in counts.items()) / 1024
    # As many runs as lengths allow, however many pieces there are.
    many, _ = packing.plan({n: c * 10 ** 6 for n, c in counts.items()}, 1024)
    assert len(many) < 20 * 1024


@pytest.mark.parametrize("n", [1, 5, 1023, 1024, 1025, 2048, 2049, 5000])
def test_only_the_first_piece_is_short(n):
    cut = packing.cut(n, 1024)
    assert [a for a, _ in cut] == [0, *np.cumsum([b for _, b in cut])[:-1]] and sum(b for _, b in cut) == n
    assert all(b == 1024 for _, b in cut[1:])


def test_edge_rows(edge_docs, no_docs):
    found = packing.pack(edge_docs, PATH, ids=True).toPandas()
    assert packing.pack(no_docs, PATH).count() == 0
    slow = Tokenizer.from_file(PATH)
    rows = edge_docs.collect()
    wanted = sorted(tuple(slow.encode(r.text or "", add_special_tokens=False).ids) + (2,) for r in rows)
    assert found[found.piece == 0].shape[0] == len(rows)
    assert sum(found.length) == sum(map(len, wanted))
    for r in found.itertuples():
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length
    for _, g in found.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g.length.sum() <= 1024 and list(g.offset) == [0, *np.cumsum(g.length)[:-1]]
    for doc_id in (1, 5, 11, -1):
        g = found[found.doc_id == doc_id].sort_values("piece")
        text = next(r.text for r in rows if r.doc_id == doc_id)
        assert [i for ids in g.ids for i in ids] == slow.encode(text, add_special_tokens=False).ids + [2]

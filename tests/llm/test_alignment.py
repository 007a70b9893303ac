import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from conftest import SF_DIR
from tokenizers import Tokenizer

from tickloom.llm import alignment
from tickloom.llm.common import documents

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def plain():
    """(id, bytes) of each token of a text under both tokenizers, by their own libraries."""
    one, two = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    one.encode_special_tokens = True
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}

    def tokens(text):
        a = [(i, bytes(byte_of[c] for c in one.id_to_token(i))) for i in one.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, bytes([int(two.id_to_piece(i)[3:5], 16)]) if two.is_byte(i) else two.id_to_piece(i).replace("▁", " ").encode())
             for i in two.encode(text)]
        raw = b" " + text.encode()
        return (a, b) if text and all(b"".join(x[1] for x in t) == raw for t in (a, b)) else ([], [])
    return tokens


def spans(tokens):
    ends = np.cumsum([len(x) for _, x in tokens]).tolist()
    return [(e - len(x), e, i) for e, (i, x) in zip(ends, tokens)]


def expected(rows, plain):
    made, holders = [], Counter()
    for doc_id, text in rows:
        a, b = (spans(t) for t in plain(text or ""))
        links = [(x[2], y[2]) for x in a for y in b if x[0] < y[1] and y[0] < x[1]]
        shared = sorted({x[1] for x in a} & {y[1] for y in b})
        groups = [tuple([z[2] for z in side if start < z[1] <= end] for side in (a, b)) for start, end in zip([0, *shared], shared)]
        holders.update(set(links))
        made.append((doc_id, a, b, links, groups))
    best = {}
    for (x, _), n in holders.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for doc_id, a, b, links, groups in made:
        text = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        out.append((doc_id, len(a), len(b), len(groups), len(links), sum(holders[x] == best[x[0]] for x in links),
                    sum(holders[x] for x in links), hashlib.sha256(text.encode()).hexdigest() if a else "",
                    sum(len(g[0]) * len(g[1]) for g in groups)))
    return sorted(out, key=repr)


def check(docs, plain, **more):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    found = alignment.alignment(docs, A, B, **more)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == expected(rows, plain)


def test_edge_rows(edge_docs, no_docs, plain):
    check(edge_docs.where("doc_id is null or doc_id not in (5, 6)"), plain)  # brute force is quadratic
    assert alignment.alignment(no_docs, A, B).count() == 0


def test_odd_texts(spark, plain):
    texts = ["<|endoftext|> stays text", "<s> and </s> <0x41>", "a▁b", "  two  spaces ", "tab\tand\r\nlines\n\n", "\x00nul", "ﬁ Ａ é é",
             "🙂👩‍👩‍👧", "नमस्ते ภาษาไทย", "x" * 300, "", " ", "naïve coöperation", "1234567890 " * 20, "   spaces"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 2)], "doc_id long, text string").repartition(5)
    check(docs, plain)
    check(docs, plain, block_links=1)


def test_a_table(spark, plain):
    check(documents(spark, SF_DIR).where("length(text) < 3000").select("doc_id", "text"), plain, block_links=3000)


def test_very_long_text(spark):
    text = " ".join(f"word{i % 997}" for i in range(60_000))
    rows = alignment.alignment(spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string"), A, B).collect()
    assert rows[0][1:] == rows[1][1:] and rows[0].count_sum == 2 * rows[0].n_links


@pytest.mark.parametrize("most", [1, 7, 10_000])
def test_product_is_the_matrix_product(most):
    rng = np.random.default_rng(1)

    def random(n, m):
        dense = (rng.random((n, m)) < 0.3).astype(int)
        return dense, alignment.Rows(np.r_[0, dense.sum(1).cumsum()], np.nonzero(dense)[1])

    (x, left), (y, right) = random(23, 17), random(17, 31)
    found = np.zeros((23, 31), int)
    for i, j, n in alignment.product(left, right, most):
        found[i, j] += n
    assert (found == x @ y).all()


def test_links_share_bytes_and_groups():
    first, second = alignment.byte_level(A), alignment.pieces(B)
    x = alignment.align(["unbelievable internationalisation", None, "ÄÖ"], first, second)
    shared = {(i, j): n for rows in alignment.overlaps(x) for i, j, n in zip(*rows)}
    assert sum(shared.values()) == len(" unbelievable internationalisation ÄÖ".encode())
    grouped = {(i, j) for rows in alignment.shared_groups(x) for i, j, _ in zip(*rows)}
    assert set(shared) <= grouped and list(x.n_a)[1] == 0

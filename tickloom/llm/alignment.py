"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes of a text.

The tokens of a text are the rows of an incidence matrix over its bytes, in compressed sparse rows. The
product of one tokenizer's matrix with the other's transpose has an entry for each two tokens that
overlap, and the same product over groups, the stretches between ends that both share, one for each
two tokens of a group. Many texts are laid end to end in one product; as both tokenizers end where a
text ends, nothing crosses.

How many documents link two ids is a sum over the corpus that every document needs back. Documents
travel in blocks of a bounded number of links: Spark adds up each block's different id pairs, joins the
sums back to the blocks, and a block reads its documents' figures from them. No id pair, however
frequent, has more rows than there are blocks.
"""

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tickloom.llm.common import materialize, slices
from tickloom.llm.packing import _byte_of, encoder

#: Links in a block of documents; a longer document is a block of its own.
BLOCK_LINKS = 2_000_000
#: Bytes of text laid end to end, and terms of a product held at once.
SLICE_BYTES = 2 << 20
PRODUCT_TERMS = 1 << 22

_DIGEST = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
           "groups_sha256 string, n_shared long")
_BLOCKS = "block long, codes array<long>, docs array<long>, packed binary"


class Rows(NamedTuple):
    """A sparse matrix of ones in compressed sparse rows; the columns of a row ascend."""

    starts: np.ndarray
    columns: np.ndarray


def runs(lengths: np.ndarray) -> Rows:
    """Row i covers the ``lengths[i]`` columns after those of row i - 1: tokens by bytes."""
    return Rows(np.concatenate([[0], np.cumsum(lengths)]), np.arange(lengths.sum()))


def members(lengths: np.ndarray) -> Rows:
    """The transpose of ``runs``: one entry in each row, bytes by tokens."""
    return Rows(np.arange(lengths.sum() + 1), np.repeat(np.arange(len(lengths)), lengths))


def product(left: Rows, right: Rows, most: int = PRODUCT_TERMS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, columns, values) of ``left`` times ``right``, row by row as Gustavson does it.

    A row of the result is the sum of the right rows that the left row names. Rows come in order, in
    portions of about ``most`` terms or else a single row.
    """
    width = np.diff(right.starts)[left.columns]
    before = np.concatenate([[0], np.cumsum(width)])
    first = before[left.starts]  # terms before each row
    row = 0
    while row < len(left.starts) - 1:
        end = max(row + 1, int(np.searchsorted(first, first[row] + most, side="right")) - 1)
        entries = slice(left.starts[row], left.starts[end])
        n, terms = width[entries], int(first[end] - first[row])
        of = np.repeat(np.repeat(np.arange(row, end), np.diff(left.starts[row:end + 1])), n)
        at = np.arange(terms) + np.repeat(right.starts[left.columns[entries]] - (before[entries] - first[row]), n)
        column = right.columns[at]
        if terms:
            step = np.diff(column)
            same_row = of[1:] == of[:-1]
            if (step[same_row] < 0).any():  # the named rows interleave
                order = np.lexsort((column, of))
                of, column = of[order], column[order]
                same_row, step = of[1:] == of[:-1], np.diff(column)
            new = np.flatnonzero(np.concatenate([[True], ~same_row | (step != 0)]))
            yield of[new], column[new], np.diff(np.concatenate([new, [terms]]))
        row = end


class Alphabet(NamedTuple):
    """A tokenizer: ids of texts, and the bytes of each id."""

    encode: Callable[[list[str]], list[list[int]]]
    bytes_of: list[bytes]


def byte_level(path: str) -> Alphabet:
    """A byte-level BPE file; special tokens in a text are plain text, and it sees a space before each text."""
    fast, slow = encoder(path), Tokenizer.from_file(path)
    slow.encode_special_tokens = True
    special = [t.content for t in slow.get_added_tokens_decoder().values()]
    byte_of, vocabulary = _byte_of(), slow.get_vocab()
    bytes_of = [b""] * (max(vocabulary.values()) + 1)
    for word, i in vocabulary.items():
        if word not in special:
            bytes_of[i] = bytes(byte_of[c] for c in word)

    def encode(texts: list[str]) -> list[list[int]]:
        return [slow.encode(" " + t, add_special_tokens=False).ids if any(s in t for s in special) else fast(" " + t)
                for t in texts]

    return Alphabet(encode, bytes_of)


def pieces(path: str) -> Alphabet:
    """A piece model with byte fallback, which adds the space itself."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)

    def bytes_of(i: int) -> bytes:
        piece = model.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()

    return Alphabet(lambda texts: model.encode(texts, num_threads=1), [bytes_of(i) for i in range(len(model))])


class Aligned(NamedTuple):
    """Texts laid end to end: the ids of both tokenizers and how many tokens each text has."""

    a: np.ndarray
    b: np.ndarray
    a_lengths: np.ndarray
    b_lengths: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray


def align(texts: list[str | None], first: Alphabet, second: Alphabet) -> Aligned:
    """The tokens of the texts that both tokenizers give back byte by byte; other texts have none."""
    full = [i for i, t in enumerate(texts) if t]
    ids = [([], [])] * len(texts)
    for i, a, b in zip(full, first.encode([texts[i] for i in full]), second.encode([texts[i] for i in full])):
        raw = b" " + texts[i].encode()
        if all(b"".join(map(kind.bytes_of.__getitem__, found)) == raw for kind, found in ((first, a), (second, b))):
            ids[i] = (a, b)
    sizes = [np.array([len(x) for x in kind.bytes_of]) for kind in (first, second)]
    both = [np.array([x for pair in ids for x in pair[k]], np.int64) for k in (0, 1)]
    return Aligned(*both, sizes[0][both[0]], sizes[1][both[1]],
                   *(np.array([len(pair[k]) for pair in ids], np.int64) for k in (0, 1)))


def overlaps(x: Aligned) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Overlap links: positions of the two tokens and the bytes they share."""
    return product(runs(x.a_lengths), members(x.b_lengths))


def groups(x: Aligned) -> tuple[np.ndarray, np.ndarray]:
    """The group of each token: how many ends that both share lie before its own end."""
    a, b = np.cumsum(x.a_lengths), np.cumsum(x.b_lengths)
    shared = a[np.isin(a, b, assume_unique=True)]
    return np.searchsorted(shared, a), np.searchsorted(shared, b)


def shared_groups(x: Aligned) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Shared-group links: positions of the two tokens, and 1."""
    a, b = groups(x)
    n = int(a[-1]) + 1 if len(a) else 0
    return product(members(np.bincount(a, minlength=n)), runs(np.bincount(b, minlength=n)))


def _group_digests(x: Aligned, a_group: np.ndarray, b_group: np.ndarray, names: list[bytes], a_width: int) -> list[str]:
    """Each text's groups as ``a1,a2|b1;a3|b2`` under SHA-256; '' for texts without tokens.

    ``names`` has each id of the first tokenizer followed by ',' and then by '|', and each of the
    second followed by ',' and by ';'.
    """
    a_last = np.append(np.diff(a_group) != 0, True)[:len(a_group)]
    b_last = np.append(np.diff(b_group) != 0, True)[:len(b_group)]
    b_width = (len(names) - 2 * a_width) // 2
    codes = np.concatenate([x.a + a_last * a_width, x.b + 2 * a_width + b_last * b_width])
    codes = codes[np.argsort(np.concatenate([a_group, b_group]), kind="stable")].tolist()
    out, at = [], 0
    for n in (x.n_a + x.n_b).tolist():
        text = b"".join([names[c] for c in codes[at:at + n]])
        out.append(hashlib.sha256(text[:-1]).hexdigest() if n else "")
        at += n
    return out


def _tight(numbers: np.ndarray) -> bytes:
    return zstandard.compress(numbers.astype("<u4").tobytes(), 1)


def _loose(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), "<u4").astype(np.int64)


class _Block:
    """Documents until they have enough links for a row."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []
        self.keys: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []
        self.links = 0

    def packed(self, block: int) -> pa.RecordBatch:
        """Each document's different id pairs as steps through the block's sorted ones."""
        codes, place, docs = np.unique(np.concatenate(self.keys), return_inverse=True, return_counts=True)
        sizes = np.concatenate(self.sizes)
        starts = (np.cumsum(sizes) - sizes)[sizes > 0]
        steps = np.diff(place, prepend=0)
        steps[starts] = place[starts]
        rows = pa.RecordBatch.from_pylist([dict(zip(_COLUMNS, r)) for r in self.rows], _SCHEMA)
        columns = pa.RecordBatch.from_arrays([*rows.columns, pa.array(sizes, pa.int64())], [*_COLUMNS, "size"])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, columns.schema) as stream:
            stream.write_batch(columns)
        parts = [zstandard.compress(sink.getvalue().to_pybytes(), 1), _tight(steps), _tight(np.concatenate(self.times))]
        head = np.array([len(p) for p in parts], "<u8").tobytes()
        return pa.RecordBatch.from_pydict(
            {"block": [block], "codes": [codes], "docs": [docs], "packed": [head + b"".join(parts)]},
            schema=pa.schema({"block": pa.int64(), "codes": pa.list_(pa.int64()), "docs": pa.list_(pa.int64()),
                              "packed": pa.binary()}))


_COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_shared")
_SCHEMA = pa.schema([(c, pa.string() if c == "groups_sha256" else pa.int64()) for c in _COLUMNS])


def _blocks(a_path: str, b_path: str, most_links: int):
    """Documents to blocks, one pass over the texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = byte_level(a_path), pieces(b_path)
        a_width, b_width = len(first.bytes_of), len(second.bytes_of)
        names = [b"%d%s" % (i, end) for width, ends in ((a_width, (b",", b"|")), (b_width, (b",", b";")))
                 for end in ends for i in range(width)]
        held, number = _Block(), TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                x = align(part["text"].to_pylist(), first, second)
                n = len(x.n_a)
                doc_of_a, doc_of_b = (np.repeat(np.arange(n), counts) for counts in (x.n_a, x.n_b))
                pairs = a_width * b_width
                linked = [doc_of_a[i] * pairs + x.a[i] * b_width + x.b[j] for i, j, _ in overlaps(x)]
                keys, times = np.unique(np.concatenate(linked or [np.zeros(0, np.int64)]), return_counts=True)
                doc = keys // pairs
                a_group, b_group = groups(x)
                shared = np.zeros(n, np.int64)
                for i, _, _ in shared_groups(x):
                    shared += np.bincount(doc_of_a[i], minlength=n)
                ends = np.append(np.diff(a_group) != 0, True)[:len(a_group)]
                figures = [x.n_a, x.n_b, np.bincount(doc_of_a[ends], minlength=n),
                           np.bincount(doc, times, minlength=n).astype(np.int64)]
                digests = _group_digests(x, a_group, b_group, names, a_width)
                held.rows += zip(part["doc_id"].to_pylist(), *(f.tolist() for f in figures), digests, shared.tolist())
                held.keys.append(keys % pairs)
                held.times.append(times)
                held.sizes.append(np.bincount(doc, minlength=n))
                held.links += int(times.sum())
                if held.links >= most_links:
                    yield held.packed(number)
                    held, number = _Block(), number + 1
        if held.rows:
            yield held.packed(number)
    return run


def _figures(key: tuple[pa.Scalar, ...], blocks: pa.Table, counts: pa.Table) -> pa.Table:
    """The documents of a block with the corpus-wide counts of its id pairs."""
    data = blocks["packed"][0].as_py()
    lengths = np.frombuffer(data[:24], "<u8").astype(int)
    cuts = 24 + np.concatenate([[0], np.cumsum(lengths)])
    rows, steps, times = (data[a:b] for a, b in zip(cuts, cuts[1:]))
    docs = pa.ipc.open_stream(zstandard.decompress(rows)).read_all()
    steps, times, sizes = _loose(steps), _loose(times), docs["size"].to_numpy()
    starts = np.cumsum(sizes) - sizes
    place = np.cumsum(steps)  # running on over the documents, from which what ran before is taken
    before = np.concatenate([[0], place])[starts]
    place = place - np.repeat(before, sizes)
    order = np.argsort(counts["code"].to_numpy())
    total, best = (counts[c].to_numpy(zero_copy_only=False)[order] for c in ("n", "best"))
    of = np.repeat(np.arange(len(sizes)), sizes)
    sums, bests = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    if len(of):
        np.add.at(sums, of, total[place] * times)
        np.add.at(bests, of, best[place] * times)
    names = [c.split(" ")[0] for c in _DIGEST.split(", ")]
    return docs.append_column("count_sum", pa.array(sums)).append_column("n_best", pa.array(bests)).select(names)


def pair_counts(blocks: DataFrame, b_width: int) -> DataFrame:
    """(code, n, best): documents that link an id pair, and whether no other of its first id has more.

    A window holds the pairs of one id, at most as many as the second tokenizer has ids.
    """
    counts = blocks.select(F.explode(F.arrays_zip("codes", "docs")).alias("x")) \
        .groupBy(F.col("x.codes").alias("code")).agg(F.sum("x.docs").alias("n"))
    of_id = Window.partitionBy(F.floor(F.col("code") / b_width).cast("long"))
    return materialize(counts.withColumn("best", F.col("n") == F.max("n").over(of_id)), "pair-counts")


def alignment(docs: DataFrame, a_path: str, b_path: str, block_links: int = BLOCK_LINKS) -> DataFrame:
    """Tokens, groups and links of every document under the two tokenizers at the paths.

    The first reads a space and the text, the second adds the space itself. A link is a pair of tokens
    that overlap, its count the number of rows that have its ids linked. Per row: tokens ``n_a`` and
    ``n_b``, ``n_groups``, ``n_links``, those whose count is the highest of their first id (``n_best``), the
    links' ``count_sum``, the digest ``groups_sha256`` and ``n_shared``, the pairs of tokens in one group.

    Null and empty texts, and texts that either tokenizer doesn't give back byte by byte, have no tokens:
    zeros and an empty digest. Repeated rows, null ids included, are documents of their own; an empty
    table gives no rows; extra columns are ignored. ``block_links`` changes no result.
    """
    picked = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    blocks = materialize(picked.mapInArrow(_blocks(a_path, b_path, block_links), _BLOCKS), "alignment-blocks")
    counts = pair_counts(blocks, len(sentencepiece.SentencePieceProcessor(model_file=b_path)))
    found = blocks.select(F.col("block").alias("of_block"), F.explode("codes").alias("code")).join(counts, "code")
    return blocks.select("block", "packed").groupBy("block").cogroup(found.groupBy("of_block")) \
        .applyInArrow(_figures, _DIGEST)

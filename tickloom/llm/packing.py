"""Best-fit packing of tokenised documents into sequences of a fixed capacity.

Lengths are whole numbers up to the capacity, so the packing is decided on how many pieces of each
length there are, a table of at most ``capacity`` rows whatever the input. Its outcome is a short list
of runs: the next n pieces of a length go to these sequences at this offset. Each piece then finds
its place from its number among the pieces of its length.
"""

import json
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tickloom.llm.common import materialize, offsets_in_groups, small_batches

CAPACITY = 1024
#: Id after each document.
END = 2
# The word pattern of byte-level BPE files that name none of their own.
BYTE_LEVEL_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

_PIECES = "doc_id string, piece int, start long, length long, ids_crc32 long"


def _byte_of() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the rest from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def encoder(path: str) -> Callable[[str], list[int]]:
    """The ids that ``tokenizers`` gives for the file at ``path``, without its added special tokens.

    A plain byte-level BPE, whose merges are in the order of their ids, is run by ``tiktoken`` over the
    same vocabulary, which gives the same ids about three times as fast; any other file, and any
    text that it can't handle, is left to ``tokenizers``.
    """
    slow = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, before = spec["model"], spec.get("pre_tokenizer") or {}

    def plain(text: str) -> list[int]:
        return slow.encode(text, add_special_tokens=False).ids

    added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
    ids = [model["vocab"].get("".join(m), -1) for m in merges]
    simple = (
        model.get("type") == "BPE" and before.get("type") == "ByteLevel" and before.get("use_regex", True)
        and not before.get("add_prefix_space") and not spec.get("normalizer") and not model.get("dropout")
        and not model.get("ignore_merges") and ids == sorted(ids) and -1 not in ids
        and not any(t.get(k) for t in spec.get("added_tokens", []) for k in ("lstrip", "rstrip", "single_word")))
    if not simple:
        return plain
    byte_of = _byte_of()
    ranks = {bytes(byte_of[c] for c in word): i for word, i in model["vocab"].items() if word not in added}
    fast = tiktoken.Encoding(path, pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens=added)

    def encode(text: str) -> list[int]:
        try:
            return fast.encode(text, allowed_special="all")
        except (ValueError, RuntimeError):  # such as the regex engine's limit on backtracking
            return plain(text)

    return encode


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; only the first may be shorter than the capacity."""
    starts = [0, *range(n % capacity or capacity, n, capacity)]
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], n])]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, ids: bool = False) -> DataFrame:
    """A row for each piece of each document's ids; with ``ids`` also the ids themselves."""
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer)
        for batch in batches:
            found = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                tokens = np.array(encode(text or "") + [END], "<u4")
                for i, (start, length) in enumerate(cut(len(tokens), capacity)):
                    part = tokens[start:start + length]
                    found.append((doc_id, i, start, length, zlib.crc32(part.tobytes()))
                                 + ((part.astype(np.int32),) if ids else ()))
            made = pd.DataFrame(found, columns=["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * ids)
            yield made

    small_batches(docs.sparkSession)
    # Ids travel as text: pandas would turn longs with nulls into doubles.
    picked = docs.select(F.col("doc_id").cast("long").cast("string"), F.col("text").cast("string"))
    made = picked.mapInPandas(rows, _PIECES + ", ids array<int>" * ids)
    return made.withColumn("doc_id", F.col("doc_id").cast("long"))


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, ...]], int]:
    """Runs (length, first, pieces, sequence, in_each, offset), and the number of sequences.

    Of a run, piece i of its ``pieces``, the one numbered first + i of its length, goes to ``sequence``
    + i // in_each at ``offset`` + length * (i % in_each). Pieces above a third of the capacity are
    matched first: the largest with the largest that fits beside it, so at most two in a
    sequence. The smaller ones, largest first, each go where the least room is left that holds them.
    """
    left = [counts.get(n, 0) for n in range(capacity + 1)]
    used, runs, sequences = [0] * (capacity + 1), [], 0
    room: dict[int, list[tuple[int, int]]] = {}  # gap: runs (first sequence, number)

    def put(length: int, bins: int, first: int, in_each: int, offset: int) -> None:
        runs.append((length, used[length], bins * in_each, first, in_each, offset))
        used[length] += bins * in_each
        left[length] -= bins * in_each

    third = capacity // 3
    for a in range(capacity, third, -1):
        while left[a]:
            b = next((b for b in range(min(a, capacity - a), third, -1) if left[b] > (b == a)), 0)
            n = left[a] if not b else left[a] // 2 if a == b else min(left[a], left[b])
            put(a, n, sequences, 1, 0)
            if b:
                put(b, n, sequences, 1, a)
            room.setdefault(capacity - a - b, []).append((sequences, n))
            sequences += n
    for s in range(third, 0, -1):
        while left[s]:
            gap = next((g for g in range(s, capacity) if room.get(g)), capacity)
            if gap == capacity:
                first, bins = sequences, -(-left[s] // (capacity // s))
                sequences += bins
            else:
                first, bins = room[gap].pop()
            in_each = gap // s
            full = min(bins, left[s] // in_each)
            if full:
                put(s, full, first, in_each, capacity - gap)
                room.setdefault(gap - s * in_each, []).append((first, full))
            if full < bins and left[s]:  # fewer are left than fit into one
                n = left[s]
                put(s, 1, first + full, n, capacity - gap)
                room.setdefault(gap - s * n, []).append((first + full, 1))
                full += 1
            if full < bins:
                room[gap].append((first + full, bins - full))
    return runs, sequences


def place(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a stored table of pieces."""
    counts = {r.length: r["count"] for r in found.groupBy("length").count().collect()}
    runs, _ = plan(counts, capacity)
    table = np.array(sorted(runs), np.int64).reshape(-1, 6)
    by = table[:, 0] << 48 | table[:, 1]  # a length's pieces are numbered below 2 ** 48

    @F.pandas_udf("sequence_id long, offset long")
    def placed(lengths: pd.Series, numbers: pd.Series) -> pd.DataFrame:
        length, number = lengths.to_numpy(np.int64), numbers.to_numpy(np.int64)
        _, first, _, sequence, in_each, offset = table[
            np.searchsorted(by, length << 48 | number, side="right") - 1].T
        i = number - first
        return pd.DataFrame({
            "sequence_id": sequence + i // in_each, "offset": offset + length * (i % in_each)})

    small_batches(found.sparkSession, 10_000)
    numbered = offsets_in_groups(
        found, ["length"], ["doc_id", "piece", "start", "ids_crc32"], "number")
    return numbered.withColumn("_place", placed("length", "number")) \
        .select(*found.columns, "_place.sequence_id", "_place.offset")


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, ids: bool = False) -> DataFrame:
    """Where each piece of each document goes.

    A document is its ids and then END. Null and empty texts are a single END; documents longer
    than ``capacity`` are cut, the short piece first; repeated rows and null ids are documents like
    any other; an empty table gives no rows; extra columns are ignored.
    """
    return place(materialize(pieces(docs, tokenizer, capacity, ids), "pieces"), capacity)

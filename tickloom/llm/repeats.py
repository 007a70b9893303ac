"""Suffix-array dedup: remove the bytes that lie in a string of a minimum length starting elsewhere too.

Windows of that length are dealt by anchors: of the hashes of a window's k-byte grams the least one. Equal
windows have equal anchors, and neighbouring windows mostly share theirs, so a run of windows travels
as one fragment of text. Only fragments whose anchor occurs again can hold a repeat; equal ones are
merged with a weight. Fragments of the same anchor meet in a block of a bounded size, whose suffix array,
sorted to the length of a window, tells which windows are equal.

An anchor with more different fragments than a block holds, such as one within a passage of a third of
all documents, is split by longer grams. A window's gram then covers more and more of the window,
so that what stands around the passage parts its fragments while what is inside it becomes equal and
is merged; grams as long as the window leave nothing but equal windows under an anchor.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import arrow_rows, materialize, once, slices, text_key

#: Bytes of the shortest string that counts as a repeat.
LEAST = 400
#: Bytes of the first anchors' grams; each round of splitting halves what is left to the window.
GRAM = 64
#: Different text that a block holds, on average, and that an anchor may have without being split.
BLOCK_BYTES = 1 << 20
#: Window starts hashed at once.
CHUNK = 1 << 20
#: Texts handed to a Python worker at once.
BATCH_ROWS = 512

_ANCHORS = "t1 long, t2 long, lo long, hi long, anchor long, again boolean"
_FRAGMENTS = "t1 long, t2 long, anchor long, lo long, windows long, n long, body binary, again boolean"
_FOUND = "anchor long, f1 long, f2 long, first long, last long"
_KEPT = "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary"

_POSITION = np.uint64((1 << 24) - 1)
_BASE = 0x9E3779B97F4A7C15


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Grams:
    """Hashes of all grams of a chunk, by running sums of byte values times powers of an odd base."""

    def __init__(self, chunk: int, least: int) -> None:
        self.values = np.random.default_rng(7).integers(1, 1 << 63, 256, np.uint64)  # the same everywhere
        self.up = _powers(_BASE, chunk + least)
        self.down = _powers(pow(_BASE, -1, 1 << 64), chunk + least)

    def hashes(self, data: np.ndarray, gram: int) -> np.ndarray:
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.up[:len(data)], out=sums[1:])
        found = (sums[gram:] - sums[:-gram]) * self.down[:len(data) - gram + 1]
        found ^= found >> np.uint64(32)
        found *= np.uint64(0xD6E8FEB86659FD93)
        found ^= found >> np.uint64(29)
        return found


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours: the least up to the next multiple of the width, and from there on."""
    n = len(values)
    rows = np.concatenate([values, np.full(-n % width, np.iinfo(values.dtype).max, values.dtype)]).reshape(-1, width)
    onward = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - width + 1], onward[width - 1:n])


def anchor_runs(
    data: np.ndarray, offsets: np.ndarray, grams: Grams, gram: int, least: int, chunk: int = CHUNK,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: first and last window start, anchor, and whether it can recur inside.

    ``offsets`` are the bounds of the texts in ``data``; no window crosses one. Runs end at chunk bounds,
    which changes how windows travel and nothing else.
    """
    found = []
    for begin in range(0, max(0, len(data) - least + 1), chunk):
        part = data[begin:begin + chunk + least - 1]
        hashes = grams.hashes(part, gram)
        places = np.arange(len(hashes), dtype=np.uint64)
        # The leftmost of the least: where windows are equal, so are the places within them.
        least_of = sliding_min((hashes & ~_POSITION) | places, least - gram + 1)
        place = (least_of & _POSITION).astype(np.int64)
        anchor = hashes[place]
        crossed = np.zeros(len(part) + 2, np.int64)  # a window crosses the text ends just after its start
        ends = offsets[(offsets > begin) & (offsets < begin + len(part))] - begin
        np.add.at(crossed, np.maximum(ends - least + 1, 0), 1)
        np.add.at(crossed, ends, -1)
        whole = np.cumsum(crossed)[:len(anchor)] == 0
        new = whole.copy()
        new[1:] &= ~whole[:-1] | (anchor[1:] != anchor[:-1])
        over = whole.copy()
        over[:-1] &= ~whole[1:] | (anchor[1:] != anchor[:-1])
        lo, hi = np.flatnonzero(new), np.flatnonzero(over)
        found.append((lo + begin, hi + begin, anchor[lo].view(np.int64), place[lo] != place[hi]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    return tuple(np.concatenate(x) for x in zip(*found))


def _buffer(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column's texts end to end, and their bounds."""
    texts = column.combine_chunks().cast(pa.large_binary())
    if not len(texts) or texts.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    return np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def _anchors(least: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(CHUNK, least)
        for batch in batches:
            for part in slices(batch, "text"):
                data, offsets = _buffer(part["text"])
                lo, hi, anchor, again = anchor_runs(data, offsets, grams, gram, least)
                text = np.searchsorted(offsets, lo, side="right") - 1
                at = pa.array(text)
                yield pa.RecordBatch.from_arrays(
                    [part["t1"].combine_chunks().take(at), part["t2"].combine_chunks().take(at), pa.array(lo - offsets[text]),
                     pa.array(hi - offsets[text]), pa.array(anchor), pa.array(again)],
                    ["t1", "t2", "lo", "hi", "anchor", "again"])
    return run


def _batches(columns: dict[str, list], names: list[str]) -> Iterator[pa.RecordBatch]:
    table = pa.table({**{c: pa.array(columns[c], pa.int64()) for c in ("t1", "t2", "anchor", "lo", "windows", "n")},
                      "body": pa.array(columns["body"], pa.binary()), "again": pa.array(columns["again"], pa.bool_())})
    yield from table.select(names).to_batches(4096)


_NAMES = [c.split(" ")[0] for c in _FRAGMENTS.split(", ")]


def _cut(least: int):
    """Texts with their candidate runs to fragments."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                out = {c: [] for c in _NAMES}
                for t1, t2, text, items in zip(*(part[c].to_pylist() for c in ("t1", "t2", "text", "runs"))):
                    raw = text.encode()
                    for x in items:
                        out["t1"].append(t1)
                        out["t2"].append(t2)
                        out["anchor"].append(x["anchor"])
                        out["lo"].append(x["lo"])
                        out["windows"].append(x["hi"] - x["lo"] + 1)
                        out["n"].append(x["n"])
                        out["body"].append(raw[x["lo"]:x["hi"] + least])
                        out["again"].append(x["again"])
                yield from _batches(out, _NAMES)
    return run


def _split(least: int, gram: int):
    """Fragments to those of longer grams; with grams as long as the window to single windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(CHUNK, least)
        for batch in batches:
            for part in slices(batch, "body"):
                data, offsets = _buffer(part["body"])
                lo, hi, anchor, again = anchor_runs(data, offsets, grams, gram, least)
                of = np.searchsorted(offsets, lo, side="right") - 1
                raw, at = data.tobytes(), pa.array(of)
                old = {c: part[c].combine_chunks().take(at).to_pylist() for c in ("t1", "t2", "n")}
                windows = hi - lo + 1
                starts = np.array(part["lo"].to_pylist(), np.int64)[of] + lo - offsets[of]
                # Consecutive equal windows are one byte over and over: one of them stands for all.
                single = gram == least
                ends = lo + least if single else hi + least
                old["n"] = [n * w for n, w in zip(old["n"], windows.tolist())] if single else old["n"]
                mixed = anchor ^ (part["anchor"].combine_chunks().take(at).to_numpy() << 1)
                yield from _batches({
                    **old, "anchor": mixed, "lo": starts, "windows": windows,
                    "body": [raw[a:b] for a, b in zip(lo.tolist(), ends.tolist())], "again": again}, _NAMES)
    return run


def _in_order(key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of keys of so many bits, and the keys in it; sorted beside their places if both fit a long."""
    low = len(key).bit_length()
    if bits + low > 63:
        order = np.argsort(key, kind="stable")
        return order, key[order]
    packed = key << low | np.arange(len(key))
    packed.sort()
    return packed & (1 << low) - 1, packed >> low


def suffix_ranks(text: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes' places in the order of their first ``depth`` symbols; equal ones share the first place.

    The sorted depth doubles from as many symbols as fit a number, up to ``depth`` and no further: the
    second half may overlap the first. Only suffixes that still share a place are sorted again.
    """
    n = len(text)
    bits, rank, tied = n.bit_length(), np.zeros(n, np.int64), np.arange(n)
    code = np.cumsum(np.bincount(text) > 0)[text]  # the symbols that occur, from 1
    width = int(code.max()).bit_length()
    done = min(depth, (63 - bits) // width)
    padded = np.concatenate([code, np.zeros(done, np.int64)])
    key = np.zeros(n, np.int64)
    for i in range(done):
        key = key << width | padded[i:i + n]
    size = done * width
    while True:
        order, ordered = _in_order(key, size)
        tied = tied[order]
        old, at = rank[tied], np.arange(len(tied))
        first = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        group = np.concatenate([[True], old[1:] != old[:-1]])
        rank[tied] = old + np.maximum.accumulate(np.where(first, at, 0)) - np.maximum.accumulate(np.where(group, at, 0))
        tied = tied[~first | ~np.concatenate([first[1:], [True]])]
        if done >= depth or not len(tied):
            return rank
        step = min(done, depth - done)
        there = tied + step
        beyond = there >= n
        there[beyond] = 0
        key, size = rank[tied] << bits | np.where(beyond, 0, rank[there] + 1), 2 * bits
        done += step


def repeated_windows(bodies: list[bytes], weights: np.ndarray, least: int) -> list[np.ndarray]:
    """For each body its window starts whose windows have a weight of 2 or more together."""
    lengths = np.array([len(b) for b in bodies])
    of = np.repeat(np.arange(len(bodies)), lengths)
    text = np.zeros(lengths.sum() + len(bodies), np.uint16)  # a separator ends each body
    text[np.arange(len(of)) + of] = np.frombuffer(b"".join(bodies), np.uint8).astype(np.uint16) + 1
    starts = np.cumsum(lengths + 1) - lengths - 1
    weight = np.zeros(len(text), np.int64)
    for start, length, n in zip(starts.tolist(), lengths.tolist(), weights.tolist()):
        weight[start:start + length - least + 1] = n
    windows = np.flatnonzero(weight)
    rank = suffix_ranks(text, least)[windows]
    repeated = np.zeros(len(text), bool)
    repeated[windows] = np.bincount(rank, weight[windows])[rank] >= 2
    return [np.flatnonzero(repeated[s:s + n]) for s, n in zip(starts.tolist(), lengths.tolist())]


def _block_repeats(least: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        bodies, weights = table["body"].to_pylist(), table["n"].to_numpy()
        _, anchor, fragments = np.unique(table["anchor"].to_numpy(), return_inverse=True, return_counts=True)
        # Equal windows have equal anchors: a fragment alone under its anchor is repeated by its own weight.
        alone = (fragments[anchor] == 1) & (weights >= 2)
        of = np.flatnonzero(alone).tolist()
        first, last = [0] * len(of), [len(bodies[i]) - least for i in of]
        mixed = np.flatnonzero(~alone)
        found = repeated_windows([bodies[i] for i in mixed], weights[mixed], least) if len(mixed) else []
        for i, at in zip(mixed.tolist(), found):
            if len(at):
                cut = np.flatnonzero(np.diff(at) > 1)
                first += at[np.concatenate([[0], cut + 1])].tolist()
                last += at[np.concatenate([cut, [len(at) - 1]])].tolist()
                of += [i] * (len(cut) + 1)
        of = pa.array(of, pa.int64())
        return pa.table({**{c: table[c].take(of) for c in ("anchor", "f1", "f2")},
                         "first": pa.array(first, pa.int64()), "last": pa.array(last, pa.int64())})
    return run


def _recurring(rows: DataFrame) -> DataFrame:
    """Rows of a stored table whose anchor occurs more than once.

    The anchors are stored before the join, so that Spark can split a crowded one between tasks.
    """
    often = materialize(
        rows.groupBy("anchor").agg(F.sum("n").alias("_n"), F.max("again").alias("_again"))
        .where("_n > 1 or _again").select("anchor"), "recurring")
    return rows.join(often, "anchor", "left_semi")


def _stored(fragments: DataFrame) -> DataFrame:
    f1, f2 = text_key(F.col("body"))
    with arrow_rows(fragments.sparkSession, BATCH_ROWS):
        return materialize(fragments.withColumns({"f1": f1, "f2": f2}), "fragments")


def _fragments(docs: DataFrame, least: int, gram: int) -> DataFrame:
    """Fragments under anchors that recur, of each different text once; ``n`` counts its documents."""
    spark = docs.sparkSession
    texts = docs.where(F.octet_length("text") >= least)
    with arrow_rows(spark, BATCH_ROWS):
        runs = materialize(
            texts.mapInArrow(_anchors(least, gram), _ANCHORS).groupBy("anchor", "t1", "t2", "lo", "hi")
            .agg(F.count("*").alias("n"), F.max("again").alias("again")), "anchors")
    by_text = _recurring(runs).groupBy("t1", "t2").agg(
        F.collect_list(F.struct("anchor", "lo", "hi", "n", "again")).alias("runs"))
    return _stored(once(texts, ["t1", "t2"], "_first").drop("_first").join(by_text, ["t1", "t2"])
                   .select("t1", "t2", "text", "runs").mapInArrow(_cut(least), _FRAGMENTS))


def repeated_spans(docs: DataFrame, least: int = LEAST, gram: int = GRAM, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(t1, t2, start, end) of byte spans to remove, of each text by its key; they may touch or overlap."""
    fragments, found = _fragments(docs, least, gram), []
    while True:
        different = materialize(fragments.groupBy("anchor", "f1", "f2").agg(
            F.sum("n").alias("n"), F.first("body").alias("body")), "different")
        crowded = materialize(different.groupBy("anchor").agg(
            F.sum(F.octet_length("body")).alias("bytes"), F.count("*").alias("bodies"))
            .where((F.col("bytes") > block_bytes) & (F.col("bodies") > 1)).select("anchor"), "crowded")
        split = gram < least and not crowded.isEmpty()
        rows = different.join(crowded, "anchor", "left_anti") if split else different
        total = different.agg(F.sum(F.octet_length("body"))).first()[0] or 0
        blocks = rows.withColumn("block", F.pmod(F.xxhash64("anchor"), F.lit(total // block_bytes + 1)))
        repeats = materialize(blocks.groupBy("block").applyInArrow(_block_repeats(least), _FOUND), "repeats")
        last = F.col("windows") - 1 if gram == least else F.col("last")
        found.append(fragments.drop("body").join(repeats, ["anchor", "f1", "f2"]).select(
            "t1", "t2", (F.col("lo") + F.col("first")).alias("start"), (F.col("lo") + last + least).alias("end")))
        if not split:
            break
        gram = least if least - gram < 16 else (gram + least) // 2
        fragments = _stored(_recurring(_stored(
            fragments.join(crowded, "anchor", "left_semi").select(*_NAMES).mapInArrow(_split(least, gram), _FRAGMENTS))
            .select(*_NAMES)))
    spans = found[0]
    for more in found[1:]:
        spans = spans.unionByName(more)
    return spans


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the spans."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            spans, kept, sizes = [], [], []
            for text, found in zip(part["text"].to_pylist(), part["spans"].to_pylist()):
                raw = (text or "").encode()
                runs = merged([(x["start"], x["end"]) for x in found or []])
                kept.append(b"".join(raw[a:b] for a, b in zip([0, *(e for _, e in runs)], [*(s for s, _ in runs), len(raw)])))
                spans.append([{"start": a, "end": b} for a, b in runs])
                sizes.append(len(raw))
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"].combine_chunks(), pa.array(sizes, pa.int64()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "spans", "kept"])


def without_repeats(docs: DataFrame, least: int = LEAST, gram: int = GRAM, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id``, ``n_bytes``, the removed ``spans`` and the ``kept`` bytes of every row.

    A byte goes if it lies in a string of ``least`` bytes that also starts anywhere else, in the same text
    or another, overlapping itself or not; all on the texts as they came. Spans are maximal and in order.
    Texts are bytes in UTF-8, so a cut may part a character.

    Null texts are empty; empty texts and those under ``least`` bytes stay; every row is a document, so
    rows that repeat a text repeat all its strings, whatever their ids; null ids are kept; an empty
    table gives no rows; extra columns are ignored. ``gram`` and ``block_bytes`` change no result.
    """
    k1, k2 = text_key(F.col("text"))
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")) \
        .withColumns({"t1": k1, "t2": k2})
    # Stored before the join, so that Spark can split the rows of a text that many documents have.
    spans = materialize(repeated_spans(rows.drop("doc_id"), least, gram, block_bytes).groupBy("t1", "t2")
                        .agg(F.collect_set(F.struct("start", "end")).alias("spans")), "spans")
    with arrow_rows(docs.sparkSession, BATCH_ROWS):
        return materialize(rows.join(spans, ["t1", "t2"], "left").select("doc_id", "text", "spans").mapInArrow(_keep, _KEPT), "kept")

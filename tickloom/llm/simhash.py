"""SimHash near-dedup with the generalised pigeonhole principle.

Two fingerprints within ``distance`` bits of each other are, for any split of their bits into m parts
with thresholds that sum to distance - m + 1, within the threshold in one part at least. Correlated
bits share a part; the thresholds come from a dynamic programme over estimated candidate counts. A
part with threshold t is probed by erasing t of its bits in turn, so what meets in a bucket is then
verified on all 64 bits.
"""

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import fresh_names, materialize, once, small_batches, text_key

SHINGLE = 4
DISTANCE = 4
SEED = 42
#: Fingerprints that the parts and thresholds are planned from. It steers the cost, not the result.
PLAN_SAMPLE = 2048
#: Rows of a bucket that one task compares; larger buckets are cut and compared piece by piece.
BLOCK = 16384
#: Children of a member in the tree that links the members found in a bucket.
FAN_OUT = 64
_NO_ID = (1 << 63) - 1
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_STEP = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of a whole text over its word shingles, repeats included."""
    words = (text or "").encode("utf-8", "replace").translate(_LOWER).split()
    if not words:
        return 0
    ones, total = np.zeros(64, np.int64), max(1, len(words) - shingle + 1)
    for first in range(0, total, _STEP):
        part = words[first:min(first + _STEP, total) + shingle - 1]
        joined = b" ".join(part)
        ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        n = max(1, len(part) - shingle + 1)
        hashes = [xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(
            starts[:n].tolist(), ends[min(shingle, len(part)) - 1:].tolist())]
        bits = np.array(hashes, np.uint64).view(np.uint8).reshape(n, 8)
        ones += np.unpackbits(bits, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id``, the signed 64-bit ``fp`` and the text's key ``t1``, ``t2`` of every row."""
    @F.pandas_udf("long")
    def taken(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))

    small_batches(docs.sparkSession)
    text = F.col("text").cast("string")
    t1, t2 = text_key(F.coalesce(text, F.lit("")))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), t1.alias("t1"), t2.alias("t2"),
                       taken(text).alias("fp"))


def _grouped_bits(bits: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of nearly equal size, each filled with the bits that go together most."""
    spread = bits - bits.mean(axis=0)
    scale = np.sqrt((spread ** 2).sum(axis=0)) + 1e-9
    alike = np.abs(spread.T @ spread) / np.outer(scale, scale)
    free, groups = set(range(64)), []
    for k in range(parts, 0, -1):
        room = len(free) // k
        rest = sorted(free)
        own = [max(rest, key=lambda b: alike[b, rest].sum())]
        while len(own) < room:
            own.append(max((b for b in rest if b not in own), key=lambda b: alike[b, own].sum()))
        groups.append(sorted(own))
        free -= set(own)
    return groups


def plan(sample: np.ndarray, total: int, distance: int = DISTANCE) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each part that is probed, for ``total`` different fingerprints.

    For each number of parts a dynamic programme shares distance - m + 1 out over the parts, from -1
    (the part is not probed) upwards; the cost is the estimated candidate pairs, carried from the
    sample to all fingerprints, plus the rows that the probes make.
    """
    if not len(sample):
        return []
    bits = np.unpackbits(sample.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
    pairs = max(1, len(sample) * (len(sample) - 1) // 2)
    best: tuple[float, list[tuple[list[int], int]]] = (np.inf, [])
    for parts in range(1, distance + 2):
        groups, budget = _grouped_bits(bits, parts), distance - parts + 1
        costs = []
        for own in groups:
            x = bits[:, own]
            ones = x.sum(axis=1)
            apart = (ones[:, None] + ones[None, :] - 2 * (x @ x.T)).astype(np.uint8)
            near = np.bincount(apart.ravel(), minlength=distance + 1).cumsum() - len(x)
            # A share of pairs that the sample can't show is taken as for independent bits.
            chance = np.cumsum([comb(len(own), t) for t in range(distance + 1)]) / 2.0 ** len(own)
            share = np.maximum(near[: distance + 1] / 2 / pairs, chance)
            costs.append([0.0] + [share[t] * total ** 2 / 2 + 40.0 * total * comb(len(own), t)
                                  for t in range(budget + parts)])
        states = {0: (0.0, [])}  # thresholds, each plus one, that are dealt out so far
        for cost in costs:
            after = {}
            for used, (so_far, chosen) in states.items():
                for t1, c in enumerate(cost):
                    if used + t1 <= budget + parts and (
                            used + t1 not in after or so_far + c < after[used + t1][0]):
                        after[used + t1] = (so_far + c, chosen + [t1 - 1])
            states = after
        value, thresholds = states[budget + parts]
        if value < best[0]:
            best = (value, [(g, t) for g, t in zip(groups, thresholds) if t >= 0])
    return best[1]


def _keys_of(fp: np.ndarray, probes: list[int]) -> np.ndarray:
    """(rows, probes): the part's value with the probe's erased bits left out."""
    return fp[:, None] & np.array(probes, np.uint64)[None, :]


def _masks(parts: list[tuple[list[int], int]]) -> list[int]:
    """The bits that each probe compares."""
    found = []
    for own, t in parts:
        for erased in combinations(own, t):
            found.append(sum(1 << b for b in own if b not in erased))
    return found


def _tree(members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the members, with at most FAN_OUT + 1 at each."""
    child = np.arange(1, len(members))
    return members[child], members[(child - 1) // FAN_OUT]


def _linked(values: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Trees over the sets of values that links within ``distance`` join, by breadth-first search.

    Each value is compared once with those not yet reached, so no list of pairs is made.
    """
    left = values
    while len(left):
        found, todo, left = [left[:1]], [left[0]], left[1:]
        while todo and len(left):
            near = np.bitwise_count(left ^ todo.pop()) <= distance
            if near.any():
                reached = left[near]
                found.append(reached)
                todo.extend(reached)
                left = left[~near]
        members = np.concatenate(found)
        if len(members) > 1:
            yield _tree(members)


def _bucket_links(distance: int):
    """Verify the buckets of a partition that is sorted by bucket."""
    def small(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All links inside buckets of a few rows at once, by comparing rows a fixed step apart."""
        group = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        a, b, step = [], [], 1
        rows = np.arange(len(values))
        while len(rows):
            rows = rows[rows + step < len(values)]
            rows = rows[group[rows] == group[rows + step]]
            near = rows[np.bitwise_count(values[rows] ^ values[rows + step]) <= distance]
            a.append(values[near])
            b.append(values[near + step])
            step += 1
        return (np.concatenate(a), np.concatenate(b)) if a else (values[:0], values[:0])

    def links(sorted_keys: np.ndarray, values: np.ndarray) -> Iterator[pd.DataFrame]:
        cuts = np.flatnonzero((sorted_keys[1:] != sorted_keys[:-1]).any(axis=1)) + 1
        bounds = np.concatenate([[0], cuts, [len(values)]])
        sizes = np.diff(bounds)
        few = np.repeat((sizes > 1) & (sizes <= 32), sizes)
        kept = sizes[(sizes > 1) & (sizes <= 32)]
        out = [small(values[few], np.concatenate([[0], np.cumsum(kept)]).astype(np.int64))]
        for g in np.flatnonzero(sizes > 32):
            out.extend(_linked(values[bounds[g]:bounds[g + 1]], distance))
        a, b = (np.concatenate(x) for x in zip(*out))
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
        yield pd.DataFrame({"a": pairs[:, 0].view(np.int64), "b": pairs[:, 1].view(np.int64)})

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held_k, held_v, held = [], [], 0
        for batch in batches:
            held_k.append(batch[["probe", "key", "piece"]].to_numpy(np.int64))
            held_v.append(batch["fp"].to_numpy(np.int64).view(np.uint64))
            held += len(batch)
            if held < 500_000:
                continue
            k, v = np.concatenate(held_k), np.concatenate(held_v)
            changes = np.flatnonzero((k[1:] != k[:-1]).any(axis=1))
            if len(changes):  # the last bucket may go on in the next batch
                end = changes[-1] + 1
                yield from links(k[:end], v[:end])
                k, v = k[end:], v[end:]
            held_k, held_v, held = [k], [v], len(k)
        if held:
            yield from links(np.concatenate(held_k), np.concatenate(held_v))

    return rows


def links(distinct: DataFrame, distance: int = DISTANCE, block: int = BLOCK) -> DataFrame:
    """(a, b): enough links between different fingerprints to join all that are near each other.

    ``distinct`` is a stored table with one row for each ``fp``. A bucket of more than ``block`` rows
    is cut into pieces by a hash, and each pair of its pieces becomes a bucket of its own.
    """
    spark, total = distinct.sparkSession, distinct.count()
    small_batches(spark, 10_000)
    sample = np.array([r.fp for r in distinct.orderBy(F.xxhash64("fp"), "fp").limit(PLAN_SAMPLE).collect()], np.int64)
    masks = _masks(plan(sample.view(np.uint64), total, distance))

    def probes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fp = batch["fp"].to_numpy(np.int64)
            keys = _keys_of(fp.view(np.uint64), masks)
            yield pd.DataFrame({
                "probe": np.tile(np.arange(len(masks), dtype=np.int32), len(fp)),
                "key": keys.ravel().view(np.int64), "fp": np.repeat(fp, len(masks))})

    if not masks:
        return spark.createDataFrame([], "a long, b long")
    dealt = distinct.select("fp").mapInPandas(probes, "probe int, key long, fp long")
    crowded = dealt.groupBy("probe", "key").count().where(F.col("count") > block) \
        .select(F.col("probe").alias("p"), F.col("key").alias("k"), "count")
    crowded = materialize(crowded, "crowded-buckets")
    if crowded.isEmpty():
        pieces = dealt.withColumn("piece", F.lit(0).cast("long"))
    else:
        n = F.ceil(2 * F.col("count") / block).cast("long")
        own = F.pmod(F.xxhash64("fp"), F.col("n"))
        meets = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda i: F.least(i, own) * F.col("n") + F.greatest(i, own))
        pieces = dealt.join(crowded, (F.col("probe") == F.col("p")) & (F.col("key") == F.col("k")), "left") \
            .withColumn("n", F.coalesce(n, F.lit(1).cast("long"))) \
            .select("probe", "key", "fp", F.explode(meets).alias("piece"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = pieces.repartition(parts, "probe", "key", "piece") \
        .sortWithinPartitions("probe", "key", "piece", "fp")
    return sorted_rows.mapInPandas(_bucket_links(distance), "a long, b long").distinct()


def components(distinct: DataFrame, edges: DataFrame) -> DataFrame:
    """``fp`` and the smallest ``label`` that links lead to, for each row (fp, label) of ``distinct``.

    A label is the smallest id of a fingerprint and the fingerprint, which tells components without
    ids apart.

    Every label points at a smaller one, at first itself. In each round a label takes the smallest
    label two steps up from itself and from its neighbours, and passes it to the label it pointed at, so
    whole trees hang onto others and halve in height: rounds grow with the logarithm of a chain's
    length, and each stores one table.
    """
    names = distinct.select(F.col("fp").alias("f"), F.col("label"))
    ends = edges.join(names, F.col("a") == F.col("f")).select(F.col("label").alias("u"), "b") \
        .join(names, F.col("b") == F.col("f")).select("u", F.col("label").alias("v"))
    both = materialize(ends.union(ends.select("v", "u")), "links")
    up = materialize(both.select(F.col("u").alias("node")).distinct().withColumn("top", F.col("node")), "labels")
    while True:
        above = up.select(F.col("node").alias("_node"), F.col("top").alias("over"))
        two = up.join(above, F.col("top") == F.col("_node")).select("node", "top", "over")
        near = both.join(two, F.col("v") == F.col("node")).groupBy("u").agg(F.min("over").alias("near"))
        reached = two.join(near, F.col("node") == F.col("u")).select("node", "top", "over", "near")
        offers = reached.select("node", F.col("top").alias("was"), F.least("over", "near").alias("top")) \
            .unionByName(reached.select(F.col("top").alias("node"), F.lit(None).alias("was"), F.col("near").alias("top")))
        after = materialize(offers.groupBy("node").agg(F.min("top").alias("top"), F.min("was").alias("was")), "labels")
        if after.where("top != was").isEmpty():
            break
        up = after.select("node", "top")
    moved = after.select(F.col("node").alias("l"), F.col("top").alias("to"))
    return distinct.join(moved, F.col("label") == F.col("l"), "left") \
        .select("fp", F.coalesce("to", "label").alias("label"))


def _marked(docs: DataFrame, shingle: int, distance: int) -> DataFrame:
    """Every row's ``doc_id``, ``fp``, text key and its component's ``label``."""
    found = materialize(fingerprints(docs, shingle), "fingerprints")
    distinct = materialize(found.groupBy("fp").agg(F.min("doc_id").alias("id")).select(
        "fp", F.struct(F.coalesce("id", F.lit(_NO_ID)).alias("id"), "fp").alias("label")), "distinct-fingerprints")
    # Stored, so that the last join stands alone and Spark can split a fingerprint that many share.
    named = materialize(components(distinct, links(distinct, distance)), "components") \
        .select(F.col("fp").alias("f"), "label")
    return found.join(named, F.col("fp") == F.col("f")).drop("f")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """``doc_id``, ``fingerprint`` and ``component_id`` of every row.

    Words are runs without ASCII white space, A-Z in lower case; a shingle is ``shingle`` words joined
    by a space, or all words of a shorter text. Texts without words, null ones included, have
    fingerprint zero and link like any other. ``component_id`` is the smallest id that links of at
    most ``distance`` bits lead to; a null id never is one unless its whole component has none, then
    it is null. Repeated rows get a row each, an empty table none; extra columns are ignored.
    """
    return _marked(docs, shingle, distance).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("label.id") != _NO_ID, F.col("label.id")).alias("component_id"))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row of each near-duplicate group, that with the smallest id, all columns unchanged.

    If that id has several texts in the group, or its rows repeat, one of them stays; of a group
    without ids, one row. Null texts are kept as what they are.
    """
    first = _marked(docs, shingle, distance) \
        .where(F.coalesce("doc_id", F.lit(_NO_ID)) == F.col("label.id")) \
        .groupBy("label").agg(F.min(F.struct("doc_id", "t1", "t2")).alias("r"))
    id_, t1, t2, n, i, a, b = fresh_names(docs, "_id", "_t1", "_t2", "_n", "_i", "_a", "_b")
    k1, k2 = text_key(F.coalesce(F.col("text").cast("string"), F.lit("")))
    # Repeated rows go before the shuffle; the join then finds its rows where they are.
    rows = once(docs.withColumns({id_: F.col("doc_id").cast("long"), t1: k1, t2: k2}), [id_, t1, t2], n)
    kept = first.select(F.col("r.doc_id").alias(i), F.col("r.t1").alias(a), F.col("r.t2").alias(b))
    same = F.col(id_).eqNullSafe(F.col(i)) & (F.col(t1) == F.col(a)) & (F.col(t2) == F.col(b))
    return rows.join(kept, same, "left_semi").select(*docs.columns)

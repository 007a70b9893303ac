"""Source divergence audit: how far each source's use of terms is from its language and its peers.

Arrow does the work inside the tasks. One pass over the texts splits, encodes and counts terms and
leaves partial counts, which Spark adds up. The kept terms of a language are then dealt into shards by
their hash; a shard is a small matrix of terms by sources, from which it gives its part of every sum.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import arrow_rows, materialize, slices

#: What stands between terms.
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: Documents of a language that a kept term is in, at least.
MIN_DOCS = 3
#: Terms reported for each group.
TOP_TERMS = 200
#: Partial counts that a task holds before it passes them on, in rows and in bytes.
HELD_ROWS = 1 << 18
HELD_BYTES = 16 << 20
#: Texts handed to a Python worker at once, and bytes of them that are split at once.
BATCH_ROWS = 1024
SLICE_BYTES = 4 << 20
#: Terms times sources in a shard, on average.
CELLS = 1 << 20

_COUNTS = "lang string, source string, term string, n long, docs long"
_VALUES = "lang string, source string, part string, item string, value long"


def _count_terms(batch: pa.Table) -> pa.Table:
    """Partial counts of some documents; a row without a term says that its group occurs."""
    lists = pc.split_pattern_regex(pc.ascii_lower(batch["text"].combine_chunks()), pattern=BETWEEN)
    terms = pc.list_flatten(lists).dictionary_encode()
    in_doc = pa.table({"doc": pc.list_parent_indices(lists), "code": terms.indices}) \
        .group_by(["doc", "code"], use_threads=False).aggregate([([], "count_all")])
    lang, source = (batch[c].combine_chunks().dictionary_encode() for c in ("lang", "source"))
    found = pa.table({
        "lang": lang.indices.take(in_doc["doc"]), "source": source.indices.take(in_doc["doc"]),
        "code": in_doc["code"], "n": in_doc["count_all"],
    }).group_by(["lang", "source", "code"], use_threads=False).aggregate([("n", "sum"), ([], "count_all")])
    counts = pa.table({
        "lang": lang.dictionary.take(found["lang"]), "source": source.dictionary.take(found["source"]),
        "term": terms.dictionary.take(found["code"]), "n": found["n_sum"], "docs": found["count_all"]})
    groups = batch.select(["lang", "source"]).group_by(["lang", "source"], use_threads=False).aggregate([])
    nothing = pa.array([0] * len(groups), pa.int64())
    present = pa.table({
        "lang": groups["lang"], "source": groups["source"], "term": pa.nulls(len(groups), pa.string()),
        "n": nothing, "docs": nothing})
    return pa.concat_tables([t.cast(present.schema) for t in (
        counts.filter(pc.not_equal(counts["term"], "")), present)])


def _merged(tables: list[pa.Table]) -> pa.Table:
    # One thread, which is what a task has; each more would hold counts of its own.
    found = pa.concat_tables(tables).group_by(["lang", "source", "term"], use_threads=False) \
        .aggregate([("n", "sum"), ("docs", "sum")])
    return found.rename_columns({"n_sum": "n", "docs_sum": "docs"}).select(["lang", "source", "term", "n", "docs"])


def _filled(tables: list[pa.Table]) -> float:
    """The share of what a task may hold that the tables take."""
    return max(sum(t.num_rows for t in tables) / HELD_ROWS, sum(t.nbytes for t in tables) / HELD_BYTES)


def partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.Table] = []
    for batch in batches:
        for part in slices(batch, "text", SLICE_BYTES):
            held.append(_count_terms(part))
            if _filled(held) > 1:
                held = [_merged(held)]
                if _filled(held) > 0.5:
                    yield from held.pop().to_batches(65_536)
    if held:
        yield from _merged(held).to_batches(65_536)


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term, as a stored table.

    Every group also has a row with a null term.
    """
    picked = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counts = picked.mapInArrow(partial_counts, _COUNTS).groupBy("lang", "source", "term") \
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    with arrow_rows(docs.sparkSession, BATCH_ROWS):
        return materialize(counts, "term-counts")


def share(count, total):
    """1 + floor(10 ** 9 * count / total), exact for totals up to 9 * 10 ** 15."""
    value, rest = np.divmod(count, total)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, total)
        value = value * 1000 + digit
    return value + 1


def gap(p, q):
    return (p - q) * (p - q) // q


def _pairs(cells: np.ndarray, p: np.ndarray, p0: np.ndarray) -> np.ndarray:
    """For each two sources the sum of gap(p of the first, p of the second) over the shard's terms.

    A source without a term has ``p0`` there. So the sums are first taken as if the first source had
    no term at all, and then corrected on the terms that it has: work in proportion to the cells
    that are not zero.
    """
    sums = np.zeros((len(p0), len(p0)), np.int64)
    has = cells > 0
    absent = len(cells) - has.sum(axis=0)
    held = [p[has[:, b], b] for b in range(len(p0))]
    for a in range(len(p0)):
        rows = p[has[:, a]]
        sums[a] = absent * gap(p0[a], p0) + [gap(p0[a], own).sum() for own in held] \
            + (gap(rows[:, a:a + 1], rows) - gap(p0[a], rows)).sum(axis=0)
    return sums


def _shard_values(top_terms: int):
    def values(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        seeds = table.filter(pc.is_null(table["term"])).sort_by("source")
        rows = table.filter(pc.is_valid(table["term"]))
        sources, n_sources = seeds["source"].combine_chunks(), seeds.num_rows
        found = []

        def put(part: str, of: np.ndarray, items: pa.Array, value: np.ndarray) -> None:
            found.append(pa.table({
                "lang": pa.array([key[0].as_py()] * len(value), pa.string()), "source": sources.take(pa.array(of)),
                "part": pa.array([part] * len(value), pa.string()), "item": items, "value": pa.array(value, pa.int64())}))

        first, second = (x.ravel() for x in np.indices((n_sources, n_sources)))
        apart = first != second
        sums = np.zeros((n_sources, n_sources), np.int64)
        if rows.num_rows:
            coded = rows["term"].combine_chunks().dictionary_encode()
            order = pc.array_sort_indices(coded.dictionary).to_numpy()  # bytewise
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            term, source = coded.indices.to_numpy(), pc.index_in(rows["source"].combine_chunks(), sources).to_numpy()
            kept = seeds["kept"][0].as_py()
            total = seeds["total"].to_numpy() + kept
            cells = np.zeros((len(order), n_sources), np.int64)
            cells[term, source] = rows["n"].to_numpy()
            p = share(cells + 1, total[None, :])
            sums = _pairs(cells, p, share(np.ones(n_sources, np.int64), total))
            own, whole = p[term, source], share(rows["lang_n"].to_numpy() + 1, seeds["lang_total"][0].as_py() + kept)
            value = gap(own, whole)
            more = np.flatnonzero(own > whole)
            more = more[np.lexsort((place[term[more]], -value[more], source[more]))]
            begin = np.searchsorted(source[more], source[more])  # no more than the group's best can count
            more = more[np.arange(len(more)) - begin < top_terms]
            put("term", source[more], coded.dictionary.take(pa.array(term[more])), value[more])
        put("pair", first[apart], sources.take(pa.array(second[apart])), sums.ravel()[apart])
        return pa.concat_tables(found)
    return values


def _shards(counts: DataFrame, min_docs: int, cells: int) -> DataFrame:
    """The kept terms' counts by (lang, shard); each shard also has a row for each source of its language."""
    kept = materialize(
        counts.where("term is not null").groupBy("lang", "term")
        .agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs).drop("docs"),
        "kept-terms")
    found = materialize(counts.drop("docs").join(kept, ["lang", "term"]), "kept-counts")
    langs = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"))
    sources = counts.where("term is null").select("lang", "source")
    groups = sources.join(found.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left") \
        .join(langs, "lang", "left").join(sources.groupBy("lang").agg(F.count("*").alias("width")), "lang") \
        .na.fill(0, ["total", "kept", "lang_total"])
    groups = materialize(groups.withColumn(
        "shards", F.greatest(F.lit(1), F.ceil(F.col("kept") * F.col("width") / cells)).cast("long")), "groups")
    columns = ["lang", "shard", "source", "term", "n", "lang_n", "total", "kept", "lang_total"]
    rows = found.join(groups.groupBy("lang").agg(F.max("shards").alias("shards")), "lang").withColumns({
        "shard": F.pmod(F.xxhash64("term"), "shards"),
        **{c: F.lit(None).cast("long") for c in ("total", "kept", "lang_total")}})
    seeds = groups.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1))).withColumns({
        "term": F.lit(None).cast("string"), "n": F.lit(0).cast("long"), "lang_n": F.lit(0).cast("long")})
    return rows.select(columns).unionByName(seeds.select(columns))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS, cells: int = CELLS) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value`` and ``rank`` for each group of documents.

    Terms are runs of ASCII letters and of anything beyond ASCII, A-Z in lower case. A language keeps
    the terms in at least ``min_docs`` of its documents; a group's p of a kept term is its smoothed share
    in billionths, and f the squared distance of two such shares over the second. Part ``pair`` has the
    sum of f over all kept terms for each other source of the language, part ``term`` the ``top_terms``
    terms that the group uses more than its language. Equal values rank by the item's bytes.

    Null texts, languages and sources are empty ones; every row is a document of its own, repeated
    ones too; a language that keeps no term has pairs of 0 and no terms, a language of one source no
    pairs; an empty table gives no rows; extra columns are ignored. ``cells`` changes no result.
    """
    shards = _shards(term_counts(docs), min_docs, cells)
    values = materialize(
        shards.groupBy("lang", "shard").applyInArrow(_shard_values(top_terms), _VALUES), "divergences")
    keys = ["lang", "source", "part", "item"]
    pairs = values.where("part = 'pair'").groupBy(*keys).agg(F.sum("value").alias("value"))
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = values.where("part = 'term'").withColumn("rank", F.row_number().over(ranked)) \
        .where(F.col("rank") <= top_terms)
    return pairs.withColumn("rank", F.row_number().over(ranked)).unionByName(terms)

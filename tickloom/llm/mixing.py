"""Mixing sources to target weights, in blocks of a fixed number of words.

The documents of a source, one after the other in a pseudorandom order, are cut into blocks of
``BLOCK`` words. The mix has slots: as many passes over a source's blocks as its target holds, and
of the last pass as many slots as make up the rest. Within a pass a slot reads the block that the
index permutation of the source and pass names.

How many slots of each source an output shard has is drawn first: a table of counts, multinomial under
the sources' totals, which are exact. The shards then take their slots of a source one after the other,
so it is the permutation that decides which blocks they get.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import WORD, fresh_names, materialize, offsets_in_groups, once, row_key

BLOCK = 128
SHARDS = 16
SEED = 20240501
WEIGHTS = (1, 2, 3)
#: A source's words are used this many times at most.
MOST = 3
#: Rounds of the index permutation.
ROUNDS = 24
#: Slots that one row stands for until it has been dealt to a task.
_SPAN = 65536


def words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """``source``, ``source_size`` and ``target`` for each source of the rows (source, size).

    Sources in code point order, null last, weigh 1, 2, 3, 1 and so on. In the order of their limit
    for each weight, a source is held to its limit as long as an even share of what is left is above
    it; all later ones share the rest evenly by weight.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.get(F.array(*map(F.lit, WEIGHTS)), (F.row_number().over(by_name) - 1) % len(WEIGHTS))
    weighed = sums.withColumn("weight", weight.cast("long")).withColumns({
        "limit": F.col("source_size") * MOST, "key": F.col("source_size") * MOST / F.col("weight")})
    order = Window.orderBy("key", F.col("source").asc_nulls_last())
    before, everything = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0))
    weights = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    shared = weighed.withColumn("share", left / weights).withColumn("held", F.col("share") > F.col("key"))
    even = F.min(F.when(~F.col("held"), F.struct("key", "source", "share"))).over(everything)["share"]
    return shared.select(
        "source", "source_size",
        F.when(F.col("held"), F.col("limit").cast("double")).otherwise(even * F.col("weight")).alias("target"))


def _hash(*parts: Column) -> Column:
    return F.xxhash64(F.lit(SEED), *parts)


def permuted(x: Column, key: Column, n: Column, back: bool = False) -> Column:
    """``x`` mapped by the permutation of 0 to n - 1 that ``key`` picks, or ``back``.

    A swap-or-not shuffle: in each round a number and its partner, whose sum is the round's, change
    places or not by a bit of the hash of the larger. A round undoes itself.
    """
    def swapped(v: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(_hash(F.lit("sum"), key, r), n) - v, n)
        return F.when(_hash(F.lit("swap"), key, r, F.greatest(v, partner)).bitwiseAND(F.lit(1)) == 1, partner).otherwise(v)

    rounds = reversed(range(ROUNDS)) if back else range(ROUNDS)
    return F.aggregate(F.array(*map(F.lit, rounds)), x, swapped)


def _each(chunks: DataFrame) -> DataFrame:
    """A row for each of the slots that the rows stand for, with its number in the source."""
    return chunks.withColumn("j", F.explode(F.sequence(
        F.col("from"), F.least(F.col("from") + _SPAN, F.col("count")) - 1))) \
        .withColumn("slot", F.col("epoch") * F.col("n") + F.col("j"))


def shard_counts(chunks: DataFrame, shards: int) -> DataFrame:
    """(source, shard, slots): how many of a source's slots each output shard gets, as a stored table.

    Every slot draws a shard, all alike, and the draws are counted.
    """
    drawn = F.pmod(_hash(F.lit("shard"), F.col("source"), F.col("slot")), F.lit(shards)).cast("int")
    return materialize(
        _each(chunks).groupBy("source", drawn.alias("shard")).agg(F.count("*").alias("slots")), "shard-counts")


def shard_ends(counts: DataFrame) -> DataFrame:
    """For each source its shards with the number of the slot after each one's last, in order."""
    upto = Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counts.withColumn("end", F.sum("slots").over(upto)).groupBy(F.col("source").alias("_source")).agg(
        F.array_sort(F.collect_list(F.struct("end", "shard"))).alias("ends"))


def slots(plan: DataFrame, block: int = BLOCK, shards: int = SHARDS) -> DataFrame:
    """Every slot of the mix: ``source``, ``slot``, ``epoch``, ``index``, ``use`` and ``shard``.

    A slot uses the first ``use`` words of block ``index``. All blocks but a source's last are full;
    the permutation is set so that the last is met at a known slot, which tells how many words
    the slots before any slot hold.
    """
    n = F.col("n")
    sized = plan.where(F.col("target") > 0).withColumns({
        "n": F.ceil(F.col("source_size") / block).cast("long"),
        "passes": F.floor(F.col("target") / F.col("source_size")).cast("long"),
    }).withColumns({
        "rest": F.round(F.col("target") - F.col("passes") * F.col("source_size")).cast("long"),
        "short": n * block - F.col("source_size"),
    })
    last = F.when(F.col("rest") > 0, F.least(n, F.ceil((F.col("rest") + F.col("short")) / block))).otherwise(0)
    passes = sized.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("passes")))).withColumns({
        "count": F.when(F.col("epoch") < F.col("passes"), n).otherwise(last).cast("long"),
        "key": _hash(F.col("source"), F.col("epoch"))})
    parts = passes.where("count > 0").withColumn("met", permuted(n - 1, F.col("key"), n, back=True)).withColumn(
        "from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("count") - 1, F.lit(_SPAN).cast("long"))))
    spread = parts.repartition(int(plan.sparkSession.conf.get("spark.sql.shuffle.partitions")), "source", "epoch", "from")
    ends = shard_ends(shard_counts(spread, shards))
    dealt = spread.join(ends, F.col("source").eqNullSafe(F.col("_source")))
    each = _each(dealt).withColumns({
        "index": permuted(F.col("j"), F.col("key"), n),
        "shard": F.get(F.filter("ends", lambda e: e["end"] > F.col("slot")), F.lit(0))["shard"]})
    held = F.when(F.col("j") == F.col("met"), block - F.col("short")).otherwise(block)
    before = F.col("j") * block - F.when(F.col("j") > F.col("met"), F.col("short")).otherwise(0)
    use = F.when(F.col("epoch") < F.col("passes"), held) \
        .otherwise(F.greatest(F.lit(0), F.least(held, F.col("rest") - before)))
    return each.select("source", "slot", "epoch", "index", use.cast("long").alias("use"), "shard").where("use > 0")


def sized_rows(docs: DataFrame) -> DataFrame:
    """``source``, ``size``, ``doc_id`` and the row's key, stored."""
    k1, k2 = row_key(docs)
    return materialize(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        words(F.col("text").cast("string")).alias("size"), k1.alias("k1"), k2.alias("k2")), "sizes")


def spans(rows: DataFrame, plan: DataFrame, block: int = BLOCK, shards: int = SHARDS) -> tuple[DataFrame, DataFrame]:
    """The rows with their ``start`` in the source, and the mix: which words of which row fill a slot.

    A row of the mix says that ``n`` words from word ``first`` of the document that starts at ``start``
    in ``source`` stand in ``slot`` of ``shard`` from word ``at``.
    """
    placed = materialize(offsets_in_groups(rows, ["source"], ["doc_id", "size", "k1", "k2"], "start", F.col("size")), "places")
    end = F.col("start") + F.col("size")
    blocks = placed.where("size > 0").withColumn("index", F.explode(F.sequence(
        F.floor(F.col("start") / block).cast("long"), F.floor((end - 1) / block).cast("long")))) \
        .withColumn("in", F.greatest(F.col("start"), F.col("index") * block)) \
        .select("source", "index", "start", "doc_id", "k1", "k2", "size",
                (F.col("in") - F.col("start")).alias("first"), (F.col("in") - F.col("index") * block).alias("at"),
                (F.least(end, (F.col("index") + 1) * block) - F.col("in")).alias("n"))
    taken = slots(plan, block, shards).select(
        F.col("source").alias("s"), F.col("index").alias("i"), "slot", "epoch", "use", "shard")
    same = F.col("source").eqNullSafe(F.col("s")) & (F.col("index") == F.col("i"))
    # Spark's estimate misses the rows that explode makes, so it must not choose a broadcast.
    mix = blocks.join(taken.hint("merge"), same).withColumn("n", F.least(F.col("n"), F.col("use") - F.col("at"))) \
        .where("n > 0").drop("s", "i", "use", "index")
    return placed, mix


def mix_counts(docs: DataFrame, block: int = BLOCK, shards: int = SHARDS) -> DataFrame:
    """How many words the mix takes of each row: doc_id, size, source_size, target, taken, shards.

    ``shards`` counts the output shards that these words go to (shard numbers modulo 64).

    Null texts have no words; rows without words are never taken. A null source is a source of its
    own; null ids and repeated rows are rows like any other; an empty table gives no rows, and texts
    without any word in the whole table targets of zero. Extra columns are ignored.
    """
    rows = sized_rows(docs)
    plan = materialize(targets(rows), "targets")
    placed, mix = spans(rows, plan, block, shards)
    sums = mix.groupBy(F.col("source").alias("s"), F.col("start").alias("b")).agg(
        F.sum("n").alias("taken"),
        F.bit_count(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("shard") % 64))).alias("shards"))
    same = F.col("source").eqNullSafe(F.col("s")) & (F.col("start") == F.col("b")) & (F.col("size") > 0)
    aims = plan.select(F.col("source").alias("z"), "source_size", "target")
    return placed.join(sums, same, "left").join(aims, F.col("source").eqNullSafe(F.col("z"))).select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        F.coalesce("shards", F.lit(0)).cast("int").alias("shards"))


def mixed_documents(docs: DataFrame, block: int = BLOCK, shards: int = SHARDS) -> DataFrame:
    """The mix as documents: a row for each pass in which words of a row are taken.

    A row taken whole stays as it is; of one taken in part the text is the taken words with a space
    between them. ``n_chars``, if there is one, counts the text's code points. All other columns are
    the row's own. Rows without words, null texts included, are not in a mix.
    """
    rows = sized_rows(docs)
    _, mix = spans(rows, materialize(targets(rows), "targets"), block, shards)
    k1, k2, a, b, part, m = fresh_names(docs, "_k1", "_k2", "_a", "_b", "_part", "_m")
    passes = mix.groupBy("source", "start", "epoch").agg(
        F.min("k1").alias(a), F.min("k2").alias(b), F.min("size").alias("size"), F.sum("n").alias("n"),
        F.array_sort(F.collect_list(F.struct("first", F.col("n").alias("n")))).alias(part)) \
        .select(a, b, F.when(F.col("n") < F.col("size"), F.col(part)).alias(part))
    h1, h2 = row_key(docs)
    texts = once(docs.withColumns({k1: h1, k2: h2}), [k1, k2], m)
    found = texts.join(passes, (F.col(k1) == F.col(a)) & (F.col(k2) == F.col(b)))
    # Words are told from one another once for each text; white space at its start gives no word.
    all_words = F.filter(F.split(F.col("text").cast("string"), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    some = F.get(F.transform(F.array(all_words), lambda ws: F.array_join(F.flatten(F.transform(
        F.col(part), lambda p: F.slice(ws, p["first"].cast("int") + 1, p["n"].cast("int")))), " ")), F.lit(0))
    whole = found.withColumn("text", F.when(F.col(part).isNull(), F.col("text")).otherwise(some))
    return whole.select(*[
        F.char_length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c)
        for c in docs.columns])

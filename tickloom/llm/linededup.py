"""Line dedup: keep the first document's copy of a line, as bitmaps over each document's lines."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import fresh_names, materialize, text_key

#: Lines whose key is shorter than this many code points always stay.
MIN_CHARS = 10
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WHITE = "\t\n\x0b\x0c\r "


def lines_of(text: Column) -> Column:
    """The lines of a text; null and empty have one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(WHITE)), UPPER, LOWER)


def _first_of(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows sorted within each key by document and position, with the key's first document.

    The range partitioning on the keys is the distribution that the window needs, so there is no
    second shuffle, and the window streams over the sorted rows.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = Window.partitionBy(*keys).orderBy(F.col("id").asc_nulls_last(), "pos") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.repartitionByRange(n, *keys).withColumn("first_id", F.first("id").over(ordered))


def _later(row_id: str, first_id: str) -> Column:
    """True where another, smaller document holds the line first."""
    return F.col(first_id).isNotNull() & ~F.col(row_id).eqNullSafe(F.col(first_id))


def repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(id, text key, pos) of every line that a smaller document holds already.

    A key's rows are first ranked in as many parts as a shuffle has, so that one line may fill a
    third of all rows. The number of parts changes nothing in the result.
    """
    salts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    k1, k2 = text_key(F.coalesce(F.col("text"), F.lit("")))
    lines = docs.select("id", k1.alias("t1"), k2.alias("t2"),
                        F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
    keyed = lines.withColumn("key", line_key(F.col("line"))) \
        .where(F.char_length("key") >= min_chars)
    h1, h2 = text_key(F.col("key"))
    stored = materialize(keyed.select(
        h1.alias("h1"), h2.alias("h2"),
        F.pmod(F.xxhash64("id", "t1"), F.lit(salts)).cast("int").alias("salt"),
        "id", "t1", "t2", "pos"), "line-keys")
    parts = _first_of(stored, "h1", "h2", "salt")
    late = _later("id", "first_id")
    # What is first in its part meets the other parts' firsts: at most one document for each part.
    firsts = _first_of(parts.where(~late).drop("first_id", "salt"), "h1", "h2")
    return parts.where(late).select("id", "t1", "t2", "pos") \
        .unionByName(firsts.where(late).select("id", "t1", "t2", "pos"))


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """One compressed keep bitmap for each (document, text) that loses lines.

    ``keep`` is an array of (skip, bits): ``skip`` words of 64 lines that all stay, then a word whose
    bit i says whether its line i stays; lines after the last word stay. ``t1`` and ``t2`` tell the
    text, so that repeated ids with different texts each have their own.
    """
    word = repeated_lines(docs, min_chars).groupBy(
        "id", "t1", "t2", F.floor(F.col("pos") / 64).cast("int").alias("word")) \
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("pos") % 64)).alias("dropped"))
    by_doc = Window.partitionBy("id", "t1", "t2").orderBy("word")
    runs = word.select(
        "id", "t1", "t2", "word", F.bitwise_not("dropped").alias("bits"), F.bit_count("dropped").alias("n"),
        (F.col("word") - F.coalesce(F.lag("word").over(by_doc), F.lit(-1)) - 1).alias("skip"))
    return runs.groupBy("id", "t1", "t2").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("word", "skip", "bits"))),
                    lambda x: F.struct(x["skip"].alias("skip"), x["bits"].alias("bits"))).alias("keep"),
        F.sum("n").cast("long").alias("n_dropped"))


def kept_text(text: Column, keep: Column) -> Column:
    """The lines that a keep bitmap leaves, joined by newlines."""
    words = F.flatten(F.transform(keep, lambda x: F.concat(
        F.array_repeat(F.lit(-1).cast("long"), x["skip"]), F.array(x["bits"]))))

    def left(bitmap: Column) -> Column:
        def stays(line: Column, i: Column) -> Column:
            bits = F.coalesce(F.get(bitmap, F.floor(i / 64).cast("int")), F.lit(-1).cast("long"))
            return F.getbit(bits, (i % 64).cast("int")) == 1
        return F.array_join(F.filter(lines_of(text), stays), "\n")

    # Bound by a lambda, the bitmap is unpacked once for each text and not for each line.
    return F.when(keep.isNull(), F.coalesce(text, F.lit(""))).otherwise(
        F.get(F.transform(F.array(words), left), F.lit(0)))


def _with_keep(docs: DataFrame, min_chars: int) -> tuple[DataFrame, str, str]:
    """``docs`` with the keep bitmap and the number of dropped lines of each row, and these names."""
    id_, t1, t2, keep, n = fresh_names(docs, "_id", "_t1", "_t2", "_keep", "_n_dropped")
    text = docs["text"].cast("string")
    narrow = docs.select(docs["doc_id"].cast("long").alias("id"), text.alias("text"))
    maps = keep_bitmaps(narrow, min_chars).select(
        F.col("id").alias(id_), F.col("t1").alias(t1), F.col("t2").alias(t2),
        F.col("keep").alias(keep), F.col("n_dropped").alias(n))
    k1, k2 = text_key(F.coalesce(text, F.lit("")))
    same = docs["doc_id"].cast("long").eqNullSafe(F.col(id_)) & (k1 == F.col(t1)) & (k2 == F.col(t2))
    return docs.join(maps, same, "left").drop(id_, t1, t2), keep, n


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id``, the kept ``text``, ``n_lines``, ``n_dropped`` and the ``keep`` bitmap of every row.

    A line's key is the line without ASCII white space at its ends and with A-Z in lower case. Keys
    of at least ``min_chars`` code points in two documents or more stay only in the document with the
    smallest id, there with all their lines. Null and empty texts have one empty line and stay
    empty; a null id counts as one document after all others; repeated rows of an id are one
    document, each row keeps its lines; an empty table gives no rows; extra columns are ignored.
    """
    found, keep, n = _with_keep(docs, min_chars)
    text = F.col("text").cast("string")
    return found.select(
        "doc_id", kept_text(text, F.col(keep)).alias("text"),
        F.size(lines_of(text)).cast("long").alias("n_lines"),
        F.coalesce(n, F.lit(0)).cast("long").alias("n_dropped"), F.col(keep).alias("keep"))


def kept_documents(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with their own columns, ``text`` reduced to the kept lines.

    ``n_chars``, if there is one, counts the code points that are left. Documents stay even when all
    their lines go. Null texts become empty; the rest is as for ``dedup_lines``.
    """
    found, keep, _ = _with_keep(docs, min_chars)
    kept = found.withColumn("text", kept_text(F.col("text").cast("string"), F.col(keep)))
    columns = [F.char_length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c)
               for c in docs.columns]
    return kept.select(*columns)

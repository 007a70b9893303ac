import pytest
from pyspark.sql import types as T

#: Columns of documents, and others with the names that operators use inside.
DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    *[T.StructField(n, T.StringType()) for n in ("key", "k1", "n", "_n", "_m", "id", "size", "_keep", "part", "shard")],
])
LINE = "The same passage stands in many of these documents"


def rows(texts, source="a"):
    return [(i, t, "en", source, None if t is None else len(t), *["x"] * 10) for i, t in texts]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows and ids, odd white space."""
    long = " ".join(f"word{i % 997}" for i in range(60_000))
    texts = rows([
        (1, f"{LINE}\nfirst own line of one\n{LINE}"), (2, f"  {LINE.upper()}\t\nfirst own line of two"),
        (3, None), (4, ""), (5, long), (6, long + " more"), (7, f"{LINE}\r\n\n short \n short "),
        (8, "repeated row"), (8, "repeated row"), (9, "one id"), (9, "two texts of it and more"),
        (None, f"{LINE}\nno id"), (None, None), (10, "\x0b\t \n"), (11, "ÄÖÜ äöü straße und 漢字 🙂🙂"),
        (12, "a b c d e f g h"), (13, "A B C D E F G H"), (-1, "a b c d e f g i"),
    ]) + rows([(20, "null source here"), (21, "")], None) + rows([(22, "￿ last source")], "\U0001F600")
    return spark.createDataFrame(texts, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)

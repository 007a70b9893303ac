"""Topics and lake tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.contracts import contract_for
from tickloom.operators.contract import check_json, valid_records
from tickloom.session import folder_names
from tickloom.sources import versions

RAW, ERRORS = "raw", "errors"
#: Where a layer keeps its rows' hashes; readers of the layer's folder skip it.
SEEN = "_seen/"


def read_topic(
    spark: SparkSession,
    location: str,
    topic: str,
    start: str = "earliest",
    connector: str = "kafka",
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Streaming ``value`` text of a topic.

    ``connector="kafka"`` reads a broker list (needs the Kafka package on the class path);
    ``"files"`` reads text files that arrive under ``location/topic``, one message per line.
    Landing starts at ``earliest``, scoring and views at ``latest``.
    """
    reader = spark.readStream.options(**(options or {}))
    if connector == "kafka":
        stream = (
            reader.format("kafka")
            .option("kafka.bootstrap.servers", location)
            .option("subscribe", topic)
            .option("startingOffsets", start)
            .load()
        )
        return stream.select(F.col("value").cast("string").alias("value"))
    return reader.format("text").load(f"{location}/{topic}").select("value")


def raw_day_path(root: str, topic: str, date: str) -> str:
    year, month, day = date.split("-")
    return f"{root}/zone={RAW}/topic={topic}/year={year}/month={month}/day={day}"


def read_raw_lines(spark: SparkSession, root: str, topic: str, date: str) -> DataFrame:
    """Landed text ``value`` of one topic and day; a missing day fails."""
    return (
        spark.read.option("recursiveFileLookup", "true")
        .text(raw_day_path(root, topic, date)).select("value")
    )


def checked_lines(lines: DataFrame, topic: str) -> DataFrame:
    """Landed lines read by the topic's contract, as the landing did.

    A number that was sent as text is read as the number; a line that is no such record, cut short
    for instance, has ``valid`` false.
    """
    return check_json(lines, contract_for(topic))


def read_raw_day(spark: SparkSession, root: str, topic: str, date: str) -> DataFrame:
    """Landed records of one topic and day with the declared schema."""
    return valid_records(checked_lines(read_raw_lines(spark, root, topic, date), topic))


def layer_path(root: str, layer: str) -> str:
    return f"{root}/{layer}"


def read_layer(spark: SparkSession, root: str, layer: str, date: str | None = None) -> DataFrame:
    """A curated layer as its newest manifest shows it: one date, or all dates.

    Folders without a manifest are read as they are.
    """
    path = layer_path(root, layer)
    entries = versions.manifest(spark, path).entries
    if not entries:
        table = spark.read.parquet(path)
        return table if date is None else table.where(F.col("date") == F.lit(date).cast("date"))
    dates = sorted(entries) if date is None or date not in entries else [date]
    table = versions.read_folders(spark, path, [f for d in dates for f in entries[d].data])
    return table if date is None or date in entries else table.where(F.lit(False))


def layer_folders(spark: SparkSession, root: str, layer: str, date: str | None = None) -> list[str]:
    """Paths of the folders that make up a layer, or a date of it."""
    path = layer_path(root, layer)
    entries = versions.manifest(spark, path).entries
    return [f"{path}/{f}" for d, entry in sorted(entries.items()) if date is None or d == date for f in entry.data]


def write_date(df: DataFrame, root: str, layer: str, date: str) -> None:
    """Replace one date of a layer and leave the others alone."""
    Staged(df, root, layer, date).publish()


def write_table(df: DataFrame, root: str, layer: str) -> None:
    Staged(df, root, layer).publish()


class Staged:
    """Rows written for a layer, or one date of it, that readers don't see before ``publish``."""

    def __init__(self, df: DataFrame, root: str, layer: str, date: str = versions.ALL):
        self.spark, self.layer, self.date = df.sparkSession, layer, date
        self.path = layer_path(root, layer)
        self.folder = versions.stage(df, self.path, date)

    def read(self) -> DataFrame:
        return versions.read_folders(self.spark, self.path, [self.folder])

    def publish(self, **more: list[str]) -> None:
        """Show these rows in the place of the layer's, or of the date's."""
        versions.switch(self.spark, self.path, {self.date: versions.Entry([self.folder], **more)})


def append_landed(rows: DataFrame, seen: DataFrame, root: str, layer: str, date: str, batches: list[str]) -> None:
    """Add rows that new landed batches bring, and their hashes, to a date, by one switch."""
    spark, path = rows.sparkSession, layer_path(root, layer)
    entry = versions.manifest(spark, path).entries.get(date, versions.Entry())
    data, hashes = versions.stage(rows, path, date), versions.stage(seen, path, date, SEEN)
    versions.switch(spark, path, {date: versions.Entry(
        [*entry.data, data], [*entry.seen, hashes], [*entry.batches, *batches])})


def new_batches(spark: SparkSession, root: str, topic: str, date: str, layer: str) -> list[str]:
    """Landed batches of a topic and day that are not in the layer yet."""
    done = versions.manifest(spark, layer_path(root, layer)).entries.get(date, versions.Entry()).batches
    return sorted(set(folder_names(spark, raw_day_path(root, topic, date))) - set(done))


def read_landed(spark: SparkSession, root: str, topic: str, date: str, batches: list[str]) -> DataFrame:
    """Landed text ``value`` of some batches of a topic and day; no other file is looked at."""
    day = raw_day_path(root, topic, date)
    return spark.read.option("recursiveFileLookup", "true").text([f"{day}/{b}" for b in batches]).select("value")


def has_date(spark: SparkSession, root: str, layer: str, date: str) -> bool:
    return date in versions.manifest(spark, layer_path(root, layer)).entries


def keep_hashes(hashes: DataFrame, root: str, layer: str, date: str) -> DataFrame:
    """Store the hashes of all rows of a date beside it."""
    spark, path = hashes.sparkSession, layer_path(root, layer)
    entry = versions.manifest(spark, path).entries[date]
    folder = versions.stage(hashes, path, date, SEEN)
    versions.switch(spark, path, {date: versions.Entry(entry.data, [folder], entry.batches)})
    return seen_hashes(spark, root, layer, date)


def seen_hashes(spark: SparkSession, root: str, layer: str, date: str) -> DataFrame | None:
    """Hashes of the rows of a date, if they are kept for all of its rows."""
    path = layer_path(root, layer)
    entry = versions.manifest(spark, path).entries.get(date, versions.Entry())
    if not entry.seen:
        return None
    return spark.read.parquet(*[f"{path}/{f}" for f in entry.seen])

"""Topics to the raw zone of the lake, violations to its error zone."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.functions.contracts import contract_for
from tickloom.functions.numbers import event_date
from tickloom.operators.contract import check_json, error_text
from tickloom.session import folder_names, read_text, write_text
from tickloom.sources.lake import ERRORS, RAW, read_topic
from tickloom.streaming.flushing import start_flushed
from tickloom.streaming.live import LiveQuery

FLUSH_RECORDS = 1000
FLUSH_INTERVAL = "60 seconds"
FLUSH_AGE = 60_000

# Kafka options that hold a batch back until it is full or old enough.
KAFKA_FLUSH = {
    "minOffsetsPerTrigger": str(FLUSH_RECORDS),
    "maxTriggerDelay": FLUSH_INTERVAL,
}


def route(messages: DataFrame, topic: str) -> DataFrame:
    """``zone, topic, value``: valid records as received, the others as dead-letter envelopes.

    Dead-letter topics have no contract; what they carry goes to the error zone untouched.
    """
    contract = contract_for(topic)
    if contract is None:
        zone = ERRORS if topic.endswith("-dlq") else RAW
        return messages.select(
            F.lit(zone).alias("zone"), F.lit(topic).alias("topic"), "value", "ingested_at"
        )
    checked = check_json(messages, contract)
    envelope = F.to_json(F.struct(
        error_text().alias("error"),
        F.lit(topic).alias("topic"),
        F.col("raw"),
        F.date_format("ingested_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
    ))
    return checked.select(
        F.when(F.col("valid"), RAW).otherwise(ERRORS).alias("zone"),
        F.when(F.col("valid"), topic).otherwise(f"{topic}-dlq").alias("topic"),
        F.when(F.col("valid"), F.col("raw")).otherwise(envelope).alias("value"),
        "ingested_at",
    )


def write_routed(routed: DataFrame, root: str, batch: str) -> None:
    """One write for both zones. Writing a batch again replaces what it wrote before."""
    day = event_date(F.unix_millis("ingested_at"))
    (
        routed.select(
            "value", "zone", "topic",
            F.date_format(day, "yyyy").alias("year"),
            F.date_format(day, "MM").alias("month"),
            F.date_format(day, "dd").alias("day"),
            F.lit(batch).alias("batch"),
        )
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("zone", "topic", "year", "month", "day", "batch")
        .text(root)
    )


def start_landing(
    stream: DataFrame,
    topic: str,
    root: str,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Land a topic's ``value`` stream.

    The ingest time is the batch time, which Spark records with the offsets: a batch replayed
    after a failure lands in the same folders and replaces its first attempt.
    """
    def land(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or ""
        write_routed(route(batch, topic), root, f"{query[:8]}-{batch_id}")

    return (
        stream.withColumn("ingested_at", F.current_timestamp())
        .writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": FLUSH_INTERVAL}))
        .start()
    )


def start_topic_landing(
    spark: SparkSession, location: str, topic: str, root: str, checkpoint: str,
    connector: str = "kafka", trigger: dict | None = None,
    records: int = FLUSH_RECORDS, age: int = FLUSH_AGE,
) -> StreamingQuery | LiveQuery:
    """Land a topic from its beginning, flushed when a batch is full or old enough.

    Kafka holds a batch back until then; messages from files wait in a buffer.
    """
    if connector == "kafka":
        options = KAFKA_FLUSH | {"minOffsetsPerTrigger": str(records), "maxTriggerDelay": f"{age} milliseconds"}
        return start_landing(
            read_topic(spark, location, topic, "earliest", connector, options), topic, root, checkpoint, trigger)
    return start_flushed(
        read_topic(spark, location, topic, "earliest", connector),
        lambda messages, name: write_routed(route(messages, topic), root, f"flush-{name}"),
        checkpoint, records, age, trigger)


Sink = Callable[[DataFrame, int], None]


def _send(messages: DataFrame, location: str, topic: str, connector: str | Sink, batch_id: int) -> None:
    """Write ``key`` and ``value`` of one batch to a topic.

    A file topic has a folder for each batch, so a batch that is sent again replaces itself; elsewhere
    the keys tell what has been sent before.
    """
    if callable(connector):
        connector(messages, batch_id)
    elif connector == "kafka":
        (
            messages.write.format("kafka").option("kafka.bootstrap.servers", location)
            .option("topic", topic).option("kafka.acks", "all").option("kafka.retries", "5")
            .save()
        )
    else:
        messages.select("value").write.mode("overwrite").text(f"{location}/{topic}/batch={batch_id}")


def _keyed(values: DataFrame, batch_id: int) -> DataFrame:
    """``key`` and ``value``: the same record of the same batch has the same key however often it is sent."""
    return values.select(F.concat(F.lit(f"{batch_id}-"), F.sha2("value", 256)).alias("key"), "value")


def publish(
    records: DataFrame, location: str, topic: str, connector: str | Sink = "kafka", batch_id: int = 0
) -> None:
    """Write one batch of records to a topic as JSON values.

    ``connector`` is ``"kafka"``, ``"files"``, or a function of the messages and the batch number.
    """
    values = records.select(F.to_json(F.struct("*")).alias("value"))
    _send(_keyed(values, batch_id), location, topic, connector, batch_id)


def publish_or_keep(
    records: DataFrame, location: str, topic: str, errors: str, connector: str | Sink = "kafka",
    batch_id: int = 0,
) -> bool:
    """Publish a batch; if that fails after Spark's task retries, keep it in an error table.

    The table is an outbox: ``resend`` sends what it keeps as soon as the topic takes it.
    """
    try:
        publish(records, location, topic, connector, batch_id)
        return True
    except Exception as failure:  # noqa: BLE001 - any sink failure is dead-lettered
        records.select(
            F.lit(str(failure)).alias("error"),
            F.lit(topic).alias("topic"),
            F.lit(None).cast("string").alias("raw"),
            F.to_json(F.struct("*")).alias("original_payload"),
            F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
            .alias("timestamp"),
        ).write.mode("overwrite").parquet(f"{errors}/batch={batch_id}")
        write_text(records.sparkSession, f"{errors}/_attempts/{batch_id}", "1")
        return False


def waiting(spark: SparkSession, errors: str) -> list[int]:
    """Batches of an error table that have not been sent yet."""
    kept = {int(name.removeprefix("batch=")) for name in folder_names(spark, errors) if name.startswith("batch=")}
    return sorted(kept - {int(name) for name in folder_names(spark, f"{errors}/_sent")})


def resend(
    spark: SparkSession, location: str, topic: str, errors: str, connector: str | Sink = "kafka"
) -> list[int]:
    """Send what an error table keeps, oldest batch first, up to the first that fails again.

    Sent batches are marked with the number of attempts and stay in the table. One that was sent but
    not marked is sent again with the same keys.
    """
    sent = []
    for batch_id in waiting(spark, errors):
        attempts = int(read_text(spark, f"{errors}/_attempts/{batch_id}")) + 1
        kept = spark.read.parquet(f"{errors}/batch={batch_id}")
        try:
            _send(_keyed(kept.select(F.col("original_payload").alias("value")), batch_id), location, topic, connector, batch_id)
        except Exception:  # noqa: BLE001 - it stays in the table
            write_text(spark, f"{errors}/_attempts/{batch_id}", str(attempts))
            break
        write_text(spark, f"{errors}/_sent/{batch_id}", str(attempts))
        sent.append(batch_id)
    return sent


def start_publishing(
    results: DataFrame, location: str, topic: str, errors: str, checkpoint: str,
    connector: str | Sink = "kafka", trigger: dict | None = None,
) -> StreamingQuery:
    """Publish a stream of results, such as predictions, batch by batch, what was kept before first."""
    def send(batch: DataFrame, batch_id: int) -> None:
        resend(batch.sparkSession, location, topic, errors, connector)
        publish_or_keep(batch, location, topic, errors, connector, batch_id)

    return (
        results.writeStream.foreachBatch(send)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 second"}))
        .start()
    )

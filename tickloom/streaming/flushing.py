"""Landing a topic in files of a useful size: messages wait until they are many or old enough."""

import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.session import delete_folder, folder_names, read_text, write_text
from tickloom.streaming.live import LiveQuery

MESSAGES = "value string, ingested_at timestamp"


class Waiting:
    """Messages that wait below a folder: a part for each micro-batch, and a file that lists the parts.

    The list of a micro-batch follows from that of the one before, so one that runs again after a
    failure does the same again.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _part(self, number: int) -> str:
        return f"{self.folder}/parts/{number}"

    def _lists(self) -> list[int]:
        return sorted(map(int, folder_names(self.spark, f"{self.folder}/lists")))

    def before(self, number: int) -> dict:
        """What waits before a micro-batch: rows of each part, and since when, in epoch ms."""
        earlier = [n for n in self._lists() if n < number]
        return json.loads(read_text(self.spark, f"{self.folder}/lists/{earlier[-1]}")) if earlier else {"parts": {}, "since": None}

    def add(self, messages: DataFrame, number: int) -> tuple[int, int | None]:
        """Store a micro-batch's messages; their number and the time they came."""
        messages.write.mode("overwrite").parquet(self._part(number))
        found = self.read([number]).agg(
            F.count(F.lit(1)).alias("rows"), F.min(F.unix_millis("ingested_at")).alias("since")).first()
        return found["rows"], found["since"]

    def read(self, parts: list[int]) -> DataFrame:
        return reduce(DataFrame.unionByName, [self.spark.read.schema(MESSAGES).parquet(self._part(p)) for p in parts])

    def commit(self, number: int, waiting: dict) -> None:
        write_text(self.spark, f"{self.folder}/lists/{number}", json.dumps(waiting))
        # Parts that neither this list nor the one before it needs are done with.
        lists = self._lists()
        kept = {int(p) for n in lists[-2:] for p in json.loads(read_text(self.spark, f"{self.folder}/lists/{n}"))["parts"]}
        for name in folder_names(self.spark, f"{self.folder}/parts"):
            if int(name) < number and int(name) not in kept:
                delete_folder(self.spark, self._part(int(name)))
        for n in lists[:-2]:
            delete_folder(self.spark, f"{self.folder}/lists/{n}")


def start_flushed(
    stream: DataFrame, write: Callable[[DataFrame, str], None], checkpoint: str, records: int, age: int,
    trigger: dict | None = None,
) -> StreamingQuery | LiveQuery:
    """Call ``write`` with a stream's messages (``value``) once ``records`` wait or the oldest is ``age`` ms old.

    ``write`` also gets a name that is the same when a write runs again. A clock lets old messages out
    when no new ones come. A bounded run has no clock and writes the rest at its end; the clock is a source,
    so a checkpoint is for runs of one kind.
    """
    spark = stream.sparkSession
    trigger = trigger or {"processingTime": "1 second"}
    bounded = bool(trigger.get("availableNow") or trigger.get("once"))
    waiting = Waiting(spark, f"{checkpoint}/waiting")
    timed = stream.select("value", F.current_timestamp().alias("ingested_at"), F.lit(True).alias("message"))
    beat = spark.readStream.format("rate").option("rowsPerSecond", 1).load().select(
        F.lit(None).cast("string").alias("value"), F.current_timestamp().alias("ingested_at"), F.lit(False).alias("message"))

    def flush(parts: dict, number: int, last: str = "") -> None:
        write(waiting.read(sorted(map(int, parts))), f"{number}{last}")

    def process(batch: DataFrame, number: int) -> None:
        now = batch.agg(F.max(F.unix_millis("ingested_at"))).first()[0]
        held = waiting.before(number)
        rows, since = waiting.add(batch.where("message").select("value", "ingested_at"), number)
        if rows:
            held["parts"][str(number)] = rows
            held["since"] = since if held["since"] is None else min(held["since"], since)
        old = held["since"] is not None and now is not None and now - held["since"] >= age
        if held["parts"] and (sum(held["parts"].values()) >= records or old):
            flush(held["parts"], number)
            held = {"parts": {}, "since": None}
        waiting.commit(number, held)

    def finish() -> None:
        lists = waiting._lists()
        held = waiting.before(lists[-1] + 1) if lists else {"parts": {}}
        if held["parts"]:
            flush(held["parts"], lists[-1], "-end")
            waiting.commit(lists[-1], {"parts": {}, "since": None})

    query = (timed if bounded else timed.unionByName(beat)).writeStream.foreachBatch(process) \
        .option("checkpointLocation", f"{checkpoint}/offsets").trigger(**trigger).start()
    return LiveQuery(query, finish) if bounded else query

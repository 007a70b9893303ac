"""Counts of late rows that outlive a query: what watermarks drop and what the live path sets aside."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tickloom.session import folder_names

COUNTS = "query string, batch long, late long"


def _folder(root: str, query: str, batch: int) -> str:
    return f"{root}/query={query}/batch={batch}"


class LateRows(StreamingQueryListener):
    """Writes the rows that a query's stateful operators drop to a table, a row for each such batch.

    A query knows of its newest hundred batches only; the table keeps all, over restarts too, since
    a query has the same id as long as it has the same checkpoint. Add it with ``spark.streams.addListener``.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def onQueryStarted(self, event) -> None:  # noqa: N802 - as Spark calls it
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = event.progress
        late = sum(operator.numRowsDroppedByWatermark for operator in progress.stateOperators)
        if late:
            # A batch that runs again replaces its row.
            self.spark.createDataFrame([(late,)], "late long").coalesce(1).write.mode("overwrite") \
                .parquet(_folder(self.root, str(progress.id), progress.batchId))

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass


def late_counts(spark: SparkSession, root: str) -> DataFrame:
    """(query, batch, late) of all batches that dropped rows."""
    if not folder_names(spark, root):
        return spark.createDataFrame([], COUNTS)
    return spark.read.schema(COUNTS).option("basePath", root).parquet(root)


def total_late(spark: SparkSession, root: str, query: StreamingQuery | None = None) -> int:
    """Late rows of a query, or of all, over all their batches."""
    counts = late_counts(spark, root)
    if query is not None:
        counts = counts.where(F.col("query") == str(query.id))
    return counts.agg(F.coalesce(F.sum("late"), F.lit(0))).first()[0]

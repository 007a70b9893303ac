"""Session defaults and the shared folder for intermediate tables."""

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    # Plain column building; the call-site capture costs a JVM round trip per expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """Session for tests and the bench; on a cluster use the session spark-submit gives."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("tickloom")
    settings = DEFAULTS | {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        # Small test tables should still use all cores.
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_announced: set[str] = set()


def shared_folder(spark: SparkSession) -> str:
    """This application's folder for intermediate tables, which every executor can reach.

    It lies below ``spark.checkpoint.dir``, or where that is unset below the context's checkpoint
    folder, or else below the warehouse, on every master alike. It goes when the application ends.
    """
    context = spark.sparkContext
    above = (
        spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
        or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    )
    folder = f"{above.rstrip('/')}/tickloom-{context.applicationId}"
    if folder not in _announced:
        path, files = _hadoop(spark, folder)
        files.mkdirs(path)
        files.deleteOnExit(path)
        _announced.add(folder)
    return folder


_scope: ContextVar[str] = ContextVar("scratch scope", default="")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}{_scope.get()}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the scratch tables made inside the block when it ends.

    For jobs that write all their results before the block ends, such as one micro-batch.
    """
    name = f"/scope-{uuid.uuid4().hex[:12]}"
    token = _scope.set(_scope.get() + name)
    try:
        yield
    finally:
        folder = shared_folder(spark) + _scope.get()
        _scope.reset(token)
        delete_folder(spark, folder)


def _hadoop(spark: SparkSession, folder: str):
    """Hadoop's path and file system of a folder."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with the scheme and host of its file system, by default Hadoop's."""
    path, files = _hadoop(spark, folder)
    return files.makeQualified(path).toString()


def delete_folder(spark: SparkSession, folder: str) -> None:
    path, files = _hadoop(spark, folder)
    files.delete(path, True)


def make_folder(spark: SparkSession, folder: str) -> None:
    path, files = _hadoop(spark, folder)
    files.mkdirs(path)


def folder_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder but drafts; none if there is no such folder."""
    path, files = _hadoop(spark, folder)
    found = [s.getPath().getName() for s in files.listStatus(path)] if files.exists(path) else []
    return [name for name in found if not name.startswith(".")]


def create_text(spark: SparkSession, file: str, text: str) -> bool:
    """Create a small file at once, with all its text or not at all; False if there is one already."""
    path, files = _hadoop(spark, file)
    draft, _ = _hadoop(spark, f"{path.getParent()}/.{path.getName()}-{uuid.uuid4().hex[:8]}")
    out = files.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    created = not files.exists(path) and files.rename(draft, path)
    if not created:
        files.delete(draft, False)
    return created


def write_text(spark: SparkSession, file: str, text: str) -> None:
    """``create_text`` in the place of whatever was there."""
    path, files = _hadoop(spark, file)
    files.delete(path, False)
    create_text(spark, file, text)


def read_text(spark: SparkSession, file: str) -> str:
    path, files = _hadoop(spark, file)
    stream = files.open(path)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def files_arrive_in_order(spark: SparkSession, folder: str, apart: int = 1000) -> None:
    """Set a table's files ``apart`` milliseconds apart in the order of their partitions.

    A file stream takes files by their modification time, which one write leaves to chance.
    """
    path, files = _hadoop(spark, folder)
    found = sorted((s for s in files.listStatus(path) if s.getPath().getName().startswith("part-")),
                   key=lambda s: s.getPath().getName())
    start = min((s.getModificationTime() for s in found), default=0)
    for i, status in enumerate(found):
        files.setTimes(status.getPath(), start + (i - len(found)) * apart, -1)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage with a table that outlives lost executors. The file sizes become the
    statistics of the returned frame, so Spark broadcasts it only when it is really small.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)

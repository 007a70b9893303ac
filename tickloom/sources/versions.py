"""Versions of a lake layer: data is written aside, audited, and shown to readers by one switch.

Every write goes to a folder of its own below the layer. A manifest names the folders that make up each
date, and readers take what the newest manifest names. A new manifest appears whole or not at all, so
a reader sees a date before a run or after it and never in between, and a run that fails before its
switch has changed nothing. The folders of the manifest before the newest stay for readers that are
still at it; older ones are deleted.
"""

import json
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tickloom.session import create_text, delete_folder, folder_names, read_text

#: The entry of a layer without dates.
ALL = ""
KEPT = 2


@dataclass
class Entry:
    """Folders of a date's rows and of the hashes of its rows, and the landed batches in it."""

    data: list[str] = field(default_factory=list)
    seen: list[str] = field(default_factory=list)
    batches: list[str] = field(default_factory=list)


@dataclass
class Manifest:
    number: int
    entries: dict[str, Entry]

    def folders(self) -> set[str]:
        return {folder for entry in self.entries.values() for folder in [*entry.data, *entry.seen]}


def _file(layer: str, number: int) -> str:
    return f"{layer}/_manifest/{number:08d}"


def _numbers(spark: SparkSession, layer: str) -> list[int]:
    return sorted(int(name) for name in folder_names(spark, f"{layer}/_manifest"))


def _read(spark: SparkSession, layer: str, number: int) -> Manifest:
    found = json.loads(read_text(spark, _file(layer, number)))
    return Manifest(number, {date: Entry(**entry) for date, entry in found.items()})


def manifest(spark: SparkSession, layer: str) -> Manifest:
    """The newest manifest of the layer at a path; number -1 and no entry before the first."""
    numbers = _numbers(spark, layer)
    return _read(spark, layer, numbers[-1]) if numbers else Manifest(-1, {})


def stage(df: DataFrame, layer: str, date: str = ALL, kind: str = "") -> str:
    """Write rows to a folder that no reader sees yet; returns its path below the layer."""
    folder = f"{kind}{f'date={date}/' if date else ''}version={uuid.uuid4().hex}"
    (df.drop("date") if date else df).write.parquet(f"{layer}/{folder}")
    return folder


def read_folders(spark: SparkSession, layer: str, folders: list[str]) -> DataFrame:
    """The rows of some folders, with their date."""
    return spark.read.option("basePath", layer).parquet(*[f"{layer}/{f}" for f in folders]).drop("version")


def switch(spark: SparkSession, layer: str, changed: dict[str, Entry]) -> None:
    """Show new entries of some dates to readers, all at once; other dates stay."""
    before = manifest(spark, layer)
    after = Manifest(before.number + 1, before.entries | changed)
    if not create_text(spark, _file(layer, after.number), json.dumps({d: asdict(e) for d, e in after.entries.items()})):
        raise RuntimeError(f"another run has switched {layer} at the same time")
    kept = after.folders() | before.folders()
    for number in _numbers(spark, layer)[:-KEPT]:
        for folder in _read(spark, layer, number).folders() - kept:
            delete_folder(spark, f"{layer}/{folder}")
        delete_folder(spark, _file(layer, number))

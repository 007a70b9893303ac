"""Event order for the live path: events wait in a log until the watermark passes them.

Each micro-batch appends its events to the log once, as a part of its own, and takes out of all parts
what lies between the old watermark and the new one. So files, partitions and topics may arrive in any
order within the allowed lateness, and what comes out is in event order over all micro-batches. Nothing
that waits is written again; a part goes when all of it has come out.

The watermark is the newest trade less the lateness. It waits for the books, but for no more than
another lateness, so that a silent book topic holds nothing up. Books may run ahead of the trades as
far as the retention; where trades stall beyond it, the watermark follows the books. Where everything
is silent, clock events with a patience let the rest out. At the end of a bounded run there is
nothing to wait for and all trades come out. Only what comes behind the watermark is late.

The bookkeeping is a few numbers for each topic and each part that still holds events, in a file of
its own for each step, as Spark keeps its offsets.
"""

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.session import delete_folder, folder_names, read_text, write_text

TRADE, BOOK, CLOCK = "trade", "book", "clock"
#: How far books may run ahead of the trades, in milliseconds.
RETENTION = 3_600_000
#: Bound before anything has come out.
NOTHING = -(1 << 62)


@dataclass
class Marks:
    """Newest event time of each kind, the watermark, and when data last came by the clock."""

    high: dict[str, int] = field(default_factory=dict)
    released: int = NOTHING
    active: int | None = None
    #: part: (newest event time in it, bound of what has come out of it)
    parts: dict[int, tuple[int, int]] = field(default_factory=dict)


class Reorder:
    """The log and its bookkeeping below the folder of a live state.

    ``lateness``, ``patience`` and ``retention`` are in milliseconds. Without a lateness everything waits
    for ``drain``.
    """

    def __init__(self, state, lateness: int | None, patience: int | None = None, retention: int = RETENTION):
        self.state, self.lateness, self.patience, self.retention = state, lateness, patience, retention
        self.spark: SparkSession = state.spark

    def _path(self, part: int) -> str:
        return f"{self.state.folder}/log/part={part}"

    def _marks(self, step: int) -> str:
        return f"{self.state.folder}/marks/{step}"

    def _read(self, step: int) -> Marks:
        if step < 0:
            return Marks()
        found = Marks(**json.loads(read_text(self.spark, self._marks(step))))
        found.parts = {int(part): tuple(bounds) for part, bounds in found.parts.items()}
        return found

    def _watermark(self, marks: Marks) -> tuple[int, int]:
        """The watermark, and the bound of what comes out: both exclusive, the same but at a silence."""
        trade, book = (marks.high.get(kind, NOTHING) for kind in (TRADE, BOOK))
        silent = self.patience is not None and marks.active is not None \
            and marks.high[CLOCK] - marks.active >= self.patience
        if silent and trade > NOTHING:
            return max(marks.released, trade), trade + 1
        if self.lateness is None:
            return marks.released, marks.released
        passed = min(trade, max(book, trade - self.lateness)) - self.lateness
        passed = max(marks.released, passed, book - self.retention)
        return passed, passed

    def _between(self, marks: Marks, bound: int, schema) -> DataFrame:
        """What lies in the parts and has not come out yet, up to the bound."""
        found = self.spark.createDataFrame([], schema)
        for part, (_, taken) in marks.parts.items():
            if taken >= bound:
                continue
            rows = self.spark.read.schema(schema).parquet(self._path(part))
            # Books of a new part that are behind may still be some symbol's last one.
            fresh = F.col("timestamp") >= taken if taken > NOTHING else F.lit(True)
            found = found.unionByName(rows.where(fresh & (F.col("timestamp") < bound)))
        return found

    def take(self, events: DataFrame, step: int) -> tuple[DataFrame, DataFrame, Marks]:
        """What comes out with this micro-batch, its late trades, and the bookkeeping to commit."""
        old = self._read(step - 1)
        self._sweep(step, old)
        path = self._path(step)
        events.where(F.col("kind") != CLOCK).write.mode("overwrite").parquet(path)
        stored = self.spark.read.schema(events.schema).parquet(path)
        found = {r["kind"]: r["high"] for r in stored.groupBy("kind").agg(F.max("timestamp").alias("high")).collect()}
        found = {k: v for k, v in found.items() if v is not None}
        clock = events.where(F.col("kind") == CLOCK).agg(F.max("timestamp")).first()[0] if self.patience is not None else None
        marks = Marks(dict(old.high), old.released, old.active, dict(old.parts))
        for kind, high in [*found.items(), *([(CLOCK, clock)] if clock is not None else [])]:
            marks.high[kind] = max(marks.high.get(kind, high), high)
        if found or marks.active is None:
            marks.active = marks.high.get(CLOCK)
        behind = _behind(old.released)
        late = stored.where((F.col("kind") == TRADE) & behind)
        marks.released, bound = self._watermark(marks)
        ready = self._between(old, bound, events.schema).unionByName(
            stored.where((F.col("timestamp") < bound) & ~((F.col("kind") == TRADE) & behind)))
        if found:
            marks.parts[step] = (max(found.values()), NOTHING)
        marks.parts = {p: (high, max(bound, taken)) for p, (high, taken) in marks.parts.items() if high >= bound}
        return ready, late, marks

    def drain(self, step: int, schema) -> tuple[DataFrame, Marks]:
        """All trades that still wait, and the books up to the newest of them."""
        old = self._read(step - 1)
        last = old.high.get(TRADE)
        if last is None:
            return self.spark.createDataFrame([], schema), old
        ready = self._between(old, last + 1, schema)
        parts = {p: (high, max(last + 1, taken)) for p, (high, taken) in old.parts.items() if high > last}
        # A later trade of the same millisecond is not late.
        return ready, Marks(old.high, max(old.released, last), old.active, parts)

    def commit(self, step: int, marks: Marks) -> None:
        write_text(self.spark, self._marks(step), json.dumps(asdict(marks)))

    def last_step(self) -> int:
        """The last committed step, -1 before the first."""
        return max(map(int, folder_names(self.spark, f"{self.state.folder}/marks")), default=-1)

    def _sweep(self, step: int, old: Marks) -> None:
        """Delete the parts that the step before the last still held and the last doesn't."""
        before = [s for s in map(int, folder_names(self.spark, f"{self.state.folder}/marks")) if s < step - 1]
        for number in before:
            for part in set(self._read(number).parts) - set(old.parts) - {step}:
                delete_folder(self.spark, self._path(part))
            delete_folder(self.spark, self._marks(number))


def _behind(released: int) -> Column:
    """True for events that come after the watermark has passed them, or have no time at all."""
    time = F.col("timestamp")
    return time.isNull() | (time < released) if released > NOTHING else time.isNull()

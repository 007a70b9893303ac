"""Row-frame windows over keys that may hold most of the rows.

A plain ``Window.partitionBy("symbol")`` gives one task a whole symbol. Here the rows are laid
out in *blocks*: a range partitioning on (group, order) that cuts a group anywhere, written once
to a table. Windows then run per (group, block), and what a block needs from the rows before it
is brought to it by small joins:

* ``with_history(n)``  - the ``n`` rows of the group that precede the block, flagged ``carried``
* ``ranked()``         - 1-based position in the group and the group's size
* ``filled(cols)``     - last non-null value at or before the row

Inside a block rows are stored last-first with their distance from the block's end in
``from_end``. A block's tail is therefore ``from_end < n``, which the parquet reader prunes by
row-group statistics, and only a block's last group can continue in the next block.
"""

from dataclasses import dataclass, field, replace
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickloom.session import materialize

BLOCK = "block"
FROM_END = "from_end"
CARRIED = "carried"


@dataclass(frozen=True)
class Ordered:
    df: DataFrame
    group: tuple[str, ...]
    stored: DataFrame = None
    _memo: dict = field(default_factory=dict, compare=False, repr=False)

    @property
    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.group, BLOCK).orderBy(F.col(FROM_END).desc())

    @property
    def blocks(self) -> DataFrame:
        """One row per (group, block): its rows and how many rows of the group come before.

        At most #blocks + #groups rows; written, so that joins know its true size.
        """
        if "blocks" not in self._memo:
            counts = self.stored.groupBy(*self.group, BLOCK).agg(
                F.count(F.lit(1)).alias("block_rows"), F.max(FROM_END).alias("first_from_end")
            )
            whole = Window.partitionBy(*self.group)
            before = whole.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
            self._memo["blocks"] = materialize(
                counts.select(
                    "*",
                    F.coalesce(F.sum("block_rows").over(before), F.lit(0)).alias("rows_before"),
                    F.sum("block_rows").over(whole).alias("group_rows"),
                ),
                "blocks",
            )
        return self._memo["blocks"]

    def join_blocks(self, small: DataFrame) -> DataFrame:
        """Left join on (group, block); null group values match themselves."""
        keys = (*self.group, BLOCK)
        renamed = small.select(
            *[F.col(k).alias(f"_k_{k}") for k in keys],
            *[c for c in small.columns if c not in keys],
        )
        on = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
        return self.df.join(renamed, on, "left").drop(*[f"_k_{k}" for k in keys])

    def ranked(self, position: str = "rn", size: str = "group_rows") -> "Ordered":
        """Add the 1-based position in the group and the group's row count."""
        rn = F.col("rows_before") + F.col("first_from_end") - F.col(FROM_END) + 1
        ranked = self.join_blocks(self.blocks).select(
            *self.df.columns, rn.alias(position), F.col("group_rows").alias(size)
        )
        return replace(self, df=ranked)

    def with_history(self, n: int) -> "Ordered":
        """Add to every block the ``n`` preceding rows of its first group (fewer at its start)."""
        # One row per block: where its tail stands in the total order of all tail rows, and the
        # group it begins with (that of the row furthest from the end).
        earlier = Window.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
        heads = (
            self.blocks.groupBy(BLOCK)
            .agg(
                F.sum("block_rows").alias("_size"),
                F.max_by(F.struct(*self.group), "first_from_end").alias("_head"),
            )
            .withColumn("_tail_rows", F.least("_size", F.lit(n)))
            .withColumn("_start", F.coalesce(F.sum("_tail_rows").over(earlier), F.lit(0)))
        )
        placed = (
            self.df.where(F.col(FROM_END) < n)
            .join(heads.select(BLOCK, "_start", "_tail_rows"), BLOCK)
            .withColumn("_place", F.col("_start") + F.col("_tail_rows") - 1 - F.col(FROM_END))
            .drop("_start", "_tail_rows", BLOCK, FROM_END)
        )
        wanted = heads.where("_start > 0").select(
            BLOCK, "_size", "_start", "_head",
            F.explode(
                F.sequence(F.greatest(F.col("_start") - n, F.lit(0)), F.col("_start") - 1)
            ).alias("_place"),
        )
        history = (
            wanted.join(placed, "_place")
            .where(F.struct(*self.group).eqNullSafe(F.col("_head")))
            .withColumn(FROM_END, F.col("_size") - 1 + F.col("_start") - F.col("_place"))
            .select(*self.df.columns)
        )
        flagged = self.df.withColumn(CARRIED, F.lit(False)).unionByName(
            history.withColumn(CARRIED, F.lit(True))
        )
        return replace(self, df=flagged)

    def filled(self, cols: list[str]) -> "Ordered":
        """Replace nulls by the last non-null value of the group, as an ordered scan would."""
        # Where each column's last value of a block stands; a long, so this is a hash aggregate.
        # Only those rows, at most one for each column, are then looked up.
        keys = (*self.group, BLOCK)
        at = materialize(self.df.groupBy(*keys).agg(*[
            F.min(F.when(F.col(c).isNotNull(), F.col(FROM_END))).alias(f"_at_{c}") for c in cols
        ]), "last-values")
        is_last = {c: F.col(FROM_END) == F.col(f"_at_{c}") for c in cols}
        found = self.join_blocks(at).where(
            reduce(or_, [F.coalesce(hit, F.lit(False)) for hit in is_last.values()])
        ).groupBy(*[F.col(k).alias(f"_f_{k}") for k in keys]).agg(*[
            F.max(F.when(is_last[c], F.col(c))).alias(c) for c in cols
        ])
        # Blocks without any value pass on what came before them.
        same = [F.col(k).eqNullSafe(F.col(f"_f_{k}")) for k in keys]
        latest = at.select(*keys).join(found, same, "left")
        earlier = (
            Window.partitionBy(*self.group).orderBy(BLOCK)
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        carry = materialize(
            latest.select(
                *self.group, BLOCK,
                *[F.last(c, ignorenulls=True).over(earlier).alias(f"_carry_{c}") for c in cols],
            ),
            "carry",
        )
        scan = self.window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        filled = {
            c: F.coalesce(F.last(c, ignorenulls=True).over(scan), F.col(f"_carry_{c}"))
            for c in cols
        }
        return replace(self, df=self.join_blocks(carry).select(*[
            filled[c].alias(c) if c in filled else F.col(c) for c in self.df.columns
        ]))

    def rows(self, *columns: str | Column) -> DataFrame:
        """The laid-out rows without history and block bookkeeping."""
        df = self.df.where(~F.col(CARRIED)) if CARRIED in self.df.columns else self.df
        return df.select(*columns) if columns else df.drop(BLOCK, FROM_END, CARRIED)


def lay_out(
    df: DataFrame,
    group: list[str] | tuple[str, ...],
    order: list[str],
    blocks: int | None = None,
) -> Ordered:
    """Cut ``df`` into ordered blocks and write them.

    Without ``blocks`` Spark starts from ``spark.sql.shuffle.partitions`` ranges and lets AQE
    merge small neighbours. The source partition is the last range key, so even a mass of rows
    equal in every ordering column is spread over several blocks.
    """
    source = "_source_partition"
    keys = [*group, *order, source]
    tagged = df.withColumn(source, F.spark_partition_id())
    ranged = (
        tagged.repartitionByRange(blocks, *keys) if blocks else tagged.repartitionByRange(*keys)
    )
    written = materialize(
        ranged.sortWithinPartitions(*[F.col(k).desc() for k in keys])
        .drop(source)
        .withColumn(BLOCK, F.spark_partition_id())
        .withColumn(FROM_END, F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)),
        "ordered",
    )
    return Ordered(written, tuple(group), written)

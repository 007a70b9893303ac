"""Sharding by a k-d tree whose cuts are weighted medians.

A node that still holds several shards is cut along the dimension in which it is widest, where the
bytes before the cut are what its left shards should get. The medians of all dimensions of all nodes of
a level are found together, by histograms that Spark sums up: the driver sees one row for each node and
dimension, and the table of points is read once for each round of refining. All dimensions come from
the text, so equal texts are the same point and share a shard; no join or grouping of copies is needed.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import materialize, offsets_in_groups

SHARDS = 16
#: Bins of a histogram; the points of the bin that holds the cut are binned again.
BINS = 4096
#: A cut is fine enough when it is off by this share of a shard.
TOLERANCE = 0.002
_TIE = 1 << 30  # the lower part of a coordinate tells apart points that are equal in the upper part


@dataclass
class Node:
    """A box of the tree, by the cuts that lead to it, and the shards that it will be cut into.

    ``ranges`` holds what lies in the box, in each dimension, or more.
    """

    path: list[tuple[str, str, int]]
    first: int
    shards: int
    weight: int
    ranges: dict[str, tuple[int, int]]


@dataclass
class Cut:
    """The search for a node's cut along a dimension: where it may lie and what lies before."""

    low: int
    high: int
    before: int = 0
    seen: tuple[int, int] | None = None  # the node's true range
    found: tuple[float, int, int] | None = None  # bytes off the goal, place, bytes before it


def _within(path: list[tuple[str, str, int]]) -> Column:
    test = F.lit(True)
    for name, side, cut in path:
        test = test & (F.col(name) < cut if side == "<" else F.col(name) >= cut)
    return test


def _labels(nodes: list[Node]) -> Column:
    """The number in ``nodes`` of the node that a point lies in."""
    label = F.lit(None).cast("int")
    for i, node in enumerate(nodes):
        label = F.when(_within(node.path), F.lit(i)).otherwise(label)
    return label


def _looked_up(table: list[list[int | float | None]], kind: str) -> Column:
    """The entry of a small table for the row's node and dimension."""
    rows = F.array(*[F.array(*[F.lit(x).cast(kind) for x in row]) for row in table])
    return F.get(F.get(rows, F.col("node")), F.col("dimension"))


def _narrowed(points: DataFrame, nodes: list[Node], names: list[str], goals: list[float], cuts: list[list[Cut]]) -> None:
    """One round for all nodes and dimensions: bin what is left and go on within the bin that holds the cut."""
    def width(cut: Cut) -> int:
        return max(1, -(-(cut.high - cut.low + 1) // BINS))

    open_ = [[cut.found is None for cut in row] for row in cuts]

    def table(value) -> list[list]:
        return [[value(i, cut) if open_[i][d] else None for d, cut in enumerate(row)] for i, row in enumerate(cuts)]

    low = _looked_up(table(lambda i, cut: cut.low), "long")
    each = points.select(_labels(nodes).alias("node"), "size", F.posexplode(F.array(*names)).alias("dimension", "value"))
    inside = each.where(F.col("value").between(low, _looked_up(table(lambda i, cut: cut.high), "long"))).withColumn(
        "bin", F.call_function("div", F.col("value") - low, _looked_up(table(lambda i, cut: width(cut)), "long")))
    bins = inside.groupBy("node", "dimension", "bin").agg(
        F.sum("size").alias("size"), F.min("value").alias("low"), F.max("value").alias("high"))
    own = Window.partitionBy("node", "dimension")
    goal = _looked_up(table(lambda i, cut: goals[i] - cut.before), "double")
    crossing = bins.withColumns({
        "upto": F.sum("size").over(own.orderBy("bin")), "least": F.min("low").over(own), "most": F.max("high").over(own),
        "goal": goal}).where("upto >= goal and upto - size < goal")
    for r in crossing.collect():
        cut, aim = cuts[r.node][r.dimension], goals[r.node]
        cut.seen = cut.seen or (r.least, r.most)
        before, after = cut.before + r.upto - r.size, cut.before + r.upto
        if r.low < r.high:
            cut.low, cut.high, cut.before = r.low, r.high, before
            continue
        # One coordinate holds the goal: the cut is before it or after it, but not at the node's edge.
        sides = [(abs(before - aim), r.low, before)] * (r.low > cut.seen[0]) + [(abs(after - aim), r.low + 1, after)] * (r.low < cut.seen[1])
        cut.found = min(sides, default=(float("inf"), r.low, before))


def _best(node: Node, root: Node, names: list[str], cuts: list[Cut], tolerance: float) -> tuple[str, Cut] | None:
    """The widest dimension whose cut is off by no more than the tolerance, or else the closest cut."""
    known = [(name, cut) for name, cut in zip(names, cuts) if cut.found is not None and cut.found[0] < float("inf")]

    def wide(item: tuple[str, Cut]) -> float:
        (least, most), (low, high) = item[1].seen, root.ranges[item[0]]
        return (most - least) / max(1, high - low)

    known.sort(key=lambda item: -wide(item))
    good = [item for item in known if item[1].found[0] <= node.weight / node.shards * tolerance]
    return good[0] if good else min(known, key=lambda item: item[1].found[0], default=None)


def kd_tree(points: DataFrame, dimensions: list[str], shards: int = SHARDS, tolerance: float = TOLERANCE) -> list[Node]:
    """The leaves, one for each shard. ``points`` is a stored table with ``size`` and the dimensions.

    A dimension in which the cut would miss its goal by more than ``tolerance`` of a shard gives way to
    the next widest one; if all do, the closest cut is taken. A node of a single point isn't cut, it
    goes to its first shard.
    """
    whole = points.agg(F.sum("size").alias("size"), *[
        f(d).alias(f"{n}_{d}") for d in dimensions for n, f in (("low", F.min), ("high", F.max))]).first()
    if whole.size is None:
        return [Node([], 0, 1, 0, {})]
    root = Node([], 0, shards, whole.size, {d: (whole[f"low_{d}"], whole[f"high_{d}"]) for d in dimensions})
    leaves, level = [], [root]
    while level:
        leaves += [n for n in level if n.shards == 1]
        nodes = [n for n in level if n.shards > 1]
        goals = [n.weight * (n.shards // 2) / n.shards for n in nodes]
        cuts = [[Cut(*n.ranges[d]) for d in dimensions] for n in nodes]
        while any(cut.found is None for row in cuts for cut in row):
            _narrowed(points, nodes, dimensions, goals, cuts)
        level = []
        for node, row in zip(nodes, cuts):
            best = _best(node, root, dimensions, row, tolerance)
            if best is None:
                leaves.append(Node(node.path, node.first, 1, node.weight, node.ranges))
                continue
            name, cut = best
            _, place, before = cut.found
            half, seen = node.shards // 2, {d: c.seen for d, c in zip(dimensions, row)}
            level.append(Node([*node.path, (name, "<", place)], node.first, half, before,
                              seen | {name: (seen[name][0], place - 1)}))
            level.append(Node([*node.path, (name, ">=", place)], node.first + half, node.shards - half, node.weight - before,
                              seen | {name: (place, seen[name][1])}))
    return leaves


def _coordinate(value: Column, tie: Column) -> Column:
    """A long in the order of ``value``, which has at most 32 bits, and then of ``tie``."""
    return F.least(value.cast("long"), F.lit((1 << 32) - 1)) * _TIE + tie


def points_of(docs: DataFrame, shards: int = SHARDS) -> tuple[DataFrame, list[str]]:
    """Stored points of all rows and the names of their dimensions.

    Dimensions: the text's bytes, code points, lines, spaces and stops, on a log scale, its CRC-32 and 32
    bits of another hash. Copies of a
    text that together exceed a shard can't share one under equal sizes: these few texts (fewer than
    there are shards) are told apart by their ids too.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    log = lambda n: F.floor(F.log2(n + 1) * (1 << 26))
    count = lambda marks: F.octet_length(text) - F.octet_length(F.translate(text, marks, ""))
    measured = materialize(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("key"),
        log(F.octet_length(text)).alias("bytes"), log(F.char_length(text)).alias("chars"),
        log(count("\n")).alias("lines"), log(count(" ")).alias("spaces"), log(count(".,;:!?")).alias("stops")), "points")
    share = measured.agg(F.sum("size")).first()[0] or 0
    large = [r.key for r in measured.groupBy("key").agg(F.sum("size").alias("size"))
             .where(F.col("size") > share / shards).select("key").collect()]
    apart = F.xxhash64("key", F.when(F.col("key").isin(large), F.struct("doc_id")) if large else F.lit(None))
    tie = F.pmod(apart, F.lit(_TIE))
    names = ["bytes", "chars", "lines", "spaces", "stops", "crc", "hash"]
    return measured.select("doc_id", "size", "text_crc32", *[
        _coordinate({"crc": F.col("text_crc32"), "hash": F.pmod("key", F.lit(1 << 32))}.get(n, F.col(n)), tie).alias(n)
        for n in names]), names


def kd_shards(docs: DataFrame, shards: int | None = SHARDS, target_bytes: int | None = None) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``shard`` and ``slot`` of every row.

    With ``target_bytes`` instead of ``shards``, the tree is cut until leaves hold about that much. Size
    is the text's UTF-8 bytes plus one; null texts count as empty. Slots number a shard's rows from 0
    in the order of a hash. Equal texts share a shard unless their copies exceed one. Null ids and
    repeated rows are rows like any other; an empty table gives no rows; extra columns are ignored.
    """
    if target_bytes is not None:
        text = F.coalesce(F.col("text").cast("string"), F.lit(""))
        total = docs.agg(F.sum(F.octet_length(text) + 1)).first()[0] or 0
        shards = max(1, round(total / target_bytes))
    points, names = points_of(docs, shards)
    leaves = kd_tree(points, names, shards)
    shard = F.lit(None).cast("int")
    for leaf in leaves:
        shard = F.when(_within(leaf.path), F.lit(leaf.first)).otherwise(shard)
    placed = points.select("doc_id", "size", "text_crc32", shard.alias("shard"))
    return offsets_in_groups(placed, ["shard"], ["doc_id", "text_crc32", "size"], "slot")

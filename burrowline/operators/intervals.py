"""Range joins and covers by a hierarchy of cells: no width to pick.

Cells of one unit are the leaves; a node of level k holds 2 ** (bits * k) of them. `nodes` and `cover` cut an interval into
nodes that tile it exactly, some tens per level.

A join moves its rows and so takes fewer: an interval is covered by two to five nodes of the one level (of powers of 4) whose
nodes are no longer than it is, and a point belongs to one node per level. Points and intervals meet in an equi-join on level
and node, so each pair meets once, whether intervals are microseconds or hours; of those that meet, some third match and the
ends tell which. Rows that are shuffled: the points times the levels that intervals use (31 at most), and the intervals times
their nodes. A node with very many points is a hot key that Spark can split; `widest` caps the nodes instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burrowline.sources import shared

BITS = 4
TOP = 60 // BITS


def _down(x: Column, shift: Column) -> Column:
    """Floor of x / 2 ** shift."""
    return F.call_function("shiftright", x, shift)


def nodes(lo: Column, hi: Column, top: int = TOP, bits: int = BITS) -> Column:
    """The nodes (level, node) that tile the cells lo, ..., hi - 1; none if hi isn't above lo, null if either is."""
    radix, none = F.lit(1 << bits).cast("long"), F.array().cast("array<bigint>")
    run = lambda a, z: F.when(a < z, F.sequence(a, F.greatest(z - 1, a))).otherwise(none)

    def of_level(k: Column) -> Column:
        first, past = -_down(-lo, k * bits), _down(hi, k * bits)
        one = F.lit(bits)
        left = F.when(k == top, past).otherwise(F.least(-_down(-first, one) * radix, past))
        right = F.greatest(_down(past, one) * radix, left)
        return F.transform(F.concat(run(first, left), run(right, past)), lambda n: F.struct(k.alias("level"), n.alias("node")))

    return F.when(lo.isNotNull() & hi.isNotNull(), F.flatten(F.transform(F.sequence(F.lit(0), F.lit(top)), of_level)))


def cover(lo: int, hi: int, top: int = TOP, bits: int = BITS) -> list[tuple[int, int, int]]:
    """The same tiling of one interval, as runs of nodes: level, first, last + 1."""
    out = []
    for k in range(top + 1):
        first, past = -(-lo >> bits * k), hi >> bits * k
        left = past if k == top else min(-(-first >> bits) << bits, past)
        right = max(past >> bits << bits, left)
        out += [(k, a, z) for a, z in ((first, left), (right, past)) if a < z]
    return out


def _cell(df: DataFrame, column: str, resolution: float) -> Column:
    if resolution == 1 and dict(df.dtypes)[column] in ("tinyint", "smallint", "int", "bigint"):
        return F.col(column).cast("long")
    return F.floor(F.col(column) / resolution).cast("long")


def level_of(length: Column, widest: int | None = None) -> Column:
    """The level, as a power of 2, of which two to five nodes cover an interval of so many cells (more where widest, the most
    cells of a node, is less)."""
    size = F.least(F.greatest(length, F.lit(1)), F.lit(1 << 60 if widest is None else max(1, widest)))
    return (F.floor(F.log2(size.cast("double")) / 2) * 2).cast("int")


def interval_join(points: DataFrame, intervals: DataFrame, on: list[str], at: str, start: str, stop: str, closed: bool = False, resolution: float = 1, widest: int | None = None) -> DataFrame:
    """Points with every interval start <= at < stop (closed: <=) of the same key.

    resolution: the size of a cell in the units of at; whole numbers need none. widest: the most cells of a node."""
    exact = resolution == 1 and all(dict(d.dtypes)[c] in ("tinyint", "smallint", "int", "bigint") for d, c in ((points, at), (intervals, start), (intervals, stop)))
    past = _cell(intervals, stop, resolution) + (0 if exact and not closed else 1)
    first, length = _cell(intervals, start, resolution), past - _cell(intervals, start, resolution)
    spans = intervals.select("*", F.when(length > 0, level_of(length, widest)).alias("_level"), first.alias("_first"), past.alias("_past")).filter("_level IS NOT NULL")
    spans = shared.written(spans, "spans")
    levels = sorted(r[0] for r in spans.select("_level").distinct().collect())  # 31 at most
    tiled = spans.withColumn("_node", F.explode(F.sequence(_down(F.col("_first"), F.col("_level")), _down(F.col("_past") - 1, F.col("_level"))))).drop("_first", "_past")
    own = F.transform(F.array(*[F.lit(k) for k in levels]).cast("array<int>"), lambda k: F.struct(k.alias("level"), _down(_cell(points, at, resolution), k).alias("node")))
    spread = points.select("*", F.inline(own).alias("_level", "_node"))
    end = F.col(at) <= F.col(stop) if closed else F.col(at) < F.col(stop)
    return spread.join(tiled, [*on, "_level", "_node"]).drop("_level", "_node").filter((F.col(at) >= F.col(start)) & end)

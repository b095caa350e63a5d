"""Signals at several resolutions: minima, maxima and sums of blocks beside the samples.

Level 0 has a row per channel and block of `base` samples, each further level one per 16 blocks of the level below. What a
window needs of its extents is read from the few blocks that tile its inside and from the samples at its two ends, at most
2 * base of them, whatever the window's length. Samples that are null or NaN count nowhere.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burrowline.functions.scalar import known
from burrowline.operators.intervals import BITS, cover

BASE = 4096
STATS = ("n", "lo", "hi", "total")


def _long(signals: DataFrame, key: list[str], index: str, v: str) -> DataFrame:
    each = signals.select(*key, F.col(index).alias("_i"), F.posexplode(F.col(v).cast("array<double>")).alias("channel", "x"))
    return each.withColumn("x", known(F.col("x"))).filter("x IS NOT NULL")


def build(signals: DataFrame, key: list[str], index: str = "sample_idx", v: str = "v", base: int = BASE, levels: int = 4) -> DataFrame:
    """key, level, node, channel, n, lo, hi, total. Sums are added up before they are shuffled."""
    x = F.col("x")
    level = _long(signals, key, index, v).groupBy(*key, F.floor(F.col("_i") / base).alias("node"), "channel").agg(F.count(x).alias("n"), F.min(x).alias("lo"), F.max(x).alias("hi"), F.sum(x).alias("total"))
    # every block goes to its node of each level, so that one grouping makes the whole pyramid
    every = level.select(*key, "channel", *STATS, F.inline(F.array(*[F.struct(F.lit(k).alias("level"), F.call_function("shiftright", F.col("node"), F.lit(BITS * k)).alias("node")) for k in range(levels)])))
    return _added(every, [*key, "level", "node", "channel"])


def _added(rows: DataFrame, key: list[str]) -> DataFrame:
    return rows.groupBy(*key).agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("total").alias("total"))


def parts(first: int, last: int, base: int = BASE, levels: int = 4) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """What a window [first, last) of samples reads: runs of nodes (level, from, to) and runs of samples (from, to)."""
    a, z = -(-first // base), last // base
    if a >= z:
        return [], [(first, last)] if first < last else []
    return cover(a, z, levels - 1), [(x, y) for x, y in ((first, a * base), (z * base, last)) if x < y]


def _any(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def edge_samples(signals: DataFrame, first: int, last: int, index: str = "sample_idx", base: int = BASE, levels: int = 4) -> DataFrame:
    """The samples that a window has to read, by bounds that reach the scan."""
    return signals.filter(_any([(F.col(index) >= x) & (F.col(index) < y) for x, y in parts(first, last, base, levels)[1]]))


def extents(pyramid: DataFrame, signals: DataFrame, key: list[str], first: int, last: int, index: str = "sample_idx", v: str = "v", base: int = BASE, levels: int = 4) -> DataFrame:
    """key, channel, n, lo, hi, total of the samples first <= i < last."""
    inside = pyramid.filter(_any([(F.col("level") == k) & (F.col("node") >= x) & (F.col("node") < y) for k, x, y in parts(first, last, base, levels)[0]]))
    x = F.col("x")
    ends = _long(edge_samples(signals, first, last, index, base, levels), key, index, v).select(*key, "channel", F.lit(1).cast("long").alias("n"), x.alias("lo"), x.alias("hi"), x.alias("total"))
    return _added(inside.select(*key, "channel", *STATS).unionByName(ends), [*key, "channel"])


def display_offset(of_window: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Twice the greatest absolute amplitude over a window's channels."""
    g = of_window.groupBy(*key) if key else of_window.groupBy()
    return g.agg((2 * F.max(F.greatest(F.abs("lo"), F.abs("hi")))).alias("stack_offset"))

"""Ordered scans of lines of any length: the last known value, running sums and neighbours, block by block.

A line is a key's rows in order. It is cut along its first order column into blocks of about `per_block` rows, by the line's
own extent and count; a window within a block and one row per block do the rest: the blocks' totals (or last, or first
values) are scanned over the line, and what a block takes from those before or after it is joined to its rows. Rows are
dealt by line and block and never by line alone, so one very long line is the work of many tasks. Lines of up to `per_block`
rows are one block.

The first order column is a number (microseconds, samples, bins) and not null; rows whose it is null come in block null, first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from burrowline.sources import shared

PER_BLOCK = 1_000_000
BLOCK = "_block"


def _joined(rows: DataFrame, small: DataFrame, key: list[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, nulls included."""
    named = small.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)], *[c for c in small.columns if c not in key])
    on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(key)]
    return rows.join(named, on, how).drop(*[f"_k{i}" for i in range(len(key))])


def blocked(rows: DataFrame, key: list[str], at: str, per_block: int = PER_BLOCK) -> DataFrame:
    """rows with the number of their block."""
    n = F.ceil(F.count("*") / per_block)
    extent = shared.written(rows.groupBy(*key).agg(F.min(at).cast("double").alias("_lo"), ((F.max(at).cast("double") - F.min(at).cast("double")) / n).alias("_width")), "extents")
    number = F.when(F.col("_width") > 0, F.floor((F.col(at).cast("double") - F.col("_lo")) / F.col("_width"))).otherwise(F.when(F.col(at).isNotNull(), 0))
    return _joined(rows, extent, key).withColumn(BLOCK, number.cast("long")).drop("_lo", "_width")


def _in_blocks(rows: DataFrame, key: list[str], order: list[str], per_block: int) -> DataFrame:
    return rows if BLOCK in rows.columns else blocked(rows, key, order[0], per_block)


def _over_blocks(rows: DataFrame, key: list[str], value: Column) -> DataFrame:
    return rows.groupBy(*key, BLOCK).agg(value.alias("_v"))


def last_known(rows: DataFrame, key: list[str], order: list[str], value: str, column: str, per_block: int = PER_BLOCK) -> DataFrame:
    """The last value that isn't null at or before each row."""
    b = _in_blocks(rows, key, order, per_block)
    before = F.last("_v", ignorenulls=True).over(Window.partitionBy(*key).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1))
    ends = _over_blocks(b, key, F.max_by(F.col(value), F.when(F.col(value).isNotNull(), F.struct(*order)))).select(*key, BLOCK, before.alias("_carry"))
    here = F.last(value, ignorenulls=True).over(Window.partitionBy(*key, BLOCK).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return _joined(b.withColumn(column, here), ends, [*key, BLOCK]).withColumn(column, F.coalesce(column, "_carry")).drop("_carry")


def running_sum(rows: DataFrame, key: list[str], order: list[str], value: str, column: str, per_block: int = PER_BLOCK) -> DataFrame:
    """The sum of a value up to and with each row; null while there is none."""
    b = _in_blocks(rows, key, order, per_block)
    before = F.sum("_v").over(Window.partitionBy(*key).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1))
    sums = _over_blocks(b, key, F.sum(value)).select(*key, BLOCK, before.alias("_carry"))
    here = F.sum(value).over(Window.partitionBy(*key, BLOCK).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    both = _joined(b.withColumn("_here", here), sums, [*key, BLOCK])
    return both.withColumn(column, F.coalesce(F.col("_here") + F.col("_carry"), "_here", "_carry")).drop("_here", "_carry")


def neighbour(rows: DataFrame, key: list[str], order: list[str], values: list[str], column: str, ahead: bool = True, per_block: int = PER_BLOCK) -> DataFrame:
    """The next row's values (or the last one's) as a struct; null at the line's end."""
    b = _in_blocks(rows, key, order, per_block)
    edge, step = (F.min_by, F.lead) if ahead else (F.max_by, F.lag)
    ends = _over_blocks(b, key, edge(F.struct(*values), F.struct(*order)))
    beyond = ends.select(*key, BLOCK, step("_v").over(Window.partitionBy(*key).orderBy(BLOCK)).alias("_carry"))
    here = step(F.struct(*values)).over(Window.partitionBy(*key, BLOCK).orderBy(*order))
    return _joined(b.withColumn(column, here), beyond, [*key, BLOCK]).withColumn(column, F.coalesce(column, "_carry")).drop("_carry")

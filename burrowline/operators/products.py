"""Every row with each of the many rows of its key, where what is asked for is a product and larger than what it comes from.

The many rows of a key are put together to lots of LOT, its rows are dealt out to deals of some DEAL, and each deal meets each
lot in an equi-join that many tasks share; rows of the product are made last, where they go. So nothing moves or is sorted for
each row of the product, and a key is many tasks' work. A task writes one deal with one lot after the other: columns of few
different values next to each other, which Parquet keeps small however many rows a key has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Few enough that what a row meets fits into a page of Parquet many times (20,000 rows), many enough that rows of a key move seldom.
LOT = 1 << 10
DEAL = 1 << 14
#: Rows of the product that a task makes, about.
TASK_PAIRS = LOT * DEAL


def _lots(many: DataFrame, on: list[str]) -> DataFrame:
    """on, a lot's number _k and its rows _many."""
    rest = [c for c in many.columns if c not in on]
    n = F.row_number().over(Window.partitionBy(*on).orderBy(*rest))  # only equal rows tie
    return many.withColumn("_k", F.floor((n - 1) / LOT)).groupBy(*on, "_k").agg(F.collect_list(F.struct(*rest)).alias("_many"))


def _up_to(n: Column, size: int) -> Column:
    """0, 1, ... for as many groups of a size as n rows need."""
    return F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / size))


def attached(rows: DataFrame, many: DataFrame, on: list[str]) -> DataFrame:
    """rows left-joined with many, which has columns beside on, all of them of kinds that can be sorted."""
    a, b = (df.groupBy(*on).agg(F.count("*").alias(n)) for df, n in ((rows, "_a"), (many, "_b")))
    sizes = a.join(b, on)
    pairs = sizes.agg(F.sum(F.col("_a") * F.col("_b"))).first()[0] or 0  # one number
    tasks = -(-pairs // TASK_PAIRS)
    if tasks <= 1:
        return rows.join(many, on, "left")
    meet = [*on, "_i", "_k"]
    deal = F.pmod(F.xxhash64(*rows.columns), F.floor((F.col("_a") - 1) / DEAL) + 1)
    dealt = rows.join(sizes, on, "left").withColumn("_i", deal).select(*on, *[c for c in rows.columns if c not in on], "_i", F.explode_outer(_up_to(F.col("_b"), LOT)).alias("_k"))
    lots = sizes.select(*on, F.explode(_up_to(F.col("_a"), DEAL)).alias("_i")).join(_lots(many, on), on)
    met = dealt.repartition(tasks, *meet).join(lots.repartition(tasks, *meet).hint("merge"), meet, "left").drop("_i", "_k")
    return met.select("*", F.inline_outer("_many")).drop("_many")

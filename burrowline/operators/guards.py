"""Cardinality guards and reason-coded rejects: bad rows get a reason and go to a reject table, nothing is raised."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_reason(checks: list[tuple[Column, str]]) -> Column:
    """Reason of the first check that holds, else null (SK3)."""
    start = F.when(F.coalesce(checks[0][0], F.lit(False)), F.lit(checks[0][1]))
    return reduce(lambda out, c: out.when(F.coalesce(c[0], F.lit(False)), F.lit(c[1])), checks[1:], start)


def split_rejects(df: DataFrame, reason: str = "reason") -> tuple[DataFrame, DataFrame]:
    """What has no reason, and the rejects (SK2)."""
    return df.filter(F.col(reason).isNull()).drop(reason), df.filter(F.col(reason).isNotNull())


def discovery_log(rejects: DataFrame, task: str = "task", reason: str = "reason") -> DataFrame:
    """Rejects counted by task and reason (SK3, A14)."""
    return rejects.groupBy(task, reason).agg(F.count("*").alias("n"))


def exactly_one(df: DataFrame, key: list[str], found: Column | None = None, reason: str = "reason", hits: Column | None = None) -> DataFrame:
    """none or multiple for keys without or with several matches, else null (C1). found: whether a row is a match (a left
    join's row without a partner isn't). hits: a key's matches as an aggregate, where they are counted already."""
    if hits is None:
        hits = F.count("*") if found is None else F.count(F.when(found, 1))
    n = hits.over(Window.partitionBy(*key))
    return df.withColumn(reason, F.when(n == 0, "none").when(n > 1, "multiple"))


def expected_count(df: DataFrame, key: list[str], expected: Column, reason: str = "reason") -> DataFrame:
    """Rows per key against the number that their kind must have."""
    counted = df.groupBy(*key).agg(F.count("*").alias("n_found"), F.max(expected).alias("n_expected"))
    return counted.withColumn(reason, F.when(F.col("n_found") < F.col("n_expected"), "too few").when(F.col("n_found") > F.col("n_expected"), "too many"))

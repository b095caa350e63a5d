"""Many tables ingested as one: a batch becomes visible in all of them at once, or not at all (SK1, SK4-SK7).

Each table is a folder with a part per batch. A batch is written part by part and then published by one append of one row
to the log of batches; readers look at published batches only. What a failed batch has left is never seen, and is replaced
when the batch comes again; a batch that is published already changes nothing when it comes again.

Sessions that come again replace what they had: of each session the rows of its last published batch count, in every table.
A session can be taken back by a batch that only names it (`removed`).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from burrowline.sources.writers import KEY, existing

LOG = "batch string, seq bigint"
SESSIONS = "subject_id string, session_id string, batch string, removed boolean"
REJECTS = "subject_id string, session_id string, reason string, batch string"
OWN = ("_log", "_sessions", "_rejects")


def _empty(spark: SparkSession, schema) -> DataFrame:
    return spark.createDataFrame([], schema)


def published(spark: SparkSession, folder: str) -> DataFrame:
    """batch and seq of what readers see."""
    found = existing(spark, f"{folder}/_log", LOG)
    return _empty(spark, LOG) if found is None else found.groupBy("batch").agg(F.min("seq").alias("seq"))


def _part(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").parquet(path)


def ingest(spark: SparkSession, folder: str, batch: str, sessions: DataFrame, tables: dict[str, DataFrame], rejects: DataFrame | None = None, removed: DataFrame | None = None) -> bool:
    """Write a batch and publish it; False if it is published already. sessions: the keys that it brings; tables: their rows,
    with those keys; rejects: keys and reasons; removed: keys of sessions to take back."""
    if not re.fullmatch(r"[A-Za-z0-9.-]+", batch) or any(t in OWN or not re.fullmatch(r"\w+", t) for t in tables):
        raise ValueError("names of batches and tables are plain words")
    log = published(spark, folder)
    if not log.filter(F.col("batch") == batch).isEmpty():
        return False
    keys = sessions.select(*KEY).distinct().withColumn("removed", F.lit(False))
    if removed is not None:
        keys = keys.unionByName(removed.select(*KEY).distinct().join(keys.select(*KEY), KEY, "left_anti").withColumn("removed", F.lit(True)))
    for name, rows in tables.items():
        _part(rows.join(sessions.select(*KEY).distinct(), KEY, "left_semi"), f"{folder}/{name}/batch={batch}")
    _part(rejects.select(*KEY, "reason").distinct() if rejects is not None else _empty(spark, "subject_id string, session_id string, reason string"), f"{folder}/_rejects/batch={batch}")
    _part(keys.select(*KEY, "removed"), f"{folder}/_sessions/batch={batch}")
    seq = (log.agg(F.max("seq")).first()[0] or 0) + 1
    spark.createDataFrame([(batch, seq)], LOG).coalesce(1).write.mode("append").parquet(f"{folder}/_log")  # one file: all or nothing
    return True


def current(spark: SparkSession, folder: str) -> DataFrame:
    """The sessions that are there, each with the batch that brought it last; of batches of one number the later name counts."""
    held = existing(spark, f"{folder}/_sessions", SESSIONS)
    if held is None:
        return _empty(spark, "subject_id string, session_id string, batch string")
    last = held.join(published(spark, folder), "batch").groupBy(*KEY).agg(F.max(F.struct("seq", "batch", "removed")).alias("m"))
    return last.filter("NOT m.removed").select(*KEY, "m.batch")


def read(spark: SparkSession, folder: str, table: str, schema: str) -> DataFrame:
    """The rows of a table that belong to the sessions' last batches; schema: the table's columns, keys included."""
    held = existing(spark, f"{folder}/{table}", f"{schema}, batch string")
    if held is None:
        return _empty(spark, schema)
    return held.join(current(spark, folder), [*KEY, "batch"], "left_semi").drop("batch")


def rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Keys and reasons of all published batches, each once."""
    held = existing(spark, f"{folder}/_rejects", REJECTS)
    if held is None:
        return _empty(spark, "subject_id string, session_id string, reason string")
    return held.join(published(spark, folder), "batch", "left_semi").select(*KEY, "reason").distinct()

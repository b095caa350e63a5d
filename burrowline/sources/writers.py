"""Sinks: one partition per session, idempotent appends, rejects beside the sessions (SK1-SK3)."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from burrowline.operators.guards import split_rejects

KEY = ["subject_id", "session_id"]
LOG = "subject_id string, session_id string"


def existing(spark, path: str, schema: str | StructType) -> DataFrame | None:
    """The rows under a path, by a given schema: keys like 007 stay text. None if nothing is there."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def session_file(subject: str = "subject_id", session: str = "session_id"):
    """The name that the reference gives a session's file (SK1)."""
    return F.concat(F.lit("sub-"), F.col(subject), F.lit("_ses-"), F.col(session), F.lit(".nwb"))


def finished(spark, path: str) -> DataFrame:
    """Keys of the sessions whose writing was completed."""
    log = existing(spark, f"{path.rstrip('/')}-finished", LOG)
    return (spark.createDataFrame([], LOG) if log is None else log).select(*KEY).distinct()


def removed(spark, path: str) -> None:
    """Delete a folder of the table's file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def write_sessions(df: DataFrame, path: str, overwrite: bool = False, sort: str | None = None) -> None:
    """Partition by session (SK1). overwrite replaces the partitions that df has; without it only sessions that aren't there
    yet are added. A session is there once the log beside the table says so: what a failed run has left half-written is
    replaced by the next one. Rows of a session come sorted by sort, so that slices prune by statistics. df is read twice, for
    its keys (which go to a pending log until the rows are there) and for its rows."""
    spark = df.sparkSession
    out = df if overwrite else df.join(finished(spark, path), KEY, "left_anti")
    keys = out.select(*KEY).distinct()
    rows = out.repartition(*KEY) if sort is None else out.repartitionByRange(*KEY, sort).sortWithinPartitions(*KEY, sort)
    log = f"{path.rstrip('/')}-pending-{uuid.uuid4().hex}"
    keys.write.parquet(log)  # named before the log of finished ones changes
    rows.write.partitionBy(*KEY).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    spark.read.schema(LOG).parquet(log).write.mode("append").parquet(f"{path.rstrip('/')}-finished")
    removed(spark, log)


def write_rejects(bad: DataFrame, path: str) -> None:
    """Append rejects that the log doesn't have yet, so that a run that comes again adds none (SK3, A14)."""
    spark = bad.sparkSession
    there = existing(spark, path, bad.schema)
    new = bad.distinct()
    if there is not None:
        held = there.distinct().select(*[F.col(c).alias(f"_r{i}") for i, c in enumerate(bad.columns)])
        new = new.join(held, [F.col(c).eqNullSafe(F.col(f"_r{i}")) for i, c in enumerate(bad.columns)], "left_anti")
    new.write.mode("append").parquet(path)


def write_with_rejects(df: DataFrame, path: str, rejects_path: str, overwrite: bool = False) -> None:
    """Sessions without a reason to the table, the others to the reject log (SK2, SK3)."""
    good, bad = split_rejects(df)
    write_sessions(good, path, overwrite)
    write_rejects(bad, rejects_path)

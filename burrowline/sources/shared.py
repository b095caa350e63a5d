"""The folder that all machines of a cluster share, for tables and sheets that are written and read again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where it is unset a temporary folder takes its place on a local master; elsewhere that is an error,
    since each machine would write to a folder of its own."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        found = "file://" + tempfile.mkdtemp(prefix="burrowline-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/burrowline-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df from a table of the shared folder, so that it isn't worked out again and its running numbers stay as they were."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows that a task sorts or groups at once, about.
TASK_ROWS = 1 << 18


def dealt(df: DataFrame, *by: str, rows: int | None = None) -> DataFrame:
    """df dealt by key to so many tasks that each has some TASK_ROWS rows; as it is where Spark's own number of tasks does. A
    fixed number would let a task's memory grow with the table. rows: how many
    df has at most; else they are counted, which costs little for a table that is read."""
    parts = -(-(df.count() if rows is None else rows) // TASK_ROWS)
    return df.repartition(parts, *by) if parts > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def as_csv(df: DataFrame, name: str, path: str | None = None, files: int | None = None, **options) -> str:
    """Write df as CSV with a header, cells as they are, and return the folder."""
    path = path or fresh_path(df.sparkSession, name)
    out = df if files is None else df.coalesce(files)
    out.write.options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).options(**options).csv(path)
    return path


def as_lines(df: DataFrame, name: str, sheet: str, order: list[str], line: str = "line", bundled: bool = False) -> str:
    """Write the lines of each sheet in order to a file of its own, and return the folder. A sheet's lines must not tie in
    order: where they did, any of them could come first.

    bundled: as a bundle, for very many sheets. Its files, one a task, hold sheets one after the other; a line has the sheet's
    name (without a tab or a line break) and a tab before it. Without an order each sheet is a single line."""
    path = fresh_path(df.sparkSession, name)
    # never null, so that the writer takes the order as it is and doesn't sort by sheet again, where a spill mixes lines
    rows = df.select(F.coalesce(F.col(sheet).cast("string"), F.lit("")).alias("sheet"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], F.col(line).alias("value"))
    if bundled and not order:
        rows.select(F.concat_ws("\t", "sheet", "value")).write.text(path)
        return path
    sorted_ = rows.repartition("sheet").sortWithinPartitions("sheet", *[f"_o{i}" for i in range(len(order))])
    if bundled:
        sorted_.select(F.concat_ws("\t", "sheet", "value")).write.text(path)
    else:
        sorted_.select("sheet", "value").write.partitionBy("sheet").text(path)
    return path


def renamed(spark: SparkSession, folder: str, target: str, name: str) -> None:
    """Move the part files of a written folder to target under name-0, name-1, ... (their suffix stays)."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path(target))
    parts = sorted(s.getPath().getName() for s in fs.listStatus(path(folder)) if s.getPath().getName().startswith("part-"))
    for i, p in enumerate(parts):
        fs.rename(path(f"{folder}/{p}"), path(f"{target}/{name}-{i}.{p.rsplit('.', 1)[-1]}"))

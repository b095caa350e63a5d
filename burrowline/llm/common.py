"""Helpers shared by the corpus operators: shared folders, staged tables, shipping this package to executors."""

from __future__ import annotations

import gc
import os
import sys
import tempfile
import time
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from burrowline.sources.shared import fresh_path, shared_dir

__all__ = ["discard", "documents", "forgotten", "fresh_path", "ready", "shared_dir", "staged", "text_of"]

def staged(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: lineage ends there, and a lost executor costs no rework."""
    path = fresh_path(df.sparkSession, name)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found.staged_path = path
    return found


_freed = 0.0


def discard(*tables: DataFrame | None) -> None:
    """Remove the folders of staged tables that nothing reads any more, and let Spark drop the shuffles behind them."""
    paths = [t.staged_path for t in tables if t is not None and hasattr(t, "staged_path")]
    if not paths:
        return
    spark = next(t for t in tables if t is not None).sparkSession
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    global _freed
    if time.monotonic() - _freed > 30:  # shuffle files go with the plans that wrote them
        _freed = time.monotonic()
        gc.collect()
        spark._jvm.System.gc()


def ready(spark: SparkSession) -> None:
    """Send this package to the executors once per application."""
    sc = spark.sparkContext
    if getattr(sc, "_burrowline_sent", False):
        return
    root = Path(__file__).resolve().parents[2]
    target = Path(tempfile.mkdtemp(prefix="burrowline-zip-")) / "burrowline_pkg.zip"
    with zipfile.ZipFile(target, "w") as out:
        for p in sorted((root / "burrowline").rglob("*.py")):
            out.write(p, os.fspath(p.relative_to(root)))
    sc.addPyFile(os.fspath(target))
    sc._burrowline_sent = True


def forgotten() -> None:
    """Let go of the tokenizers, and of what they have kept, that earlier stages opened in this Python worker."""
    for name in ("word_ids", "sentencepiece_bpe"):
        if (module := sys.modules.get(f"burrowline.llm.{name}")) is not None:
            module._OPEN.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(column: str = "text") -> Column:
    """The whole text, null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))

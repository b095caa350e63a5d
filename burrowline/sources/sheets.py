"""Sheets as text files: lines with their place in their file, cells of any number, each file with a header of its own.

Files are read in splits. What was read is written to the shared folder with a running number per task; from it a row per
split says how many lines it has and where its numbers begin, and a sum over the splits before it gives each line its place.
So a file of any size is numbered by many tasks, and nothing is sorted. What a caller needs of a file's header is worked
out once per split and handed to the split's lines with their numbers: broadcast where there are SPLITS of them at most
(some 64 TB of sheets in large files; some 150 MB of a header's places), else joined by split.

Very many small sheets come as a bundle (shared.as_lines): a file for each would cost more than its lines. path is then the
sheet's name, and a split of a bundle's file is one of each sheet that has lines in it.

Blank lines aren't rows. A cell in double quotes may hold separators, and quotes written twice; it may not hold line breaks.
An empty cell is null.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from burrowline.sources import shared

SPLITS = 500_000


def cells(line: Column, sep: str = ",") -> Column:
    """The cells of a line."""
    one = rf'[{sep}]("(?:[^"]|"")*+"(?=[{sep}]|$)|[^{sep}]*+)'
    raw = F.regexp_extract_all(F.concat(F.lit(sep), line), F.lit(one), F.lit(1))
    plain = lambda c: F.when(c.startswith('"') & c.endswith('"') & (F.length(c) > 1), F.replace(F.substr(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))).otherwise(c)
    quoted = F.transform(raw, lambda c: F.nullif(plain(c), F.lit("")))
    simple = F.transform(F.split(line, sep if sep not in r".$|()[{^?*+\\" else f"\\{sep}"), lambda c: F.nullif(c, F.lit("")))
    return F.when(F.instr(line, '"') > 0, quoted).otherwise(simple)  # what has no quotes is cut at its separators


def place(header: Column, name: str) -> Column:
    """Where a header has a name first, from 0; null if nowhere."""
    return F.nullif(F.array_position(header, name), F.lit(0)).cast("int") - 1


def place_where(header: Column, test: Callable[[Column], Column]) -> Column:
    """Where a header's cell first passes a test, from 0; null if nowhere."""
    return F.nullif(F.array_position(F.transform(header, lambda h: F.coalesce(test(h), F.lit(False))), True), F.lit(0)).cast("int") - 1


def named_lines(spark: SparkSession, path: str, bundled: bool = False, **options) -> DataFrame:
    """path, block, value of every line. In a bundle no sheet has lines in several files, so a split's place in its file is
    in order for each sheet."""
    start = F.col("_metadata.file_block_start").alias("block")
    read = spark.read.options(**options).text(path)
    if not bundled:
        return read.select(F.col("_metadata.file_path").alias("path"), start, "value")
    tab = F.instr("value", "\t")
    return read.select(F.substr("value", F.lit(1), tab - 1).alias("path"), start, F.substr("value", tab + 1).alias("value"))


def lines(spark: SparkSession, path: str, bundled: bool = False, **options) -> DataFrame:
    """path, block, id, value: the lines that aren't blank, written once so that their numbers stay."""
    read = named_lines(spark, path, bundled, **options).filter(F.col("value").rlike(r"\S"))
    return shared.written(read.withColumn("id", F.monotonically_increasing_id()), "lines")


def rows(spark: SparkSession, path: str, sep: str = ",", options: dict | None = None, bundled: bool = False, **facts: Callable[[Column], Column]) -> DataFrame:
    """path, row_no (0 is the header's line) and c (the cells) of every line, with the named facts of its file's header; a
    fact is a function of the header's trimmed cells."""
    read = lines(spark, path, bundled, **(options or {}))
    splits = read.groupBy("path", "block").agg(F.min("id").alias("lo"), F.count("*").alias("n"))
    w = Window.partitionBy("path").orderBy("block")
    before = F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counted = shared.written(splits.select("path", "block", "lo", before.alias("before")), "splits")
    near = F.broadcast if counted.count() <= SPLITS else lambda df: df
    heads = read.join(near(counted.filter("before = 0").select("path", "block", F.col("lo").alias("id"))), ["path", "block", "id"])
    header = F.transform(cells(F.regexp_replace("value", "^﻿", ""), sep), lambda h: F.trim(h))
    known = heads.select("path", header.alias("_h")).select("path", *[f(F.col("_h")).alias(name) for name, f in facts.items()])
    of_split = shared.written(counted.join(known, "path"), "heads")
    placed = read.join(near(of_split), ["path", "block"])
    text = F.when(F.col("before") + F.col("id") == F.col("lo"), F.regexp_replace("value", "^﻿", "")).otherwise(F.col("value"))
    return placed.select("path", (F.col("before") + F.col("id") - F.col("lo")).alias("row_no"), cells(text, sep).alias("c"), *facts)


def rejects(spark: SparkSession, path: str, sheet: DataFrame, missing: Column, reason: str, bundled: bool = False) -> DataFrame:
    """path and reason of files with blank lines only, and of those whose header's facts say so. A file of no bytes at all is
    one that Spark's sources don't list."""
    if bundled:
        listed = named_lines(spark, path, bundled).select("path").distinct()
    else:
        listed = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("path"))
    heads = sheet.filter("row_no = 0").select("path", F.when(missing, reason).alias("reason"), F.lit(True).alias("_read"))
    judged = listed.join(heads, "path", "left").withColumn("reason", F.when(F.col("_read").isNull(), "empty sheet").otherwise(F.col("reason")))
    return judged.filter(F.col("reason").isNotNull()).select("path", "reason")


def filled(sheet: DataFrame) -> DataFrame:
    """path and kept: the places that have a value in a line after the header's. Values are marked as bits, 62 places to a
    number, so what is grouped is a few numbers of each line."""
    some = sheet.filter("row_no > 0").select("path", F.posexplode(F.transform(F.sequence(F.lit(0), F.floor((F.size("c") - 1) / 62).cast("int")), lambda b: F.aggregate(
        F.sequence(F.lit(0), F.lit(61)), F.lit(0).cast("long"), lambda bits, i: F.when(F.get(F.col("c"), (b * 62 + i).cast("int")).isNotNull(), bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), i))).otherwise(bits)))).alias("word", "bits"))
    words = some.groupBy("path", "word").agg(F.bit_or("bits").alias("bits"))
    bit = lambda i: F.col("bits").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), i)) != 0
    places = words.select("path", F.explode(F.transform(F.filter(F.sequence(F.lit(0), F.lit(61)), bit), lambda i: i + F.col("word") * 62)).alias("at"))
    return places.groupBy("path").agg(F.array_sort(F.collect_list("at")).alias("kept"))

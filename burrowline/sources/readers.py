"""Readers with explicit schemas (SC1-SC15). Sheets arrive as CSV; every cell is text until a try_cast."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from burrowline.functions.scalar import file_name, first_time, number, suffix, whole
from burrowline.operators import meta, trials
from burrowline.operators.guards import exactly_one
from burrowline.sources import schemas, sheets, templates


def text_csv(spark: SparkSession, path: str, **options) -> DataFrame:
    return spark.read.options(header=True, inferSchema=False, ignoreLeadingWhiteSpace=False).options(**options).csv(path)


def registry(spark: SparkSession, path: str) -> DataFrame:
    """SC1."""
    return meta.clean_registry(text_csv(spark, path))


def session_list(spark: SparkSession, path: str, task: str | None = None) -> DataFrame:
    """SC2."""
    return meta.task_sessions(text_csv(spark, path), task)


def pooled_cages(spark: SparkSession, folder: str, pattern: str = "*POOLED*") -> DataFrame:
    """SC3: all files that match (or files of folders that do), each with its own header, in one scan."""
    place = {name: (lambda h, name=name: meta.cage_place(h, name)) for name in meta.CAGE_COLUMNS}
    return meta.pooled_cages(sheets.rows(spark, f"{folder.rstrip('/')}/{pattern}", **place))


def files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Listing of raw files, recursive; their bytes are never read (SC4)."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder)
    name = file_name(F.col("path"))
    return f.select("path", F.regexp_extract("path", "([^/]*)/[^/]*$", 1).alias("dir"), name.alias("name"), suffix(F.col("path")).alias("ext"), "length", "modificationTime")


#: Fixed value: where a recording lies (SC5).
RECORDING = "{subject_id}/{session_id}/{subject_id}_{session_date:date}_{session_time:time}_{task}"


def ephys_paths(listing: DataFrame) -> DataFrame:
    """subject/session/subject_date_time_task to columns; the file's subject must be the folder's (SC5, X2). What doesn't fit
    is what templates.expand gives beside them."""
    rows, _ = templates.expand(listing, RECORDING)
    day, clock = F.date_format("session_date", "yyyy-MM-dd"), F.replace("session_time", F.lit(":"), F.lit("-"))
    found = rows.select("subject_id", "session_id", day.alias("session_date"), clock.alias("session_time"), "task").distinct()
    start = first_time(F.concat_ws(" ", "session_date", "session_time"), ("yyyy-MM-dd HH-mm-ss",))
    return found.withColumn("start_ts", F.to_utc_timestamp(start, "Europe/London"))


def _projects(spark: SparkSession, path: str, bundled: bool = False) -> DataFrame:
    schema = f"{schemas.PROJECT}, _corrupt_record string"
    if bundled:
        read = sheets.named_lines(spark, path, bundled).select("path", F.from_json("value", schema, {"columnNameOfCorruptRecord": "_corrupt_record"}).alias("p")).select("path", "p.*")
    else:
        read = spark.read.schema(schema).option("multiLine", True).json(path).withColumn("path", F.col("_metadata.file_path"))
    reason = F.when(F.col("_corrupt_record").isNotNull(), "unreadable project").when(F.col("observations").isNull(), "no observations")
    return read.select("observations", "behaviors_conf", "path", reason.alias("reason"))


def scoring_projects(spark: SparkSession, path: str, bundled: bool = False) -> DataFrame:
    """SC6: the projects that can be read; project_rejects has the others. bundled: very many projects as lines of a bundle
    (shared.as_lines), path being a project's name."""
    return _projects(spark, path, bundled).filter("reason IS NULL").drop("reason")


def project_rejects(spark: SparkSession, path: str, bundled: bool = False) -> DataFrame:
    """path and reason of projects that are cut off, aren't JSON or have no observations (SK2)."""
    return _projects(spark, path, bundled).filter("reason IS NOT NULL").select("path", "reason")


def freeze_scores(spark: SparkSession, path: str) -> DataFrame:
    """SC7: path, row_no (from the line after the header), c and animal_at of freeze-score sheets. Places that are empty
    throughout a file are left out of its rows; animal_at is where the animals' column then stands."""
    read = sheets.rows(spark, path, animal=lambda h: sheets.place(h, "% freeze"))
    kept = read.join(sheets.filled(read), "path")
    body = kept.filter("row_no > 0").select("path", (F.col("row_no") - 1).alias("row_no"), F.transform("kept", lambda i: F.get("c", i)).alias("c"), (F.nullif(F.array_position("kept", F.col("animal")), F.lit(0)).cast("int") - 1).alias("animal_at"))
    return body.filter("animal_at IS NOT NULL")


def freeze_rejects(spark: SparkSession, path: str) -> DataFrame:
    """SC7, SK2: sheets that freeze_scores can't use, with their reason."""
    read = sheets.rows(spark, path, animal=lambda h: sheets.place(h, "% freeze"))
    return sheets.rejects(spark, path, read, F.col("animal").isNull(), "no column % freeze")


def freeze_log(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """Last two cells of each line are date and time, in either of two formats (SC8, X4)."""
    line = spark.read.text(path).select(F.split("value", sep).alias("cells"))
    at = F.concat_ws(" ", F.trim(F.try_element_at("cells", F.lit(-2))), F.trim(F.try_element_at("cells", F.lit(-1))))
    return line.select("cells", F.element_at("cells", 1).alias("animal"), first_time(at, ("d/M/yyyy H:mm", "yyyy-MM-dd HH:mm:ss", "d/M/yyyy H:mm:ss")).alias("ts"))


def swim_sheet(spark: SparkSession, path: str, bundled: bool = False) -> tuple[DataFrame, DataFrame]:
    """SC9: path, row_no, c and at (where each column and block of the row's own file stands, see trials.swim_places), and
    the sheets that can't be used: empty ones and those without an Animal column."""
    read = sheets.rows(spark, path, bundled=bundled, at=trials.swim_places)
    return read.filter("row_no > 0 AND at.animal IS NOT NULL"), sheets.rejects(spark, path, read, F.col("at.animal").isNull(), "no column Animal", bundled)


def channel_sheet(spark: SparkSession, path: str, channels: int = 16) -> DataFrame:
    """SC10: path, row_no (the row's place, W13), subject_id, Genotype and the channels' columns 0, 1, ..., by each file's own
    header; a column that a file lacks is null."""
    names = ["Folder", "Genotype", *[str(i) for i in range(channels)]]
    read = sheets.rows(spark, path, at=lambda h: F.array(*[sheets.place(h, n) for n in names])).filter("row_no > 0")
    column = [F.get("c", F.get("at", F.lit(i))).alias("subject_id" if n == "Folder" else n) for i, n in enumerate(names)]
    return read.select("path", (F.col("row_no") - 1).cast("int").alias("row_no"), *column)


def cs_frames(spark: SparkSession, path: str) -> DataFrame:
    """SC11."""
    return text_csv(spark, path).select(F.col("rat_ID").alias("subject_id"), whole(F.col("first_CS_frame_index")).alias("first_cs_frame"))


def ttl_events(spark: SparkSession, path: str) -> DataFrame:
    """SC12."""
    return spark.read.schema(schemas.TTL_EVENTS).parquet(path)


def signals(spark: SparkSession, path: str, metadata: DataFrame) -> DataFrame:
    """Samples with their series' rate and start; metadata has a row per series (SC13)."""
    s = spark.read.schema(schemas.SIGNALS).parquet(path)
    return s.join(metadata.select("subject_id", "session_id", "series", "rate", "t0"), ["subject_id", "session_id", "series"], "left")


def dimension(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Small table of session types, devices or electrode groups, as JSON (SC14)."""
    return spark.read.schema(schema).json(path)


def by_key(table: DataFrame, subject: str, session_prefix: str) -> DataFrame:
    """One subject's session by prefix, with a reason unless it is exactly one (SC15, C1). Partition filters prune the scan."""
    rows = table.filter((F.col("subject_id") == subject) & F.col("session_id").startswith(session_prefix))
    keys = exactly_one(rows.select("subject_id", "session_id").distinct(), ["subject_id"])
    return rows.join(keys, ["subject_id", "session_id"])


def numeric(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: number(F.col(c)) for c in columns})

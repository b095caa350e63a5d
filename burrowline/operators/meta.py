"""Subjects, devices and layered metadata (J1, J9, J10, J21, J22, F8-F12, SC1-SC3's shaping)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burrowline.functions.scalar import genotype, plain_session, sex_code, subject_name, task_list, whole


def clean_registry(sheet: DataFrame) -> DataFrame:
    """Rows that aren't empty; task list split and trimmed; whole numbers for animal and cohort (SC1)."""
    out = sheet.filter(F.coalesce(*[F.col(f"`{c}`").cast("string") for c in sheet.columns]).isNotNull())
    for old, new in (("animal ID", "animal_id"), ("cohort no.", "cohort_no")):
        if old in out.columns:
            out = out.withColumn(new, whole(F.col(f"`{old}`"))).drop(old)
    if "tasks conducted" in out.columns:
        out = out.withColumn("tasks", task_list(F.col("tasks conducted"))).drop("tasks conducted")
    return out


def task_sessions(sheet: DataFrame, task: str | None = None, fixed: int = 3) -> DataFrame:
    """Wide session list to (task, ord, session): columns after the first three, but for Notes (SC2). An unknown task gives
    no rows; see unknown_task."""
    cols = [c for c in sheet.columns if c != "Notes"]
    rows = sheet if task is None else sheet.filter(F.col(cols[0]) == task)
    long = rows.unpivot([cols[0]], cols[fixed:], "_c", "session").filter(F.col("session").isNotNull())
    place = F.create_map(*[x for k, c in enumerate(cols[fixed:]) for x in (F.lit(c), F.lit(k))])
    return long.select(F.col(cols[0]).alias("task"), place[F.col("_c")].alias("ord"), plain_session(F.col("session")).alias("session"))


def unknown_task(sheet: DataFrame, asked: DataFrame) -> DataFrame:
    """Tasks without a row in the sheet, as rejects (SC2)."""
    known = sheet.select(F.col(sheet.columns[0]).alias("task"))
    return asked.join(known, "task", "left_anti").withColumn("reason", F.lit("unknown task"))


#: The key columns of a cage sheet, and the other name that the first one can have.
CAGE_COLUMNS = {"animal": "animal ID", "cohort": "cohort ID", "cage": "cage ID"}
CAGE_ALIAS = "Unique animal ID"


def cage_place(header: Column, name: str) -> Column:
    """Where a sheet has one of its key columns, from 0."""
    at = lambda h: F.nullif(F.array_position(header, h), F.lit(0)) - 1
    found = at(CAGE_COLUMNS[name])
    return (F.coalesce(found, at(CAGE_ALIAS)) if name == "animal" else found).cast("int")


def pooled_cages(sheet: DataFrame) -> DataFrame:
    """Cage ids of several sheets (path, row_no, c, and the places animal, cohort, cage in each row's own sheet): rows that
    don't parse are skipped, the last file and row win (SC3, U1, W8). A sheet without the three key columns adds nothing."""
    cell = lambda name: F.get("c", F.col(name))
    read = sheet.filter("row_no > 0").select(whole(cell("animal")).alias("animal_id"), F.trim(cell("cohort")).alias("cohort_id"), whole(cell("cage")).alias("cage_id"), "path", "row_no")
    good = read.filter("animal_id IS NOT NULL AND cohort_id IS NOT NULL AND cage_id IS NOT NULL")
    last = good.groupBy("animal_id", "cohort_id").agg(F.max(F.struct("path", "row_no", "cage_id")).alias("m"))
    return last.select("animal_id", "cohort_id", "m.cage_id")


def with_cage(subjects: DataFrame, cages: DataFrame, key: list[str], cage: str = "cage_id") -> DataFrame:
    """The registry's cage, else the pooled one (J1, Q23). Keys are compared as text (Q19)."""
    c = cages.select(*[F.col(k).cast("string").alias(f"_k{i}") for i, k in enumerate(key)], F.col(cage).alias("_cage"))
    on = [F.col(k).cast("string") == F.col(f"_k{i}") for i, k in enumerate(key)]
    joined = subjects.join(c, on, "left")
    own = F.col(cage) if cage in subjects.columns else F.lit(None)
    return joined.withColumn(cage, F.coalesce(own, "_cage")).drop("_cage", *[f"_k{i}" for i in range(len(key))])


def described_subjects(subjects: DataFrame, sep: str = "-") -> DataFrame:
    """Composed id, sex code, upper genotype, housing text."""
    return subjects.withColumns({
        "subject_id": subject_name(F.col("animal_id"), F.col("cohort_id"), sep),
        "sex": sex_code(F.col("sex")),
        "genotype": F.upper("genotype"),
        "description": F.concat_ws(". ", F.concat(F.lit("Housing: "), F.col("housing")), F.concat(F.lit("Cage ID: "), F.col("cage_id").cast("string"))),
    })


def task_people(subjects: DataFrame, tasks: list[str], key: list[str]) -> DataFrame:
    """'<task> exp' and '<task> sco' columns to a row per task, with the list of people."""
    present = set(subjects.columns)
    column = lambda name: F.col(f"`{name}`") if name in present else F.lit(None).cast("string")
    rows = F.array(*[F.struct(F.lit(t).alias("task"), column(f"{t} exp").alias("exp"), column(f"{t} sco").alias("sco")) for t in tasks])
    long = subjects.select(*key, F.inline(rows))
    return long.withColumn("experimenters", F.array_distinct(F.array_compact(F.array("exp", "sco"))))


def with_session_type(sessions: DataFrame, types: DataFrame, key: str = "session_key") -> DataFrame:
    """Task metadata by session key; an unknown key gets a reason."""
    out = sessions.join(types.withColumn("_known", F.lit(True)), key, "left")
    return out.withColumn("reason", F.when(F.col("_known").isNull(), "unknown session type")).drop("_known")


def with_genotype(sessions: DataFrame, sheet: DataFrame) -> DataFrame:
    """Genotype from the channel sheet; absent subjects and unknown values get a reason."""
    out = sessions.join(sheet.select("subject_id", F.col("Genotype").alias("_g"), F.lit(True).alias("_in")), "subject_id", "left")
    reason = F.when(F.col("_in").isNull(), "subject_not_in_sheet").when(genotype(F.col("_g")).isNull(), "unknown genotype")
    return out.withColumn("genotype", genotype(F.col("_g"))).withColumn("reason", reason).drop("_g", "_in")


def devices_of(sessions: DataFrame, devices: DataFrame, rules: DataFrame) -> DataFrame:
    """Devices of a session by task, but for those that a rule (task, device, session_pattern) keeps to other sessions
    (F8; the stated intent, Q8). A device without a rule is always there."""
    pairs = sessions.join(devices, "task")
    ruled = pairs.join(rules.withColumnRenamed("device", "name"), ["task", "name"], "left")
    return ruled.filter(F.col("session_pattern").isNull() | F.rlike("session", F.col("session_pattern"))).drop("session_pattern")


def layered(*layers: Column) -> Column:
    """The first layer that has a value wins: path, file, default."""
    return F.coalesce(*layers)


def merged_maps(low: Column, high: Column) -> Column:
    """Maps merged by key, the second one's values winning."""
    return F.map_zip_with(F.coalesce(low, F.create_map().cast("map<string,string>")), F.coalesce(high, F.create_map().cast("map<string,string>")), lambda k, a, b: F.coalesce(b, a))


def with_defaults(rows: DataFrame, default: DataFrame, columns: list[str]) -> DataFrame:
    """A one-row default fills what the rows leave open."""
    d = default.limit(1).select(*[F.col(c).alias(f"_d_{c}") for c in columns])
    out = rows.join(F.broadcast(d))
    return out.withColumns({c: F.coalesce(F.col(c), F.col(f"_d_{c}")) for c in columns}).drop(*[f"_d_{c}" for c in columns])


def probe_ids(sheet: DataFrame, row: str = "row_no") -> DataFrame:
    """Probe id: the subject's explicit place in the sheet."""
    return sheet.withColumn("probe_id", F.col(row))

"""The conversion flows over whole cohorts: from registries and listings to sessions and rejects, from a recording's raw tables
to electrodes, series and clocks, from scoring projects to enriched events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burrowline.functions import scalar
from burrowline.operators import align, discover, events, guards, meta, signals

KEY = ["task", "animal_id", "cohort_id", "session"]


def behavioural_sessions(subjects: DataFrame, sessions: DataFrame, files: DataFrame, task: str, expected: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Sessions of a task with their videos, and rejects with a reason (J2-J4, C2, SK2, SK3, W12, X1, A3).

    subjects: animal_id, cohort_id, line, cage_id, tasks. sessions: task, ord, session. files: dir (line/cohort_task/session)
    and name. expected: the number of videos that a session must have, over the session's columns; null: any."""
    who = discover.did_task(subjects, task).withColumn("task", F.lit(task)).select("task", "animal_id", "cohort_id", "line", "cage_id")
    wanted = discover.session_matrix(who, sessions.filter(F.col("task") == task).select("task", "session"), ["task"])
    wanted = wanted.withColumn("dir", discover.folder_of(F.col("line"), F.col("cohort_id"), F.col("task"), F.col("session")))
    media = discover.without_stimulus(files).filter(scalar.media_class(F.col("name")) != "unsupported").select("dir", "name")
    animal, cage = F.col("animal_id").cast("string"), F.concat(F.lit("cage"), F.col("cage_id").cast("string"))
    hits = discover.match_names(wanted, media, ["dir"], KEY, [animal, cage])
    found = hits.withColumn("start_ts", scalar.name_time(F.col("name"))).groupBy(*KEY).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(scalar.natural_key(F.col("name")).alias("k"), F.col("name").alias("n")))), lambda x: x["n"]).alias("videos"),
        F.min("start_ts").alias("start_ts"),
        F.count_if(F.col("start_ts").isNull()).alias("undated"),
    )
    folders = files.select("dir").distinct().withColumn("_folder", F.lit(True))
    rows = wanted.join(folders, "dir", "left").join(found, KEY, "left")
    checks = [(F.col("_folder").isNull(), "folder missing"), (F.col("videos").isNull(), "no_video"), (F.col("undated") > 0, "no date in a file name")]
    if expected is not None:
        n = F.size("videos")
        checks += [(n < expected, "too few videos"), (n > expected, "too many videos")]
    judged = rows.withColumn("reason", guards.first_reason(checks))
    good, bad = guards.split_rejects(judged.drop("_folder", "undated"))
    named = good.withColumns({"subject_id": scalar.subject_name(F.col("animal_id"), F.col("cohort_id")), "session_id": scalar.session_name(F.col("task"), F.col("session")), "session_kind": scalar.session_kind(F.col("session"))})
    return named, bad.select(*KEY, "reason")


def recording_tables(sheet: DataFrame, groups: DataFrame, sessions: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Electrodes with group and class, sessions with genotype, and rejects."""
    e = signals.electrodes(signals.channel_map(sheet, ["subject_id"]), groups)
    e = e.withColumn("kind", signals.channel_class(F.col("location_code"), F.col("bad_channel")))
    good, bad = guards.split_rejects(meta.with_genotype(sessions, sheet))
    return e.join(good.select("subject_id").distinct(), "subject_id", "left_semi"), good, bad


def aligned_recordings(ttl: DataFrame, cs_frames: DataFrame, frames: DataFrame, videos: DataFrame | None = None, rate: float = 2000.0) -> DataFrame:
    """Clock offset per session (A2, J12, X12); sessions without a pulse or a shown frame are unaligned (Q1)."""
    key = ["subject_id", "session_id"]
    return align.clock_offset(align.first_onset(ttl, key, 2, rate), cs_frames, frames, key, videos)


def enriched_events(projects: DataFrame, sheet: DataFrame, sheet_key: list[str], derived: dict[str, Column] | None = None) -> DataFrame:
    """Events of scoring projects with what is known of each object (R7, W2, R5, J13). sheet_key: columns by which a row of
    the sheet belongs to a session; those that the projects don't have are made of the observation's id (derived)."""
    own = [c for c in projects.columns if c not in ("observations", "behaviors_conf")]
    key = [*own, "observation_id"]
    long = events.annotated_events(events.marks(projects).filter(F.col("t_s").isNotNull()), events.behaviours(projects), key)
    made = {"test": scalar.session_kind(F.col("observation_id"))} | (derived or {})
    named = long.withColumns({c: made[c] for c in sheet_key if c not in own})
    o = F.lower("observation_id")
    typed = named.withColumn("trial_type", F.when(o.contains("sample"), "sample").when(o.contains("test"), "test"))
    info = events.object_info(sheet, sheet_key)
    return events.enrich(typed, info, [*sheet_key, "trial_type", "label"], ["position", "novelty", "object"], ["ord"])

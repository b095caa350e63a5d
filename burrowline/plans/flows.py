"""Whole conversions, from a cohort's tables to the sink: sessions by subject and session, and rejects with their reasons."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from burrowline.functions import scalar
from burrowline.operators import align, catalog, discover, events, guards, meta, trials
from burrowline.plans import conversion
from burrowline.sources import batches, shared, writers

KEY = writers.KEY


def object_sessions(sessions: DataFrame, projects: DataFrame, sheet: DataFrame, path: str, rejects: str) -> None:
    """Sample and test of object tasks (J5, W2, J13, U3). sessions: as behavioural_sessions gives them, with cohort_id; projects
    and sheet carry cohort_id too, the sheet also test. A session without an observation of its animal and kind is rejected.
    An observation is an animal's if its id contains the animal's (Q12); ambiguous_match says whether it also contains that
    of another animal of the cohort. Ids are matched before any event is looked at."""
    block = ["cohort_id", "test"]
    enriched = conversion.enriched_events(projects, sheet, block)
    wanted = sessions.select(*KEY, "cohort_id", "animal_id", F.col("session_kind").alias("test"))
    observed = enriched.select(*block, "observation_id").distinct()
    own = discover.match_observation(wanted, observed, block, KEY, F.col("animal_id"), first=False)
    judged = discover.ambiguous(own, wanted, block, "animal_id", "animal_id", "observation_id")
    found = judged.join(enriched, [*block, "observation_id"]).select(*KEY, "observation_id", "ambiguous_match", "trial_type", "label", "ord", "start_s", "duration_s", "position", "novelty", "object")
    none = wanted.join(found.select(*KEY).distinct(), KEY, "left_anti").select(*KEY, F.lit("no observation").alias("reason"))
    writers.write_sessions(found, path)
    writers.write_rejects(none, rejects)


def swim_sessions(swims: DataFrame, videos: DataFrame, task: str, path: str, rejects: str) -> None:
    """Trials of a water maze by animal and day, each with the video of its place (A5, J14, W4, F13). swims: swim_trials with
    subject_id and session; videos: subject_id, date, path, start_ts. Trials without a video are rejected, one by one."""
    dated = swims.withColumn("date", F.to_date("ts"))
    days = trials.by_day(dated, ["subject_id", "session"]).select("subject_id", "session", "date", F.col("day").alias("first_day"))
    named = dated.join(days, ["subject_id", "session", "date"]).withColumn("session_id", scalar.session_name(F.lit(task), F.col("session"), F.col("first_day")))
    timed = trials.timed(named, KEY)
    both = trials.paired_by_position(timed, videos.withColumnRenamed("path", "video"), ["subject_id", "date"], ["row_no"], ["start_ts", "video"], "left")
    judged = both.drop("start_ts").withColumn("reason", F.when(F.col("video").isNull(), "no video"))
    writers.write_with_rejects(judged, path, rejects)


def freezing_sessions(sheets: DataFrame, log: DataFrame, path: str, rejects: str) -> None:
    """Freezing by bin with the session's start from the log (R1, C1). sheets: freeze-score rows with path and session_id; log:
    animal and ts. An animal without exactly one line in the log is rejected."""
    scored = trials.freeze_trials(sheets, key=["path", "session_id"]).filter(F.col("row_no") > 2)
    started = guards.exactly_one(log.select(F.col("animal").alias("subject_id"), "ts"), ["subject_id"]).dropDuplicates(["subject_id"])
    rows = scored.withColumnRenamed("animal", "subject_id").join(started, "subject_id", "left")
    reason = F.when(F.col("ts").isNull() & F.col("reason").isNull(), "not in log").otherwise(F.col("reason"))
    writers.write_with_rejects(rows.withColumn("reason", reason), path, rejects)


def recording_sessions(sessions: DataFrame, sheet: DataFrame, groups: DataFrame, series: DataFrame, ttl: DataFrame, cs_frames: DataFrame, frames: DataFrame, videos: DataFrame, folder: str) -> None:
    """Electrodes, series and clocks of recordings (J10-J12, R4, W10). sessions: subject_id, session_id. Below the folder:
    electrodes, series (with the channels' kinds), frames on the session's clock, and rejects."""
    electrodes, good, bad = conversion.recording_tables(sheet, groups, sessions)
    clocks = conversion.aligned_recordings(ttl, cs_frames, frames, videos)
    of_session = good.select(*KEY, "genotype").join(clocks, KEY, "left")
    shifted = align.shifted_frames(frames.join(videos, "path"), of_session, KEY)
    shown = align.no_negative_start(shifted, [*KEY, "path"])
    kinds = electrodes.groupBy("subject_id").agg(F.array_sort(F.collect_list(F.struct("channel", "kind"))).alias("channels"))
    writers.write_sessions(good.select(*KEY).join(electrodes, "subject_id"), f"{folder}/electrodes")
    writers.write_sessions(series.join(of_session, KEY).join(kinds, "subject_id", "left"), f"{folder}/series", sort="sample_idx")
    writers.write_sessions(shown.join(good.select(*KEY), KEY, "left_semi"), f"{folder}/frames", sort="frame_idx")
    writers.write_rejects(bad, f"{folder}/rejects")


def catalogue_ingest(tables: dict[str, DataFrame], new: dict[str, DataFrame], key: list[str]) -> dict[str, DataFrame]:
    """A catalogue after an ingest (SK4-SK7): the sessions that come again are cleaned with all that hangs on them, then
    sessions, their parts, the LFP series and the events are inserted where their parent is there and they aren't yet.

    tables: session, part, lfp and event as they stand; new: session, part, electrode, signal, rate and event."""
    clean = catalog.without_session(tables, new["session"].select(*key).distinct())
    session = clean["session"].unionByName(catalog.insertable(new["session"], clean["session"], key))
    whole = lambda name, rows: clean[name].unionByName(rows.join(session.select(*key), key, "left_semi"))
    having = catalog.events_to_insert(new["event"], session, clean["event"], key)
    lfp = catalog.lfp_series(new["electrode"], new["signal"], new["rate"], key)
    return {"session": session, "part": whole("part", new["part"]), "lfp": whole("lfp", lfp), "event": clean["event"].unionByName(new["event"].join(having.select(*key), key, "left_semi"))}


def catalogue_batch(spark: SparkSession, folder: str, batch: str, new: dict[str, DataFrame], rejects: DataFrame | None = None) -> bool:
    """Ingest a batch of sessions with all that hangs on them as one (SK4-SK6): session, part, lfp and event become visible
    together. new: session, part, electrode, signal, rate and event, each with subject_id and session_id."""
    lfp = catalog.lfp_series(new["electrode"], new["signal"], new["rate"], KEY)
    return batches.ingest(spark, folder, batch, new["session"], {"session": new["session"], "part": new["part"], "lfp": lfp, "event": new["event"]}, rejects)


class TaskRules(NamedTuple):
    """What a task's sessions must have. valid: a pattern that names must have; trials: patterns of the sessions whose videos
    are trials of their own, with what they are called; lone: whether one video alone is a trial there too; scored: the
    sessions that have events; only_in: devices that other sessions lack, with the pattern of those that have them."""

    valid: str | None = None
    trials: tuple[tuple[str, str], ...] = ()
    lone: bool = False
    scored: str = "Test"
    only_in: tuple[tuple[str, str], ...] = ()


#: The tasks' rules.
PREY_CAPTURE = TaskRules(valid="Hab|Test|Weeto", trials=(("Test", "Test"), ("Weeto", "Weeto")), lone=True)
MARBLE_INTERACTION = TaskRules(only_in=(("Marbles", "Test"),))
ONE_TRIAL_SOCIAL = TaskRules(trials=(("HabD1", "HabD1"),))


def trial_videos(sessions: DataFrame, files: DataFrame, rules: TaskRules) -> tuple[DataFrame, DataFrame]:
    """Videos of sessions as trials, and rejects (C2, F4, F6, W5, W12, X1). sessions: subject_id, session_id, session; files:
    subject_id, session_id, name. A session starts when its first video does; each video has its own offset from then (Q3)."""
    name = F.col("session")
    kept = discover.without_stimulus(files).select(*KEY, "name", scalar.name_time(F.col("name")).alias("start_ts"))
    kept = shared.written(kept, "kept")  # a name's time is read once
    counted = kept.groupBy(*KEY).agg(F.count("*").alias("n"), F.count_if(F.col("start_ts").isNull()).alias("undated"))
    counted = shared.written(counted, "counted")
    several = F.coalesce(*[F.when(name.contains(p), F.lit(called)) for p, called in rules.trials], F.lit(None).cast("string"))
    judged = sessions.select(*KEY, "session").join(counted, KEY, "left")
    reason = guards.first_reason([
        (~name.rlike(rules.valid) if rules.valid else F.lit(False), "unknown session"), (F.col("n").isNull(), "no_video"),
        (F.col("undated") > 0, "no date in a file name"), ((F.col("n") > 1) & several.isNull(), "multiple videos"),
    ])
    good, bad = guards.split_rejects(judged.withColumn("reason", reason))
    rows = good.select(*KEY, several.alias("called"), "n").join(kept, KEY)
    by = Window.partitionBy(*KEY).orderBy("_natural", "name").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # the place and the first time come of one sort, for which a name's key is made once
    first = rows.withColumn("_natural", scalar.natural_key(F.col("name"))).select("*", F.row_number().over(by).alias("trial"), F.first("start_ts").over(by).alias("session_start"))
    as_trial = F.col("called").isNotNull() & (F.lit(rules.lone) | (F.col("n") > 1))
    called = F.when(as_trial, F.concat(F.lit("BehavioralVideo"), "called", F.lit("Trial"), "trial")).otherwise("BehavioralVideo")
    epoch = F.when(as_trial, F.array("trial"))
    return first.select(*KEY, "name", called.alias("video_name"), "trial", epoch.alias("task_epochs"), "session_start", scalar.seconds_between(F.col("start_ts"), F.col("session_start")).alias("start_s")), bad.select(*KEY, "reason")


def scored_sessions(sessions: DataFrame, files: DataFrame, projects: DataFrame, audio: DataFrame, devices: DataFrame, rules: TaskRules, folder: str) -> None:
    """Prey capture, marble and social sessions, from listings and scoring projects to tables: videos, events, audio, devices,
    rejects (J4, J5, J8, F8, Q14, Q18). sessions: subject_id, session_id, session, cohort_id, animal_id; projects: with
    cohort_id; audio: subject_id, session_id, name, of which the n-th starts with the n-th video; devices: name.

    A session that must have events is rejected if its cohort has a project, but none of its observations contains the
    animal's id; a cohort without a project goes on without events."""
    videos, bad = trial_videos(sessions, files, rules)
    videos = shared.written(videos, "videos")
    there = videos.select(*KEY).distinct()
    wanted = sessions.join(there, KEY, "left_semi").filter(F.col("session").contains(rules.scored)).select(*KEY, "cohort_id", "animal_id")
    long = events.annotated_events(events.marks(projects).filter(F.col("t_s").isNotNull()), events.behaviours(projects), [c for c in ("cohort_id", "path", "observation_id") if c in projects.columns or c == "observation_id"])
    observed = projects.select("cohort_id", F.explode(F.map_keys("observations")).alias("observation_id")).distinct()
    own = shared.written(discover.match_observation(wanted, observed, ["cohort_id"], KEY, F.col("animal_id")).select(*KEY, "cohort_id", "observation_id"), "own")
    unseen = wanted.join(projects.select("cohort_id").distinct(), "cohort_id", "left_semi").join(own.select(*KEY), KEY, "left_anti").select(*KEY, F.lit("no observation").alias("reason"))
    good = there.join(unseen.select(*KEY), KEY, "left_anti")
    sound = trials.paired_by_position(audio, videos.select(*KEY, "trial", "start_s"), KEY, ["name"], ["trial"], "left").select(*KEY, "name", "nth", "start_s")
    of_session = lambda rows: rows.join(good, KEY, "left_semi")
    writers.write_sessions(of_session(videos), f"{folder}/videos")
    writers.write_sessions(of_session(own.join(long, ["cohort_id", "observation_id"])), f"{folder}/events")
    writers.write_sessions(of_session(sound), f"{folder}/audio")
    if rules.only_in:
        ruled = devices.sparkSession.createDataFrame([(rules.scored, *r) for r in rules.only_in], "task string, device string, session_pattern string")
        of_task = of_session(sessions.select(*KEY, "session")).withColumn("task", F.lit(rules.scored))
        writers.write_sessions(meta.devices_of(of_task, devices.select("name", F.lit(rules.scored).alias("task")), ruled).select(*KEY, "name"), f"{folder}/devices")
    writers.write_rejects(bad.unionByName(unseen), f"{folder}/rejects")


def reject_counts(rejects: DataFrame, session: Column | None = None) -> DataFrame:
    """Rejects of a flow by reason."""
    return rejects.groupBy("reason").agg(F.count_distinct(session if session is not None else F.struct(*KEY)).alias("n"))

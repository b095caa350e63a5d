"""Conversions from small cohorts to their sinks."""

from pyspark.sql import functions as F

from burrowline.plans import flows
from burrowline.sources import schemas, writers


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=lambda t: tuple((x is not None, str(x)) for x in t))


def test_object_sessions(spark, tmp_path):
    observed = {"12_STM_sample": (0.0, ({},), [["1", "", "A", "0"], ["3", "", "A", "9"]]), "112_STM_test": (0.0, ({},), [["7", "", "A", "0"]])}
    conf = {"0": ("State event", "A", "")}
    projects = spark.createDataFrame([(observed, conf, "c1", "p1")], schemas.PROJECT + ", cohort_id string, path string")
    sheet = spark.createDataFrame([("c1", "STM", "sample", "A", "NW", "novel", "cup"), ("c2", "STM", "sample", "A", "SE", "old", "cone")], "cohort_id string, test string, trial string, Obj_A string, Pos_A string, ID_A string, ObjName_A string")
    sessions = spark.createDataFrame([("c1-12", "OLM_STM", "c1", 12, "STM"), ("c1-9", "OLM_STM", "c1", 9, "STM")], "subject_id string, session_id string, cohort_id string, animal_id int, session_kind string")
    flows.object_sessions(sessions, projects, sheet, str(tmp_path / "s"), str(tmp_path / "r"))
    assert rows(spark.read.parquet(str(tmp_path / "s")), "subject_id", "start_s", "duration_s", "object", "position") == [("c1-12", 1.0, 2.0, "cup", "NW")]
    assert rows(spark.read.parquet(str(tmp_path / "r")), "subject_id", "reason") == [("c1-9", "no observation")]


def test_swim_sessions(spark, tmp_path):
    swims = spark.createDataFrame([("a", "Cue", 1, 3, "2023-01-05 10:00:00", 60.0), ("a", "Cue", 2, 3, "2023-01-05 10:05:00", 30.0), ("a", "Cue", 3, 4, "2023-01-06 09:00:00", 10.0)], "subject_id string, session string, row_no int, day int, ts string, trial_duration double").withColumn("ts", F.to_timestamp("ts"))
    videos = spark.createDataFrame([("a", "2023-01-05", "v2", 2), ("a", "2023-01-05", "v1", 1)], "subject_id string, date string, path string, start_ts int").withColumn("date", F.to_date("date"))
    flows.swim_sessions(swims, videos, "WM", str(tmp_path / "s"), str(tmp_path / "r"))
    assert rows(spark.read.parquet(str(tmp_path / "s")), "session_id", "video", "start_s", "stop_s") == [("WM_Cue_Day3", "v1", 0.0, 60.0), ("WM_Cue_Day3", "v2", 300.0, 330.0)]
    assert rows(spark.read.parquet(str(tmp_path / "r")), "session_id", "reason") == [("WM_Cue_Day4", "no video")]
    assert rows(flows.reject_counts(spark.read.parquet(str(tmp_path / "r"))), "reason", "n") == [("no video", 1)]


def test_freezing_sessions(spark, tmp_path):
    cells = [(0, "On", "0", "Threshold", None), (1, "For", "30", None, None), (2, None, None, None, "2.5"), (3, "m1", "10", "1", None), (4, "m2", "20", "1", None), (5, "m3", "30", "1", None)]
    sheets = spark.createDataFrame([("f", "Recall", *c) for c in cells], "path string, session_id string, row_no int, a string, b string, c string, d string")
    log = spark.createDataFrame([("m1", 5), ("m2", 6), ("m2", 7)], "animal string, ts int")
    flows.freezing_sessions(sheets, log, str(tmp_path / "s"), str(tmp_path / "r"))
    assert rows(spark.read.parquet(str(tmp_path / "s")), "subject_id", "freezing", "start_s", "ts") == [("m1", 10.0, 0.0, 5)]
    assert rows(spark.read.parquet(str(tmp_path / "r")), "subject_id", "reason") == [("m2", "multiple"), ("m3", "not in log")]


def test_recording_sessions(spark, tmp_path):
    sheet = spark.createDataFrame([("R1", "wt", *["IrL_1", "bad", "EEG_F"], *["IrL_2"] * 13)], "subject_id string, Genotype string, " + ", ".join(f"`{i}` string" for i in range(16)))
    groups = spark.createDataFrame([("IrL_1", "g"), ("IrL_2", "g")], "location_code string, group_name string")
    sessions = spark.createDataFrame([("R1", "r1"), ("R9", "r1")], "subject_id string, session_id string")
    series = spark.createDataFrame([("R1", "r1", "lfp", i, [float(i)] * 16) for i in range(3)], schemas.SIGNALS)
    ttl = spark.createDataFrame([("R1", "r1", 2, 2000, 1)], schemas.TTL_EVENTS)
    frames = spark.createDataFrame([("v", 0, -2.0), ("v", 1, 0.5)], schemas.VIDEO_FRAMES)
    videos = spark.createDataFrame([("R1", "r1", "v")], "subject_id string, session_id string, path string")
    flows.recording_sessions(sessions, sheet, groups, series, ttl, spark.createDataFrame([("R1", 1)], schemas.CS_FRAMES), frames, videos, str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "electrodes")).count() == 16
    assert rows(spark.read.parquet(str(tmp_path / "series")), "sample_idx", "genotype", "offset_s") == [(0, "WT", 0.5), (1, "WT", 0.5), (2, "WT", 0.5)]
    assert rows(spark.read.parquet(str(tmp_path / "frames")), "frame_idx", "t_s") == [(0, 0.0), (1, 2.5)]
    assert rows(spark.read.parquet(str(tmp_path / "rejects")), "subject_id", "reason") == [("R9", "subject_not_in_sheet")]
    assert writers.finished(spark, str(tmp_path / "series")).count() == 1


def test_catalogue_ingest_replaces_what_comes_again(spark):
    f = lambda data, kind: spark.createDataFrame(data, kind)
    lfp = f([("b", 0, [9.0], [0], 1.0, "raw data valid times")], "file string, sample_idx long, v array<double>, electrode_ids array<int>, rate double, interval_name string")
    tables = {"session": f([("a", 1), ("b", 1)], "file string, version int"), "part": f([("a", "old"), ("b", "kept")], "file string, part string"), "lfp": lfp, "event": f([("a", "old")], "file string, label string")}
    new = {
        "session": f([("a", 2), ("c", 1)], "file string, version int"), "part": f([("a", "new"), ("x", "no session")], "file string, part string"), "electrode": f([("a", 1, "LFP_g"), ("a", 0, "EEG")], "file string, electrode_id int, group_name string"),
        "signal": f([("a", 0, [1.0, 2.0])], "file string, sample_idx long, v array<double>"), "rate": f([("a", 2000.0)], "file string, rate double"), "event": f([("a", "new"), ("x", "no session")], "file string, label string"),
    }
    out = flows.catalogue_ingest(tables, new, ["file"])
    assert rows(out["session"], "file", "version") == [("a", 2), ("b", 1), ("c", 1)] and rows(out["part"], "file", "part") == [("a", "new"), ("b", "kept")]
    assert rows(out["lfp"], "file", "v") == [("a", [2.0]), ("b", [9.0])] and rows(out["event"], "file", "label") == [("a", "new")]


def test_scored_sessions(spark, tmp_path):
    key = "subject_id string, session_id string"
    f = lambda data, kind: spark.createDataFrame(data, f"{key}, {kind}")
    sessions = f([("c1-12", "PC_Hab", "HabD1", "c1", 12), ("c1-12", "PC_Test", "TestD2", "c1", 12), ("c1-9", "PC_Test", "TestD2", "c1", 9), ("c1-7", "PC_Hab", "HabD1", "c1", 7), ("c2-12", "PC_Test", "TestD2", "c2", 12), ("c1-12", "PC_Odd", "Cue", "c1", 12), ("c1-5", "PC_Weeto", "Weeto1", "c1", 5)], "session string, cohort_id string, animal_id int")
    v = lambda s, e, *names: [(s, e, n) for n in names]
    files = f(v("c1-12", "PC_Hab", "2023-04-01_10-00-00_a.avi") + v("c1-12", "PC_Test", "2023-04-02_10-10-00_a.avi", "2023-04-02_10-00-00_a.avi", "2023-04-02_09-00-00_STIM.avi") + v("c1-9", "PC_Test", "2023-04-02_11-00-00_b.avi") + v("c1-7", "PC_Hab", "2023-04-01_10-00-00_a.avi", "2023-04-01_11-00-00_a.avi") + v("c2-12", "PC_Test", "2023-04-02_11-00-00_b.avi") + v("c1-12", "PC_Odd", "2023-04-02_11-00-00_b.avi"), "name string")
    observed = {"12_TestD2": (0.0, ({},), [["1", "", "A", "0"], ["3", "", "A", "9"]])}
    projects = spark.createDataFrame([(observed, {"0": ("State event", "A", "")}, "c1", "p1")], schemas.PROJECT + ", cohort_id string, path string")
    audio = f([("c1-12", "PC_Test", "u1.wav"), ("c1-12", "PC_Test", "u2.wav"), ("c1-12", "PC_Test", "u3.wav")], "name string")
    devices = spark.createDataFrame([("Camera",), ("Marbles",)], "name string")
    for _ in range(2):  # a second run changes nothing
        flows.scored_sessions(sessions, files, projects, audio, devices, flows.PREY_CAPTURE._replace(only_in=(("Marbles", "Test"),)), str(tmp_path))
    read = lambda t: spark.read.parquet(str(tmp_path / t))
    assert rows(read("videos"), "subject_id", "session_id", "video_name", "start_s", "task_epochs") == [("c1-12", "PC_Hab", "BehavioralVideo", 0.0, None), ("c1-12", "PC_Test", "BehavioralVideoTestTrial1", 0.0, [1]), ("c1-12", "PC_Test", "BehavioralVideoTestTrial2", 600.0, [2]), ("c2-12", "PC_Test", "BehavioralVideoTestTrial1", 0.0, [1])]
    assert rows(read("events"), "subject_id", "session_id", "start_s", "duration_s") == [("c1-12", "PC_Test", 1.0, 2.0)]
    assert rows(read("audio"), "name", "start_s") == [("u1.wav", 0.0), ("u2.wav", 600.0), ("u3.wav", None)]
    assert rows(read("devices"), "subject_id", "session_id", "name") == [("c1-12", "PC_Hab", "Camera"), ("c1-12", "PC_Test", "Camera"), ("c1-12", "PC_Test", "Marbles"), ("c2-12", "PC_Test", "Camera"), ("c2-12", "PC_Test", "Marbles")]
    assert rows(read("rejects"), "subject_id", "session_id", "reason") == [("c1-12", "PC_Odd", "unknown session"), ("c1-5", "PC_Weeto", "no_video"), ("c1-7", "PC_Hab", "multiple videos"), ("c1-9", "PC_Test", "no observation")]


def test_social_sessions_have_trials_only_where_several(spark):
    key = "subject_id string, session_id string"
    sessions = spark.createDataFrame([("a", "1", "HabD1"), ("b", "1", "HabD1"), ("c", "1", "Test")], f"{key}, session string")
    files = spark.createDataFrame([("a", "1", "2023-04-01_10-00-00_a.avi"), ("b", "1", "2023-04-01_10-00-00_a.avi"), ("b", "1", "2023-04-01_10-00-30_a.avi"), ("c", "1", "2023-04-01_10-00-00_a.avi"), ("c", "1", "2023-04-01_10-00-01_a.avi")], f"{key}, name string")
    good, bad = flows.trial_videos(sessions, files, flows.ONE_TRIAL_SOCIAL)
    assert rows(good, "subject_id", "video_name", "start_s") == [("a", "BehavioralVideo", 0.0), ("b", "BehavioralVideoHabD1Trial1", 0.0), ("b", "BehavioralVideoHabD1Trial2", 30.0)]
    assert rows(bad, "subject_id", "reason") == [("c", "multiple videos")]

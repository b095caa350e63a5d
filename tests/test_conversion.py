"""The conversion flows end to end on a small cohort."""

from pyspark.sql import functions as F

from burrowline.plans import conversion


def test_sessions_and_rejects_are_the_whole_matrix(spark):
    subjects = spark.createDataFrame([(31, "c1", "L", 7, ["OLM"]), (408, "c1", "L", 8, ["OLM", "WM"]), (9, "c1", "L", 9, None), (5, "c2", "L", 7, ["OLM"])], "animal_id int, cohort_id string, line string, cage_id int, tasks array<string>")
    sessions = spark.createDataFrame([("OLM", 0, "HabD1"), ("OLM", 1, "Test STM"), ("WM", 0, "Cue")], "task string, ord int, session string")
    d = "L/c1_OLM/"
    files = spark.createDataFrame(
        [(d + "HabD1", "2023-04-01_10-53-05_408.mp4"), (d + "HabD1", "2023-04-01_10-50-00_stim_408.mp4"), (d + "HabD1", "notes_408.txt"), (d + "HabD1", "2023-04-02_31.avi"), (d + "Test STM", "2024-03-20 10-32-22_cage7 2.ts"), (d + "Test STM", "2024-03-20 09-00-00_cage7 10.ts"), (d + "Test STM", "undated_408.avi")],
        "dir string, name string",
    )
    good, bad = conversion.behavioural_sessions(subjects, sessions, files, "OLM", F.when(F.col("session").startswith("Hab"), 1).otherwise(2))
    got = {(r["animal_id"], r["session"]): r for r in good.collect()}
    assert set(got) == {(31, "HabD1"), (408, "HabD1"), (31, "Test STM")}
    assert got[(31, "Test STM")]["videos"] == ["2024-03-20 09-00-00_cage7 10.ts", "2024-03-20 10-32-22_cage7 2.ts"] and str(got[(31, "Test STM")]["start_ts"]) == "2024-03-20 09:00:00"
    assert (got[(408, "HabD1")]["session_id"], got[(31, "Test STM")]["session_kind"], got[(31, "HabD1")]["subject_id"]) == ("OLM_HabD1", "STM", "c1-31")
    assert sorted((r["animal_id"], r["session"], r["reason"]) for r in bad.collect()) == [(5, "HabD1", "folder missing"), (5, "Test STM", "folder missing"), (408, "Test STM", "no date in a file name")]


def test_recording_tables_and_clocks(spark):
    sheet = spark.createDataFrame([("R1", "wt", *["IrL_1", "bad", "EEG_F"], *["IrL_2"] * 13)], "subject_id string, Genotype string, " + ", ".join(f"`{i}` string" for i in range(16)))
    groups = spark.createDataFrame([("IrL_1", "g"), ("IrL_2", "g"), ("unknown", "b")], "location_code string, group_name string")
    sessions = spark.createDataFrame([("R1", "Recall"), ("R9", "Recall")], "subject_id string, session_id string")
    e, good, bad = conversion.recording_tables(sheet, groups, sessions)
    assert {r["kind"]: r["count"] for r in e.groupBy("kind").count().collect()} == {"lfp": 14, "bad": 1, "eeg": 1}
    assert [r["genotype"] for r in good.collect()] == ["WT"] and [r["reason"] for r in bad.collect()] == ["subject_not_in_sheet"]
    ttl = spark.createDataFrame([("R1", "Recall", 2, 4000, 1)], "subject_id string, session_id string, channel int, sample long, state int")
    cs = spark.createDataFrame([("R1", 3)], "subject_id string, first_cs_frame int")
    frames = spark.createDataFrame([("R1", 3, 0.5)], "subject_id string, frame_idx int, t_s double")
    r = conversion.aligned_recordings(ttl, cs, frames).first()
    assert (r["offset_s"], r["video_offset"], r["recording_offset"], r["aligned"]) == (1.5, 1.5, 0.0, True)


def test_enriched_events(spark):
    p = spark.createDataFrame([({"1_STM_sample": (0.0, ({},), [["1", "", "A", "0"], ["3", "", "A", "9"]])}, {"0": ("State event", "A", "")})], "observations map<string,struct<`time offset`:double,media_info:struct<fps:map<string,double>>,events:array<array<string>>>>, behaviors_conf map<string,struct<type:string,code:string,description:string>>")
    sheet = spark.createDataFrame([("STM", "sample", "A", "NW", "novel", "cup")], "test string, trial string, Obj_A string, Pos_A string, ID_A string, ObjName_A string")
    r = conversion.enriched_events(p, sheet, ["test"]).first()
    assert (r["start_s"], r["duration_s"], r["novelty"], r["object"]) == (1.0, 2.0, "novel", "cup")

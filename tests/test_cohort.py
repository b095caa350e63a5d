"""Names, registries, matching, metadata, catalogue and sinks on hand-written rows."""

import pytest
from pyspark.sql import functions as F

from burrowline.functions import scalar
from burrowline.operators import catalog, discover, guards, meta
from burrowline.sources import readers, schemas, writers


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=lambda r: tuple((x is not None, str(x)) for x in r))


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("name", "expected"),
    [
        ("2024-03-20 10-32-22_597L_598R.ts", "2024-03-20 10:32:22"),
        ("2022-08-01_302_303_compressed.mp4", "2022-08-01 00:00:00"),
        ("2023-03-31_10-53-05_471.mp4", "2023-03-31 10:53:05"),
        ("2024-03-20 10-32-22 597.ts", "2024-03-20 10:32:22"),
        ("no date.avi", "None"),
        ("2024-13-40 10-32-22_5.ts", "None"),
    ],
)
def test_dates_in_names(spark, name, expected):
    assert str(one(spark, scalar.name_time(F.col("n")), n=name)) == expected


def test_london_time_knows_summer(spark):
    assert str(one(spark, scalar.localised(F.to_timestamp("n")), n="2020-07-01 12:00:00")) == "2020-07-01 11:00:00"
    assert str(one(spark, scalar.localised(F.to_timestamp("n")), n="2020-01-01 12:00:00")) == "2020-01-01 12:00:00"


def test_text_functions(spark):
    assert one(spark, scalar.whole(F.col("n")), n="3.0") == 3 and one(spark, scalar.whole(F.col("n")), n="x") is None
    assert one(spark, scalar.number(F.col("n")), n="NaN") is None
    assert (one(spark, scalar.file_name(F.col("n")), n="a/b/c.d.mp4"), one(spark, scalar.stem(F.col("n")), n="a/b/c.d.mp4"), one(spark, scalar.suffix(F.col("n")), n="a/b/c.d.MP4")) == ("c.d.mp4", "c.d", ".mp4")
    assert [one(spark, scalar.media_class(F.col("n")), n=n) for n in ("a.AVI", "a.ts", "a.txt", "a")] == ["supported", "convertible", "unsupported", "unsupported"]
    assert one(spark, scalar.plain_session(F.col("n")), n="(HabD2) ") == "HabD2"
    assert one(spark, scalar.task_list(F.col("n")), n="OLM, OR ,WM") == ["OLM", "OR", "WM"]
    assert one(spark, scalar.catalogue_name(F.col("n")), n="sub-1.nwb") == "sub-1_.nwb"
    assert [one(spark, scalar.session_kind(F.col("n")), n=n) for n in ("Test STM", "Test LTM", "HabD1", "Test", "x")] == ["STM", "LTM", "Hab", "Test", "other"]
    assert one(spark, scalar.session_key(F.col("n")), n="WM_Cue_Day3") == "WM_Cue"
    assert [one(spark, scalar.sex_code(F.col("n")), n=n) for n in ("male", "Female", "x")] == ["M", "F", "U"]
    assert one(spark, scalar.people(F.col("a"), F.col("b")), a="Ann", b="Ann") == ["Ann"] and one(spark, scalar.people(F.col("a"), F.col("b")), a="Ann", b="Bo") == ["Ann", "Bo"]
    assert one(spark, scalar.clean_label(F.col("n")), n="mPFC_LFP_electrode_group") == "mPFC"
    assert one(spark, scalar.test_delay(F.lit("STM"), F.lit(0.0)), n="") == 1200.0 and one(spark, scalar.test_delay(F.lit("LTM"), F.lit(0.0)), n="") == 0.0
    assert one(spark, scalar.session_name(F.lit("OLM"), F.col("n"), F.lit(2)), n="Test") == "OLM_Test_Day2"


def test_natural_order(spark):
    df = spark.createDataFrame([(n,) for n in ("trial10.avi", "trial2.avi", "trial2b.avi", "a1")], "n string")
    long = ["v" + "9" * 20 + "1", "v" + "9" * 20 + "2", "v" + "9" * 21 + "1", "v3"]
    assert spark.createDataFrame([(x,) for x in long], "n string").select(scalar.natural_key(F.col("n"))).distinct().count() == 4
    assert [r["n"] for r in df.orderBy(scalar.natural_key(F.col("n"))).collect()] == ["a1", "trial2.avi", "trial2b.avi", "trial10.avi"]


def test_registry_and_sessions(spark, tmp_path):
    (tmp_path / "r.csv").write_text('animal ID,cohort no.,tasks conducted,sex\n303.0,1,"OLM, OR ,WM",male\n,,,\n40,2,,x\n')
    r = readers.registry(spark, str(tmp_path / "r.csv"))
    assert rows(r, "animal_id", "cohort_no", "tasks") == [(303, 1, ["OLM", "OR", "WM"]), (40, 2, None)]
    assert discover.did_task(r, "OR").count() == 1
    (tmp_path / "s.csv").write_text("Acronym,Name,Pattern,s1,s2,s3,Notes\nOLM,n,p,HabD1 ,(HabD2),,note\nWM,n,p,x,,,\n")
    s = readers.session_list(spark, str(tmp_path / "s.csv"), "OLM")
    assert rows(s, "ord", "session") == [(0, "HabD1"), (1, "HabD2")]
    sheet = readers.text_csv(spark, str(tmp_path / "s.csv"))
    asked = spark.createDataFrame([("OLM",), ("ZZ",)], "task string")
    assert rows(meta.unknown_task(sheet, asked), "task", "reason") == [("ZZ", "unknown task")]


def test_pooled_cages_last_file_wins(spark, tmp_path):
    (tmp_path / "1_POOLED.csv").write_text(" animal ID ,cohort ID,cage ID\n303, c1,5\nbad,c1,7\n40,c1,6\n")
    (tmp_path / "2_POOLED.csv").write_text("Unique animal ID,cohort ID,cage ID,more\n303,c1,9,x\n")
    (tmp_path / "3_POOLED.csv").write_text("a,b\n1,2\n")
    cages = readers.pooled_cages(spark, str(tmp_path))
    assert rows(cages, "animal_id", "cohort_id", "cage_id") == [(303, "c1", 9), (40, "c1", 6)]
    subjects = spark.createDataFrame([(303, "c1", None), (40, "c1", 1), (7, "c1", None)], "animal_id int, cohort_id string, cage_id int")
    assert rows(meta.with_cage(subjects, cages, ["animal_id", "cohort_id"]), "animal_id", "cage_id") == [(303, 9), (40, 1), (7, None)]


def test_listing_and_path_templates(spark, tmp_path):
    d = tmp_path / "Rat-1" / "Recall"
    d.mkdir(parents=True)
    (d / "Rat-1_2020-01-02_10-11-12_Recall").write_text("x")
    (d / "Rat-2_2020-01-02_10-11-12_Recall").write_text("x")
    listing = readers.files(spark, str(tmp_path))
    assert rows(listing, "dir", "name", "length") == [("Recall", "Rat-1_2020-01-02_10-11-12_Recall", 1), ("Recall", "Rat-2_2020-01-02_10-11-12_Recall", 1)]
    assert "content" not in listing.columns
    out = readers.ephys_paths(listing)
    assert [(r["subject_id"], r["session_id"], r["task"], str(r["start_ts"])) for r in out.collect()] == [("Rat-1", "Recall", "Recall", "2020-01-02 10:11:12")]


@pytest.fixture(scope="module")
def videos(spark):
    return spark.createDataFrame([("d", "x_40_a.mp4"), ("d", "x_408.avi"), ("d", "cage7.avi"), ("e", "x_40.mp4"), ("d", "STIM_40.mp4")], "dir string, name string")


def test_names_match_by_id_then_by_cage(spark, videos):
    s = spark.createDataFrame([("d", "40", "7"), ("d", "99", "7"), ("d", "55", "1")], "dir string, animal string, cage string")
    files = discover.without_stimulus(videos)
    hit = discover.match_names(s, files, ["dir"], ["dir", "animal"], [F.col("animal"), F.concat(F.lit("cage"), F.col("cage"))])
    assert rows(hit, "animal", "name", "prio", "n_match") == [("40", "x_408.avi", 0, 2), ("40", "x_40_a.mp4", 0, 2), ("99", "cage7.avi", 1, 1)]
    best = discover.first_match(hit, ["dir", "animal"], [discover.suffix_preference(scalar.suffix(F.col("name"))), F.col("name")])
    assert rows(best, "animal", "name") == [("40", "x_408.avi"), ("99", "cage7.avi")]
    ids = spark.createDataFrame([("d", "40"), ("d", "408")], "dir string, id string")
    amb = discover.ambiguous(hit.select("dir", "animal", "name"), ids, ["dir"], "animal", "id")
    assert rows(amb, "name", "ambiguous_match") == [("cage7.avi", False), ("x_408.avi", True), ("x_40_a.mp4", False)]
    missing = discover.missing(s, hit, ["dir", "animal"])
    assert rows(missing, "animal") == [("55",)]


def test_observations_and_side_files(spark, videos):
    s = spark.createDataFrame([("c", 40, "Test_B"), ("c", 41, "Test_C")], "cohort string, animal int, session string")
    o = spark.createDataFrame([("c", "40_STM_b"), ("c", "40_STM_a"), ("c", "9")], "cohort string, observation_id string")
    assert rows(discover.match_observation(s, o, ["cohort"], ["cohort", "animal"], F.col("animal"), F.col("observation_id").contains("STM")), "animal", "observation_id") == [(40, "40_STM_a")]
    assert rows(discover.unique_observation(s, o, ["cohort"], ["animal"], F.col("animal").cast("string")).select("animal", "reason").distinct(), "animal", "reason") == [(40, "multiple"), (41, "none")]
    f = spark.createDataFrame([("c", "x_B.csv"), ("c", "y_B10.csv"), ("c", "z_C.csv")], "cohort string, name string")
    assert rows(discover.match_second_token(s, f, ["cohort"], ["animal"]).select("session", "reason").distinct(), "session", "reason") == [("Test_B", "multiple"), ("Test_C", None)]
    side = discover.side_file(s, f, ["cohort"], "sheets", as_list=True)
    assert rows(side, "animal", "sheets")[0] == (40, ["x_B.csv", "y_B10.csv", "z_C.csv"])
    assert discover.with_folder(s.withColumn("dir", F.lit("nowhere")), videos).filter("name is null").count() == 2


def test_guards_and_rejects(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("c", None)], "k string, v int")
    assert rows(guards.exactly_one(df, ["k"], F.col("v").isNotNull()).select("k", "reason").distinct(), "k", "reason") == [("a", "multiple"), ("b", None), ("c", "none")]
    out = guards.expected_count(df, ["k"], F.lit(1))
    assert rows(out, "k", "reason") == [("a", "too many"), ("b", None), ("c", None)]
    r = df.withColumn("reason", guards.first_reason([(F.col("v") > 1, "big"), (F.col("v").isNull(), "null")]))
    good, bad = guards.split_rejects(r.withColumn("task", F.lit("t")))
    assert good.count() + bad.count() == df.count()
    assert rows(guards.discovery_log(bad), "reason", "n") == [("big", 1), ("null", 1)]


def test_metadata(spark):
    s = spark.createDataFrame([("R1", "Recall"), ("R2", "zz")], "subject_id string, session_key string")
    t = spark.createDataFrame([("Recall", "recall")], "session_key string, name string")
    assert rows(meta.with_session_type(s, t), "subject_id", "name", "reason") == [("R1", "recall", None), ("R2", None, "unknown session type")]
    sheet = spark.createDataFrame([("R1", "wt"), ("R3", "het"), ("R4", "odd")], "subject_id string, Genotype string")
    g = meta.with_genotype(spark.createDataFrame([(f"R{i}",) for i in range(1, 5)], "subject_id string"), sheet)
    assert rows(g, "subject_id", "genotype", "reason") == [("R1", "WT", None), ("R2", None, "subject_not_in_sheet"), ("R3", "Syngap1+/Delta-GAP", None), ("R4", None, "unknown genotype")]
    p = spark.createDataFrame([("s", "Ann", "Bo", "Cy")], "k string, `OLM exp` string, `OLM sco` string, `WM exp` string")
    assert rows(meta.task_people(p, ["OLM", "WM"], ["k"]), "task", "experimenters") == [("OLM", ["Ann", "Bo"]), ("WM", ["Cy"])]
    sessions = spark.createDataFrame([("AFC", "CondA"), ("AFC", "Recall")], "task string, session string")
    dev = spark.createDataFrame([("AFC", "chamber A"), ("AFC", "chamber B"), ("AFC", "camera")], "task string, name string")
    rules = spark.createDataFrame([("AFC", "chamber A", "Cond"), ("AFC", "chamber B", "Recall")], "task string, device string, session_pattern string")
    assert rows(meta.devices_of(sessions, dev, rules), "session", "name") == [("CondA", "camera"), ("CondA", "chamber A"), ("Recall", "camera"), ("Recall", "chamber B")]
    d = meta.with_defaults(spark.createDataFrame([("a", None), ("b", "own")], "k string, device string"), spark.createDataFrame([("cam",)], "device string"), ["device"])
    assert rows(d, "k", "device") == [("a", "cam"), ("b", "own")]
    m = spark.createDataFrame([({"a": "1", "b": "2"}, {"b": "3"}), (None, {"c": "4"})], "lo map<string,string>, hi map<string,string>")
    assert [r["m"] for r in m.select(meta.merged_maps(F.col("lo"), F.col("hi")).alias("m")).collect()] == [{"a": "1", "b": "3"}, {"c": "4"}]
    sub = meta.described_subjects(spark.createDataFrame([(303, "c1", "male", "wt", "pair", 5)], "animal_id int, cohort_id string, sex string, genotype string, housing string, cage_id int"))
    assert rows(sub, "subject_id", "sex", "genotype", "description") == [("c1-303", "M", "WT", "Housing: pair. Cage ID: 5")]
    assert rows(meta.probe_ids(spark.createDataFrame([(4,)], "row_no int")), "probe_id") == [(4,)]


@pytest.fixture(scope="module")
def store(spark):
    return {
        "session": spark.createDataFrame([("a",), ("b",)], "file string"),
        "interval": spark.createDataFrame([("a", 1), ("b", 2)], "file string, i int"),
        "lfp": spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "i int, v string"),
    }


def test_catalogue(spark, store):
    links = [("session", "interval", {"file": "file"}), ("interval", "lfp", {"i": "i"})]
    out = catalog.cascade(store, links, "session", {"file": "a"})
    assert rows(out["lfp"], "v") == [("x",)]
    assert rows(catalog.restrict(store["lfp"], {"v": None}), "i") == [(3,)]
    assert rows(catalog.restrict(store["lfp"], "i > 1"), "i") == [(2,), (3,)]
    assert rows(catalog.restrict(store["lfp"], [{"i": 1}, {"v": "y"}]), "i") == [(1,), (2,)]
    new = spark.createDataFrame([("a", 1), ("a", 5), ("z", 6), ("a", 5)], "file string, i int")
    assert rows(catalog.insertable(new, store["interval"], ["i"], store["session"], ["file"]), "i") == [(5,)]
    left = catalog.without_session(store, spark.createDataFrame([("a",)], "file string"))
    assert rows(left["interval"], "i") == [(2,)] and left["lfp"].count() == 3
    assert rows(catalog.unused(store["lfp"], "i", [left["interval"]]), "i") == [(1,), (3,)]
    assert catalog.report(store, {"file": "a"}, 1)["interval"].count() == 1
    assert rows(catalog.fetch_one(store["interval"], "i", ["file"]), "i", "reason") == [(1, None), (2, None)]
    assert rows(catalog.events_to_insert(new, store["session"], store["interval"].filter("file = 'b'"), ["file"]), "file") == [("a",)]


def test_lfp_series(spark):
    e = spark.createDataFrame([("f", 0, "a_LFP_g"), ("f", 2, "b_LFP_g"), ("f", 1, "EEG_g")], "file string, electrode_id int, group_name string")
    s = spark.createDataFrame([("f", 0, [1.0, 2.0, 3.0])], "file string, sample_idx long, v array<double>")
    m = spark.createDataFrame([("f", 2000.0)], "file string, rate double")
    assert rows(catalog.lfp_series(e, s, m, ["file"]), "electrode_ids", "v", "rate") == [([0, 2], [1.0, 3.0], 2000.0)]


def test_numbers_as_session_keys_stay_text_and_half_written_sessions_are_replaced(spark, tmp_path):
    path = str(tmp_path / "s")
    one = lambda subject, i: spark.createDataFrame([(subject, "r1", "lfp", i, [1.0])], schemas.SIGNALS)
    writers.write_sessions(one("007", 0), path)
    writers.write_sessions(one("7", 1), path)
    one("8", 5).write.partitionBy(*writers.KEY).mode("append").parquet(path)  # as a run that failed before it was finished
    writers.write_sessions(one("8", 2).unionByName(one("7", 9)), path)
    assert rows(writers.existing(spark, path, schemas.SIGNALS), "subject_id", "sample_idx") == [("007", 0), ("7", 1), ("8", 2)]


def test_sessions_are_written_once_and_read_by_key(spark, tmp_path):
    path = str(tmp_path / "signals")
    df = spark.createDataFrame([("s", "r1", "lfp", i, [float(i)]) for i in range(20)] + [("s", "r2", "lfp", 0, [1.0])], schemas.SIGNALS)
    writers.write_sessions(df, path, sort="sample_idx")
    writers.write_sessions(df.unionByName(spark.createDataFrame([("t", "r1", "lfp", 0, [1.0])], schemas.SIGNALS)), path)
    assert spark.read.parquet(path).count() == 22  # nothing twice
    writers.write_sessions(df.filter("session_id = 'r2'").withColumn("sample_idx", F.lit(7).cast("long")), path, overwrite=True)
    assert rows(spark.read.parquet(path).filter("subject_id = 's' and session_id = 'r2'"), "sample_idx") == [(7,)] and spark.read.parquet(path).count() == 22
    m = spark.createDataFrame([("s", "r1", "lfp", 2000.0, 0.0, None, None, None)], schemas.SERIES_META)
    assert readers.signals(spark, path, m).filter("rate = 2000").count() == 20
    assert rows(readers.by_key(spark.read.parquet(path), "s", "r").select("reason").distinct(), "reason") == [("multiple",)]
    assert rows(readers.by_key(spark.read.parquet(path), "s", "r1").select("reason").distinct(), "reason") == [(None,)]
    good = spark.createDataFrame([("u", "r9", None), ("v", "r9", "no_video")], "subject_id string, session_id string, reason string").withColumn("x", F.lit(1))
    writers.write_with_rejects(good, str(tmp_path / "ok"), str(tmp_path / "bad"))
    assert spark.read.parquet(str(tmp_path / "ok")).count() == 1 and rows(spark.read.parquet(str(tmp_path / "bad")), "reason") == [("no_video",)]
    assert rows(good.select(writers.session_file().alias("n")).limit(1), "n")[0][0].startswith("sub-")


def test_mock_session_round_trip(spark, tmp_path):
    """20 samples of ones on one channel, two epochs, 100 frame times."""
    path = str(tmp_path / "mock")
    s = spark.createDataFrame([("m", "1", "lfp", i, [1.0]) for i in range(20)], schemas.SIGNALS)
    writers.write_sessions(s, path, sort="sample_idx")
    back = spark.read.schema(schemas.SIGNALS).parquet(path)
    assert rows(back, "sample_idx", "v") == rows(s, "sample_idx", "v")

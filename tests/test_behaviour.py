"""Events, measures and trial sheets on hand-written rows."""

import json

import pytest
from pyspark.sql import functions as F

from burrowline.operators import analytics, discover, events, trials
from burrowline.sources import readers, sheets


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=lambda r: tuple((x is not None, str(x)) for x in r))


@pytest.fixture(scope="module")
def project(spark, tmp_path_factory):
    p = tmp_path_factory.mktemp("projects")
    doc = {
        "observations": {
            "303_STM_sample": {"time offset": 10.0, "media_info": {"fps": {"a.avi": 25.0, "b.avi": 30.0}}, "events": [[1.5, "", "dig", 37], [4.0, "", "dig", 100], [2.0, "", "rear", ""], [9.0, "", "dig", None], ["bad", "", "rear", 3]]},
            "40_LTM_test": {"time offset": 0.0, "media_info": {"fps": {}}, "events": []},
        },
        "behaviors_conf": {"0": {"type": "State event", "code": "dig", "description": "digs"}, "1": {"type": "Point event", "code": "rear", "description": "r"}, "2": {"type": "other", "code": "odd", "description": ""}, "3": {"type": "State event", "code": "unused", "description": ""}},
    }
    (p / "one.json").write_text(json.dumps(doc, indent=1))
    return readers.scoring_projects(spark, str(p))


def test_marks_keep_place_and_offset(project, spark):
    m = events.marks(project)
    assert rows(m, "ord", "t_s", "label", "frame") == sorted([(0, 11.5, "dig", 37), (1, 14.0, "dig", 100), (2, 12.0, "rear", None), (3, 19.0, "dig", None), (4, None, "rear", 3)], key=lambda r: tuple((x is not None, str(x)) for x in r))
    aligned = spark.createDataFrame([("303_STM_sample", 100.0)], "observation_id string, aligned_start double")
    assert rows(events.marks(project, aligned).filter("ord = 0"), "t_s") == [(101.5,)]  # replaces the offset


def test_bouts_points_and_dangling_start(project):
    m, kinds = events.marks(project), events.behaviours(project)
    long = events.annotated_events(m.filter("t_s is not null"), kinds, ["observation_id"])
    assert rows(long, "label", "ord", "start_s", "duration_s") == [("dig", 1, 11.5, 2.5), ("rear", 1, 12.0, None)]
    states = m.filter("label = 'dig'")
    assert rows(events.unmatched_marks(states, ["label"], ["ord"], "t_s"), "label", "start") == [("dig", 19.0)]
    assert dict(rows(kinds, "label", "kind"))["odd"] is None


def test_marks_pair_in_array_order_not_time(spark):
    m = spark.createDataFrame([(0, 5.0), (1, 3.0)], "ord int, t_s double").withColumn("label", F.lit("x"))
    assert rows(events.state_bouts(m, ["label"], ["ord"], "t_s"), "start", "stop") == [(5.0, 3.0)]


def test_pairs_and_rejects_are_all_marks(spark):
    m = spark.createDataFrame([(k, i, float(i)) for k in range(5) for i in range(k + 3)], "label int, ord int, t_s double")
    n = 2 * events.state_bouts(m, ["label"], ["ord"], "t_s").count() + events.unmatched_marks(m, ["label"], ["ord"], "t_s").count()
    assert n == m.count()


def test_ragged_round_trip_keeps_unused_labels(project):
    m, kinds = events.marks(project).filter("t_s is not null"), events.behaviours(project).filter("kind is not null")
    long = events.annotated_events(m, kinds, ["observation_id"])
    labels = kinds.select("label", F.lit("303_STM_sample").alias("observation_id"))
    table = events.ragged(long, ["observation_id"], labels)
    assert rows(table, "label", F.size("event_times").alias("n")) == [("dig", 1), ("rear", 1), ("unused", 0)]
    assert rows(events.unragged(table, ["observation_id"]), "label", "ord", "start_s", "duration_s") == rows(long, "label", "ord", "start_s", "duration_s")


def test_media_rate(project):
    r = {x["observation_id"]: x for x in events.media_rate(project).collect()}
    assert (r["303_STM_sample"]["fps"], r["303_STM_sample"]["fps_differ"], r["40_LTM_test"]["fps"]) == (25.0, True, None)
    assert r["303_STM_sample"]["resolution"] == pytest.approx(0.04)


def test_object_info_and_enrichment(spark):
    sheet = spark.createDataFrame([("f", "STM", "Sample 1", "A", "nan", "NW", "novel", "cup"), ("f", "STM", "the test", "B", "x", "SE", "familiar", None)], "Filename string, test string, trial string, Obj_A string, Obj_B string, Pos_A string, ID_A string, ObjName_A string")
    info = events.object_info(sheet, ["Filename", "test"])
    assert rows(info, "trial_type", "label", "position", "novelty", "object") == [("sample", "A", "NW", "novel", "cup"), ("test", "B", "SE", "familiar", None), ("test", "x", None, None, None)]
    twice = spark.createDataFrame([("A", 1, "old"), ("A", 2, "new")], "label string, n int, object string")
    e = spark.createDataFrame([("A",), ("Z",)], "label string")
    out = events.enrich(e, twice, ["label"], ["object"], ["n"])
    assert rows(out, "label", "object") == [("A", "new"), ("Z", "")]
    assert events.labelled(out).count() == 1


def test_discrimination(spark):
    b = spark.createDataFrame([("s", "novel", 3.0, 1), ("s", "familiar", 1.0, 2), ("t", "other", 1.0, 1)], "k string, kind string, d double, n int")
    assert rows(analytics.discrimination_index(b, ["k"], "kind", "d"), "k", "di") == [("s", 0.5), ("t", None)]
    at = analytics.di_at(b.filter("k = 's'"), ["k"], ["n"], "kind", "d", 3.5)
    assert rows(at, "novel", "familiar") == [(3.0, 0.5)]
    assert analytics.di_at(b, ["k"], ["n"], "kind", "d", 99.0).count() == 0


def test_bins_clip_bouts_and_add_up(spark):
    b = spark.createDataFrame([("s", 5.0, 25.0), ("s", 30.0, 40.0), ("s", 40.0, 40.0)], "k string, start_s double, stop_s double")
    out = analytics.accumulated(b, ["k"], 10.0)
    assert rows(out, "bin", "seconds", "cumulative") == [(0, 5.0, 5.0), (1, 10.0, 15.0), (2, 5.0, 20.0), (3, 10.0, 30.0), (4, 0.0, 30.0)]


def test_raster_rounds_half_to_even_and_clips(spark):
    t = spark.createDataFrame([("a", 0.5, 2.5, 50.0), ("b", 1.5, 1.6, -3.0), ("c", 3.6, 9.0, 10.0)], "k string, a double, z double, p double")
    out = analytics.raster(t, ["k"], "a", "z", F.lit(6), "p")
    assert rows(out, "k", "second", "intensity", "n") == [("a", 0, 0.5, 1), ("a", 1, 0.5, 1), ("c", 4, 0.1, 1), ("c", 5, 0.1, 1)]
    marks = analytics.periodic_marks(spark.createDataFrame([(250,), (0,)], "e int"), "e")
    assert sorted(r["mark"] for r in marks.collect()) == [0, 100, 200]


def test_latency_and_phases(spark):
    e = spark.createDataFrame([("a", "catch", 7.0), ("a", "catch", 9.0), ("b", "look", 1.0)], "k string, label string, t double")
    assert rows(analytics.latency(e, ["k"], "label", "catch", F.col("t")), "k", "latency_s") == [("a", 7.0), ("b", 120.0)]
    b = spark.createDataFrame([(0, 10.0, 1.0), (1, 40.0, 2.0)], "bin int, v double, d double")
    ph = spark.createDataFrame([(0, "tone"), (1, "tone")], "bin int, phase string")
    assert rows(analytics.phase_means(b, ph, [], "v", "d", "bin"), "phase", "mean") == [("tone", 30.0)]


def write(path, text):
    path.write_text(text)
    return str(path)


def test_freeze_sheet(spark, tmp_path):
    sheet = write(tmp_path / "f.csv", "% freeze,b1,b2,x,y,z,empty\nOnset,0,60,Threshold,Bout,Protocol,\nDuration,30,30,,,,\n,,,,2.5,,\n303_a,10,nan,1.1,,p1,\n40_b,20,30,1.2,,p2,\n")
    df = readers.freeze_scores(spark, sheet)
    assert {len(r["c"]) for r in df.collect()} == {6}
    out = trials.freeze_trials(df).filter("row_no > 2")
    assert rows(out, "animal", "bin", "freezing", "start_s", "stop_s", "threshold", "bout_duration", "protocol") == [("303_a", 0, 10.0, 0.0, 30.0, "1.1", 2.5, "p1"), ("303_a", 1, None, 60.0, 90.0, "1.1", 2.5, "p1"), ("40_b", 0, 20.0, 0.0, 30.0, "1.2", 2.5, "p2"), ("40_b", 1, 30.0, 60.0, 90.0, "1.2", 2.5, "p2")]
    assert trials.freeze_trials(spark.createDataFrame([(0, "a", "b"), (2, "c", "1")], "row_no int, x string, y string")).count() == 0


def test_freeze_sheets_of_different_widths(spark, tmp_path):
    write(tmp_path / "a.csv", "% freeze,b1,t,d,p\nOnset,0,Threshold,B,P\nDuration,30,,,\n,,,2.5,\n1_a,10,1.1,,p1\n")
    write(tmp_path / "b.csv", ",% freeze,,b1,b2,b3,t,d,p\n,Onset,,5,60,90,Threshold,B,P\n,Duration,,30,30,30,,,\n,,,,,,,4,\n,2_b,,1,2,3,9,,p2\n")
    write(tmp_path / "c.csv", "name,b\nx,1\n")
    write(tmp_path / "d.csv", "\n \n")
    out = trials.freeze_trials(readers.freeze_scores(spark, str(tmp_path)), key=["path"]).filter("row_no > 2")
    assert rows(out, "animal", "bin", "freezing", "start_s", "bout_duration", "protocol") == [("1_a", 0, 10.0, 0.0, 2.5, "p1"), ("2_b", 0, 1.0, 5.0, 4.0, "p2"), ("2_b", 1, 2.0, 60.0, 4.0, "p2"), ("2_b", 2, 3.0, 90.0, 4.0, "p2")]
    bad = readers.freeze_rejects(spark, str(tmp_path)).collect()
    assert sorted((r["path"][-5:], r["reason"]) for r in bad) == [("c.csv", "no column % freeze"), ("d.csv", "empty sheet")]


def test_each_freeze_sheet_has_its_own_threshold(spark):
    cells = [("p", 0, "On", "0", "60", "Threshold", None), ("p", 1, "For", "30", "30", None, None), ("p", 2, None, None, None, None, "2.5"), ("p", 3, "m1", "10", "20", "1.1", None)]
    cells += [("q", 0, "On", "0", "Threshold", None, None), ("q", 1, "For", "5", None, None, None), ("q", 2, None, None, None, "4", None), ("q", 3, "m2", "70", "9", None, "p2")]
    df = spark.createDataFrame(cells, "path string, row_no int, a string, b string, c string, d string, e string")
    out = trials.freeze_trials(df, key=["path"]).filter("row_no > 2")
    assert rows(out, "path", "animal", "bin", "freezing", "start_s", "stop_s", "threshold", "bout_duration") == [("p", "m1", 0, 10.0, 0.0, 30.0, "1.1", 2.5), ("p", "m1", 1, 20.0, 60.0, 90.0, "1.1", 2.5), ("q", "m2", 0, 70.0, 0.0, 5.0, "9", 4.0)]


def test_a_label_is_a_state_in_one_project_and_a_point_in_another(spark):
    marks = spark.createDataFrame([("A", "o", 0, 1.0, "x"), ("A", "o", 1, 2.0, "x"), ("B", "o", 0, 10.0, "x"), ("B", "o", 1, 20.0, "x")], "path string, observation_id string, ord int, t_s double, label string")
    kinds = spark.createDataFrame([("A", "x", "state", ""), ("B", "x", "point", "")], "path string, label string, kind string, description string")
    out = events.annotated_events(marks, kinds, ["path", "observation_id"])
    assert rows(out, "path", "start_s", "duration_s") == [("A", 1.0, 1.0), ("B", 10.0, None), ("B", 20.0, None)]


def test_freeze_log_reads_two_formats(spark, tmp_path):
    p = write(tmp_path / "log.txt", "303\tx\t01/02/2023\t10:11\n40\t2023-02-01\t10:12:13\nbad\tx\ty\n")
    assert [str(r["ts"]) for r in readers.freeze_log(spark, p).orderBy("animal").collect()] == ["2023-02-01 10:11:00", "2023-02-01 10:12:13", "None"]


SWIM = "Animal,Date,Time,Day,Platform,Time to platform,Trial duration,Distance travelled (cm),Average speed,% time near walls,Platform Quadrant,Quadrant time (sec),,,,Quadrant time (%),,,,Time to platform,,,,Platform crossings,,,\n"


def test_swim_sheet_blocks_go_by_position(spark, tmp_path):
    line = lambda a, day, t: f"{a},{day},{t},1,P1,5.5,60,100,20,1.5,2.0," + ",".join(str(i) for i in range(1, 17)) + "\n"
    p = write(tmp_path / "w.csv", SWIM + line("WM 303", "01/02/2023", "10:00:00") + line("WM 303", "01/02/2023", "10:05:30") + line("WM 40", "02/02/2023", "09:00"))
    sheet, _ = readers.swim_sheet(spark, p)
    out = trials.timed(trials.of_animal(trials.swim_trials(sheet, ["path"]), "303"), ["path"])
    assert rows(out, "start_s", "stop_s", "platform_quadrant", "time_to_platform", "time_in_NE_quadrant", "percent_time_in_SE_quadrant", "time_to_platform_NE", "platform_crossings_SE", "zone_percent_time_NE") == [(0.0, 60.0, 2, 5.5, 1.0, 8.0, 9.0, 16.0, None), (330.0, 390.0, 2, 5.5, 1.0, 8.0, 9.0, 16.0, None)]
    assert trials.quadrants_long(out, ["row_no"]).count() == 8
    assert rows(trials.by_day(out, ["path"]), "day", "n_trials") == [(1, 2)]


def test_sheets_have_headers_of_their_own(spark, tmp_path):
    write(tmp_path / "a.csv", "Animal,Trial duration,Average speed\n1,60,7\n")
    write(tmp_path / "b.csv", "\ufeff" + ",".join(["x"] * 47) + ",Average speed,Trial duration,Animal,Platform\n\n" + "," * 47 + '8,61,"2, ""b""",\n')
    write(tmp_path / "c.csv", "A,B\n1,2\n")
    write(tmp_path / "d.csv", "\n")
    sheet, bad = readers.swim_sheet(spark, str(tmp_path))
    assert rows(trials.swim_trials(sheet, ["path"]), "animal", "trial_duration", "average_speed", "platform") == [("1", 60.0, 7.0, None), ('2, "b"', 61.0, 8.0, None)]
    assert sorted((r["path"][-5:], r["reason"]) for r in bad.collect()) == [("c.csv", "no column Animal"), ("d.csv", "empty sheet")]


@pytest.mark.parametrize("broadcast_up_to", [100_000, 0])
def test_lines_of_many_splits_keep_their_places(spark, tmp_path, monkeypatch, broadcast_up_to):
    monkeypatch.setattr(sheets, "SPLITS", broadcast_up_to)
    for name, n in (("a", 3000), ("b", 1), ("c", 700)):
        write(tmp_path / f"{name}.csv", f"Animal,n{name}\n" + "".join(f"{name}{i},{i}\n" + "\n" * (i % 3) for i in range(n)))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    try:
        read = sheets.rows(spark, str(tmp_path), n=lambda h: h[1])
        got = [(r["path"][-5], r["row_no"], r["c"][0], r["c"][1], r["n"]) for r in read.filter("row_no > 0").collect()]
        blocks = sheets.lines(spark, str(tmp_path)).select("path", "block").distinct().count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert blocks > 10
    assert sorted(got) == sorted((x, i + 1, f"{x}{i}", str(i), f"n{x}") for x, n in (("a", 3000), ("b", 1), ("c", 700)) for i in range(n))


def test_cells(spark):
    lines = ['a,b', '', ',', ',,x', '"a,b",c', '"a""b",', '"open,b', '"a"b,c', 'a"b,c', '"",""', '"x"', 'ü,"é,"']
    expected = [["a", "b"], [None], [None, None], [None, None, "x"], ["a,b", "c"], ['a"b', None], ['"open', "b"], ['"a"b', "c"], ['a"b', "c"], [None, None], ["x"], ["ü", "é,"]]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, x string")
    assert [r["c"] for r in df.select("i", sheets.cells(F.col("x")).alias("c")).orderBy("i").collect()] == expected
    tabs = df.select(sheets.cells(F.lit("a\t,\t"), "\t").alias("c")).first()["c"]
    assert tabs == ["a", ",", None]


def test_filled_places_of_wide_sheets(spark):
    wide = [None] * 200
    wide[0] = wide[61] = wide[62] = wide[199] = "x"
    df = spark.createDataFrame([("p", 0, ["h"] * 200), ("p", 1, wide), ("p", 2, ["y"]), ("q", 1, [None, "z"]), ("r", 1, [None])], "path string, row_no int, c array<string>")
    assert {r["path"]: r["kept"] for r in sheets.filled(df).collect()} == {"p": [0, 61, 62, 199], "q": [1]}


def test_zone_block_is_found_by_substring(spark, tmp_path):
    p = write(tmp_path / "z.csv", "Animal,Date,Time,Trial duration,Big Zone (% time) x,,,,,,,\n303,01/02/2023,10:00:00,60," + ",".join("12345678") + "\n")
    out = trials.swim_trials(readers.swim_sheet(spark, p)[0], ["path"])
    assert rows(out, "zone_percent_time_NE", "zone_percent_time_NW_A", "time_in_NE_quadrant", "platform") == [(1.0, 8.0, None, None)]


def test_pairs_by_position(spark):
    a = spark.createDataFrame([("s", 2, "b"), ("s", 1, "a")], "k string, n int, x string")
    b = spark.createDataFrame([("s", 10, "v")], "k string, m int, y string")
    assert rows(trials.paired_by_position(a, b, ["k"], ["n"], ["m"], "left"), "x", "y") == [("a", "v"), ("b", None)]


def test_days_pair_across_month_ends(spark):
    v = spark.createDataFrame([("s", "2023-01-31", "p1"), ("s", "2023-02-01", "p2"), ("s", "2023-02-10", "p3")], "k string, d string, path string").withColumn("d", F.to_date("d"))
    assert rows(discover.consecutive_days(v, ["k"], "d", ["path"]), "path", "next.path") == [("p1", "p2")]

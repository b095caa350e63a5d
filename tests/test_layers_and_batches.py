"""Deep merge, path templates, pyramids, graphs of foreign keys, batches and rejects on hand-written rows."""

import json
import random

import pytest
from pyspark.sql import functions as F

from burrowline.functions import merging
from burrowline.operators import events, graph, pyramid
from burrowline.plans import flows
from burrowline.sources import batches, readers, schemas, templates, writers


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=lambda r: tuple((x is not None, str(x)) for x in r))


# merging


def plain_merge(low, high):
    """The same rules on Python values."""
    if high is None:
        return low
    if low is None:
        return high
    if isinstance(low, dict):
        return {k: plain_merge(low.get(k), high.get(k)) for k in [*low, *(k for k in high if k not in low)]}
    if isinstance(low, list):
        out = list(low)
        for h in high:
            if isinstance(h, dict):
                at = [i for i, x in enumerate(out) if x["name"] == h["name"] and h["name"] is not None]
                for i in at:
                    out[i] = plain_merge(out[i], h)
                out += [] if at else [h]
            elif h not in out:
                out.append(h)
        return out
    return high


LAYER = "struct<a:int,s:struct<x:string,y:int>,m:map<string,struct<u:int,v:int>>,l:array<string>,d:array<struct<name:string,n:int,w:array<int>>>>"


def test_deep_merge_equals_the_plain_rules(spark):
    r = random.Random(1)
    some = lambda f: f() if r.random() < 0.7 else None
    device = lambda n: {"name": n, "n": some(lambda: r.randint(0, 9)), "w": some(lambda: sorted({r.randint(0, 3) for _ in range(2)}))}
    layer = lambda: some(lambda: {"a": some(lambda: r.randint(0, 9)), "s": some(lambda: {"x": some(lambda: r.choice("pq")), "y": some(lambda: r.randint(0, 9))}), "m": some(lambda: {k: {"u": some(lambda: 1), "v": some(lambda: r.randint(2, 9))} for k in r.sample("abc", 2)}), "l": some(lambda: r.sample(["i", "j", "k"], 2)), "d": some(lambda: [device(n) for n in r.sample("efgh", r.randint(0, 3))])})
    data = [(i, layer(), layer(), layer()) for i in range(80)]
    df = spark.createDataFrame(data, f"i int, one {LAYER}, two {LAYER}, three {LAYER}")
    out = merging.deep_merge(df, ["one", "two", "three"], "m").select("i", "m")
    as_plain = lambda x: x.asDict(recursive=True) if x is not None else None
    for row in out.collect():
        _, *layers = data[row["i"]]
        expected = None
        for x in layers:
            expected = plain_merge(expected, x)
        assert as_plain(row["m"]) == expected


def test_layers_may_lack_fields_and_widen_types(spark):
    df = spark.createDataFrame([((1, ("p",)), (2.5, None, "n"))], "a struct<n:int,s:struct<x:string>>, b struct<n:double,s:struct<y:int>,z:string>")
    out = merging.deep_merge(df, ["a", "b"], "m")
    assert out.first()["m"].asDict(recursive=True) == {"n": 2.5, "s": {"x": "p", "y": None}, "z": "n"}
    with pytest.raises(ValueError, match="disagree on what s is"):
        merging.deep_merge(spark.createDataFrame([((1,), (("x",),))], "a struct<s:int>, b struct<s:struct<t:string>>"), ["a", "b"], "m")


# templates


def test_templates(spark):
    paths = ["base/R_1/Recall/R_1_2020-01-02_10-11-12_Recall_2", "R_1/Recall/R_2_2020-01-02_10-11-12_x", "R/S/R_2020-02-31_10-11-12_x", "R/S/R_2020-02-03_25-11-12_x", "R/R_2020-01-02_10-11-12_x", None, "a/b/a_2020-01-02_10-11-12_x.y/"]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    found, bad = templates.expand(df, readers.RECORDING)
    assert rows(found, "subject_id", "session_id", F.col("session_date").cast("string").alias("d"), "session_time", "task") == [("R_1", "Recall", "2020-01-02", "10:11:12", "Recall_2")]
    assert rows(bad, "reason", "path") == sorted([("fields disagree", paths[1]), ("session_date is no date", paths[2]), ("session_time is no time", paths[3]), ("no match", paths[4]), ("no path", None), ("no match", paths[6])], key=lambda r: tuple((x is not None, str(x)) for x in r))
    own = templates.compiled("{line}/{cohort}_{task}/{trial:n}+{animal:int}.{ext}", {"n": templates.Kind("t[0-9]+", lambda c: F.substr(c, F.lit(2)).try_cast("int"))})
    found, bad = templates.expand(spark.createDataFrame([("L/c1_OLM/t3+40.avi",), ("L/c1_OLM/t3-40.avi",), ("L/c1_OLM/t99999999999+4.avi",)], "p string"), own, "p")
    assert rows(found, "line", "cohort", "task", "trial", "animal", "ext") == [("L", "c1", "OLM", 3, 40, "avi")]
    assert rows(bad, "reason") == [("no match",), ("trial is no n",)]
    for wrong in ("no fields", "{a:odd}", "{a}{b", "".join(f"{{f{i}}}" for i in range(10))):
        with pytest.raises(ValueError):
            templates.compiled(wrong)


# pyramid


def test_extents_of_windows_equal_a_full_scan(spark):
    r = random.Random(3)
    n, base = 700, 8
    value = lambda: r.choice([None, float("nan"), r.uniform(-9, 9), float(r.randint(-3, 3))])
    data = [(k, i, [value() for _ in range(3)]) for k in "ab" for i in range(n) if k == "a" or i % 5]
    df = spark.createDataFrame(data, "k string, sample_idx long, v array<double>")
    blocks = pyramid.build(df, ["k"], base=base, levels=3).cache()
    assert blocks.filter("level = 2").count() == 2 * 3  # one node of 256 blocks
    for first, last in ((0, n), (5, 6), (3, 3), (7, 9), (8, 16), (13, 402), (r.randint(0, n), n), (250, 699)):
        got = pyramid.extents(blocks, df, ["k"], first, last, base=base, levels=3)
        expected = {}
        for k, i, v in data:
            if first <= i < last:
                for c, x in enumerate(v):
                    if x is not None and x == x:
                        expected.setdefault((k, c), []).append(x)
        want = sorted((k, c, len(x), min(x), max(x), round(sum(x), 6)) for (k, c), x in expected.items())
        assert sorted((x["k"], x["channel"], x["n"], x["lo"], x["hi"], round(x["total"], 6)) for x in got.collect()) == want
        assert pyramid.edge_samples(df, first, last, base=base, levels=3).count() <= 2 * 2 * base
        if want:
            assert pyramid.display_offset(got).first()[0] == 2 * max(max(abs(w[3]), abs(w[4])) for w in want)


def test_edges_reach_the_scan(spark, tmp_path):
    spark.createDataFrame([("a", i, [1.0]) for i in range(50)], "k string, sample_idx long, v array<double>").write.parquet(str(tmp_path / "s"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        plan = pyramid.edge_samples(spark.read.parquet(str(tmp_path / "s")), 3, 45, base=8)._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(sample_idx,3)" in plan and "LessThan(sample_idx,45)" in plan and "PushedFilters: [Or(" in plan


# graph


def test_descendants_by_every_way(spark):
    r = random.Random(7)
    people = [(i, r.choice([None, *range(max(1, i - 4), i)]) if i > 1 else None) for i in range(1, 40)]
    orders = [(i, r.choice([None, *range(1, 40)]), r.randint(1, 10)) for i in range(60)]
    shops, notes = [(i,) for i in range(1, 11)], [(i, r.randint(0, 59)) for i in range(50)]
    t = {"note": spark.createDataFrame(notes, "n int, o int"), "people": spark.createDataFrame(people, "p int, boss int"), "orders": spark.createDataFrame(orders, "o int, p int, s int"), "shop": spark.createDataFrame(shops, "s int"), "alone": spark.createDataFrame([(1,)], "x int")}
    keys = {"note": ["n"], "people": ["p"], "orders": ["o"], "shop": ["s"], "alone": ["x"]}
    links = [graph.Link("note", "orders", {"o": "o"}), graph.Link("orders", "people", {"p": "p"}), graph.Link("orders", "shop", {"s": "s"}), graph.Link("people", "people", {"boss": "p"})]
    gone = {5, 11}
    while True:
        more = gone | {p for p, b in people if b in gone}
        if more == gone:
            break
        gone = more
    dead = {o for o, p, s in orders if p in gone or s == 3}
    cut = {n for n, o in notes if o in dead}
    seeds = {"people": "p IN (5, 11)", "shop": {"s": 3}}
    out, left = graph.restricted(t, keys, links, seeds), graph.remaining(t, keys, links, seeds)
    assert set(out) == {"note", "people", "orders", "shop"} and set(left) == set(t)
    for name, key, hit in (("people", "p", gone), ("orders", "o", dead), ("note", "n", cut), ("shop", "s", {3})):
        assert sorted(x[key] for x in out[name].collect()) == sorted(hit)
        assert sorted(x[key] for x in left[name].collect()) == sorted(x[key] for x in t[name].collect() if x[key] not in hit)
    assert graph.ordered(list(t), links).index("orders") > graph.ordered(list(t), links).index("shop")
    with pytest.raises(ValueError, match="go round"):
        graph.ordered(["a", "b"], [graph.Link("a", "b", {"x": "y"}), graph.Link("b", "a", {"x": "y"})])


# batches

KEY = "subject_id string, session_id string"


def seen(spark, folder):
    return [rows(batches.read(spark, folder, t, f"{KEY}, {c} int"), "subject_id", "session_id", c) for t, c in (("event", "n"), ("part", "m"))], rows(batches.rejects(spark, folder), "subject_id", "reason")


def test_batches_are_seen_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "c")
    f = lambda data, kind: spark.createDataFrame(data, f"{KEY}, {kind}")
    one = {"event": f([("a", "1", 1), ("a", "2", 2), ("x", "9", 0)], "n int"), "part": f([("a", "1", 5)], "m int")}
    keys = spark.createDataFrame([("a", "1"), ("a", "2")], KEY)
    assert seen(spark, folder) == ([[], []], [])
    assert batches.ingest(spark, folder, "b1", keys, one, f([("z", "1", "no_video")] * 2, "reason string"))
    first = seen(spark, folder)
    assert first == ([[("a", "1", 1), ("a", "2", 2)], [("a", "1", 5)]], [("z", "no_video")])
    assert not batches.ingest(spark, folder, "b1", keys, {"event": f([("a", "1", 77)], "n int")}, f([("y", "1", "late")], "reason string"))
    assert seen(spark, folder) == first

    two = {"event": f([("a", "1", 10), ("b", "1", 3)], "n int"), "part": f([("b", "1", 6)], "m int")}
    again, part, calls = spark.createDataFrame([("a", "1"), ("b", "1")], KEY), batches._part, []

    def failing(df, path):
        calls.append(path)
        if len(calls) == stop:
            raise RuntimeError("a fault between two tables")
        part(df, path)

    monkeypatch.setattr(batches, "_part", failing)
    for stop in (1, 2, 3, 4):
        calls.clear()
        with pytest.raises(RuntimeError):
            batches.ingest(spark, folder, "b2", again, two, f([("z", "1", "no_video"), ("q", "1", "none")], "reason string"))
        assert seen(spark, folder) == first
    monkeypatch.setattr(batches, "_part", part)
    assert batches.ingest(spark, folder, "b2", again, two, f([("z", "1", "no_video"), ("q", "1", "none")], "reason string"))
    # a-1 came again: its part is gone with it
    assert seen(spark, folder) == ([[("a", "1", 10), ("a", "2", 2), ("b", "1", 3)], [("b", "1", 6)]], [("q", "none"), ("z", "no_video")])
    batches.ingest(spark, folder, "b3", keys.limit(0), {}, removed=spark.createDataFrame([("b", "1")], KEY))
    assert seen(spark, folder)[0] == [[("a", "1", 10), ("a", "2", 2)], []]
    with pytest.raises(ValueError):
        batches.ingest(spark, folder, "b/4", keys, {})


def test_catalogue_batch(spark, tmp_path):
    f = lambda data, kind: spark.createDataFrame(data, f"{KEY}, {kind}")
    new = {"session": f([("a", "1", 2)], "version int"), "part": f([("a", "1", "p"), ("x", "1", "q")], "part string"), "electrode": f([("a", "1", 1, "LFP_g"), ("a", "1", 0, "EEG")], "electrode_id int, group_name string"), "signal": f([("a", "1", 0, [1.0, 2.0])], "sample_idx long, v array<double>"), "rate": f([("a", "1", 2000.0)], "rate double"), "event": f([("a", "1", "e")], "label string")}
    assert flows.catalogue_batch(spark, str(tmp_path / "c"), "one", new)
    assert rows(batches.read(spark, str(tmp_path / "c"), "lfp", f"{KEY}, v array<double>, electrode_ids array<int>"), "v", "electrode_ids") == [([2.0], [1])]
    assert rows(batches.read(spark, str(tmp_path / "c"), "part", f"{KEY}, part string"), "part") == [("p",)]


# rejects


def test_unreadable_projects_are_rejects(spark, tmp_path):
    whole = {"observations": {"o": {"time offset": 1.0, "events": [["1", "", "dig", "3"]]}}, "behaviors_conf": {}}
    (tmp_path / "a.json").write_text(json.dumps(whole, indent=1))
    (tmp_path / "b.json").write_text(json.dumps(whole)[:40])
    (tmp_path / "c.json").write_text('{"behaviors_conf": {}}')
    (tmp_path / "d.json").write_text("not a project")
    p = readers.scoring_projects(spark, str(tmp_path))
    assert rows(events.marks(p), "t_s", "label", "frame") == [(2.0, "dig", 3)]
    bad = readers.project_rejects(spark, str(tmp_path))
    assert sorted((r["path"][-6:], r["reason"]) for r in bad.collect()) == [("b.json", "unreadable project"), ("c.json", "no observations"), ("d.json", "unreadable project")]


def test_aligned_starts_go_by_project(spark):
    o = {"o": (5.0, ({},), [["1", "", "x", "0"]])}
    p = spark.createDataFrame([(o, {}, "p1"), (o, {}, "p2")], schemas.PROJECT + ", path string")
    starts = spark.createDataFrame([("p1", "o", 100.0), ("p2", "o", 200.0)], "path string, observation_id string, aligned_start double")
    assert rows(events.marks(p, starts), "path", "t_s") == [("p1", 101.0), ("p2", 201.0)]
    assert rows(events.marks(p, starts.filter("path = 'p2'")), "path", "t_s") == [("p1", 6.0), ("p2", 201.0)]


def test_rejects_are_logged_once(spark, tmp_path):
    df = spark.createDataFrame([("a", "1", 1, None), ("b", "1", 2, "none"), ("c", "1", 3, "none"), ("c", "1", 3, "none")], f"{KEY}, v int, reason string")
    for _ in range(2):
        writers.write_with_rejects(df, str(tmp_path / "t"), str(tmp_path / "r"))
    assert rows(spark.read.parquet(str(tmp_path / "r")), "subject_id", "reason") == [("b", "none"), ("c", "none")]
    writers.write_rejects(df.filter("reason IS NOT NULL").withColumn("v", F.col("v") + 1), str(tmp_path / "r"))
    assert spark.read.parquet(str(tmp_path / "r")).count() == 4
    assert not list(tmp_path.glob("t-pending-*")) and writers.finished(spark, str(tmp_path / "t")).count() == 1


def test_ids_within_ids_are_told(spark, tmp_path):
    marks = [["1", "", "A", "0"], ["3", "", "A", "9"]]
    observed = {"12_STM_sample": (0.0, ({},), marks), "112_STM_test": (0.0, ({},), marks)}
    projects = spark.createDataFrame([(observed, {"0": ("State event", "A", "")}, "c1", "p1")], schemas.PROJECT + ", cohort_id string, path string")
    sheet = spark.createDataFrame([("c1", "STM", "sample", "A", "NW", "novel", "cup")], "cohort_id string, test string, trial string, Obj_A string, Pos_A string, ID_A string, ObjName_A string")
    sessions = spark.createDataFrame([("c1-12", "OLM_STM", "c1", 12, "STM"), ("c1-112", "OLM_STM", "c1", 112, "STM")], f"{KEY}, cohort_id string, animal_id int, session_kind string")
    flows.object_sessions(sessions, projects, sheet, str(tmp_path / "s"), str(tmp_path / "r"))
    assert rows(spark.read.parquet(str(tmp_path / "s")), "subject_id", "observation_id", "ambiguous_match") == [("c1-112", "112_STM_test", True), ("c1-12", "112_STM_test", True), ("c1-12", "12_STM_sample", False)]

"""Block scans, the hierarchy of cells, sweeps and the substring index, against plain versions."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from burrowline.operators import analytics, discover, intervals, scans, signals, substrings


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=lambda r: tuple((x is not None, str(x)) for x in r))


@pytest.fixture(scope="module")
def lines(spark):
    """Lines of very different lengths, with bursts, ties, nulls, and a key that is null."""
    r = random.Random(4)
    out = []
    for k, n in (("long", 1500), ("short", 3), (None, 40), ("burst", 400), ("one", 1)):
        for i in range(n):
            at = r.randint(-500, 500) if k != "burst" else (7 if i < 380 else r.randint(0, 10**6))
            out.append((k, at, i, r.choice([None, r.randint(0, 9)])))
    return spark.createDataFrame(out, "k string, at long, i int, v int").repartition(5)


@pytest.mark.parametrize("per_block", [1, 7, 100, 10**6])
def test_scans_equal_windows(lines, per_block):
    order = ["at", "i"]
    w = Window.partitionBy("k").orderBy(*order)
    up = w.rowsBetween(Window.unboundedPreceding, 0)
    plain = lines.select("k", "i", F.last("v", ignorenulls=True).over(up).alias("l"), F.sum("v").over(up).alias("s"), F.lead("i").over(w).alias("n"), F.lag("at").over(w).alias("p"))
    b = scans.blocked(lines, ["k"], "at", per_block)
    out = scans.last_known(b, ["k"], order, "v", "l")
    out = scans.running_sum(out, ["k"], order, "v", "s")
    out = scans.neighbour(scans.neighbour(out, ["k"], order, ["i"], "nx"), ["k"], order, ["at"], "pv", ahead=False)
    assert rows(out.select("k", "i", "l", "s", F.col("nx.i").alias("n"), F.col("pv.at").alias("p")), "k", "i", "l", "s", "n", "p") == rows(plain, "k", "i", "l", "s", "n", "p")


def test_a_long_line_is_the_work_of_many_tasks(spark):
    line = spark.range(0, 200_000, 1, 8).select(F.lit("x").alias("k"), F.col("id").alias("at"), (F.col("id") % 3).alias("v"))
    conf = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        out = scans.running_sum(line, ["k"], ["at"], "v", "s", per_block=2000)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        last = out.filter("at = 199999").first()["s"]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", conf)
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert last == sum(i % 3 for i in range(200_000))
    assert len(sizes) >= 12 and max(sizes) < 40_000


def test_steps_and_edges_in_small_blocks(spark):
    r = random.Random(8)
    ttl = spark.createDataFrame([("a", r.randint(0, 300), i, r.randint(0, 1)) for i in range(120)] + [("b", 5, 0, 1)], "k string, at long, i int, state int")
    for out in (lambda n: signals.step_intervals(ttl, ["k"], "at", "state", ["i"], n), lambda n: signals.edges(ttl, ["k"], "at", "state", ["i"], per_block=n), lambda n: signals.dense_steps(spark.createDataFrame([("a", t) for t in range(0, 320, 7)] + [("b", 4), ("b", 5), ("c", 1)], "k string, at long"), ttl, ["k"], "at", "state", ["i"], n)):
        small, whole = out(10), out(10**6)
        assert rows(small, *small.columns) == rows(whole, *whole.columns)


# nodes


def test_nodes_tile_an_interval(spark):
    r = random.Random(1)
    spans = [(0, 0), (5, 3), (0, 1), (-1, 1), (0, 16), (1, 17), (-300, 513), (0, 4096), (3, 3 + 16**4), (None, 3), (3, None)]
    spans += [((a := r.randint(-(10**4), 10**4)), a + r.randint(0, 3000)) for _ in range(60)]
    for top in (0, 1, 2, intervals.TOP):
        df = spark.createDataFrame([(i, *s) for i, s in enumerate(spans)], "i int, lo long, hi long").select("i", intervals.nodes(F.col("lo"), F.col("hi"), top).alias("n"))
        for i, found in ((x["i"], x["n"]) for x in df.collect()):
            lo, hi = spans[i]
            if lo is None or hi is None:
                assert not found
                continue
            cells = sorted(c for n in found for c in range(n["node"] << 4 * n["level"], (n["node"] + 1) << 4 * n["level"]))
            assert cells == list(range(lo, hi))
            assert sorted((n["level"], n["node"]) for n in found) == sorted((k, x) for k, a, z in intervals.cover(lo, hi, top) for x in range(a, z))
            if top == intervals.TOP:
                assert len(found) <= 30 * max(1, (max(hi - lo, 1)).bit_length() // 4 + 1)


def joined(pts, iv, closed):
    hit = [(x[1], y[1]) for x in pts for y in iv if x[0] == y[0] and y[2] <= x[2] and (x[2] <= y[3] if closed else x[2] < y[3])]
    return sorted(hit, key=lambda t: tuple((True, str(c)) for c in t))


@pytest.mark.parametrize("closed", [False, True])
def test_mixed_lengths_join_as_a_nested_loop(spark, closed):
    r = random.Random(3)
    pts = [(r.choice("ab"), i, r.randint(-(10**6), 10**9)) for i in range(300)]
    iv = [(k, i, t + d, t + d + r.choice([0, 1, 1, 1000, 10**6, 10**9])) for i, (k, _, t) in enumerate(pts) for d in (0, -1, 1)]
    p = spark.createDataFrame(pts, "k string, p long, t long")
    for widest, part in ((None, iv), (1 << 28, iv), (5000, [x for x in iv if x[3] - x[2] <= 10**6])):
        v = spark.createDataFrame(part, "k string, i long, a long, z long")
        assert rows(intervals.interval_join(p, v, ["k"], "t", "a", "z", closed, widest=widest), "p", "i") == joined(pts, part, closed)


def test_fractions_and_cells(spark):
    r = random.Random(9)
    pts = [("k", i, r.choice([0.5, 1.0, 1.5, -2.25, r.uniform(-5, 5)])) for i in range(120)]
    iv = [("k", i, (a := r.choice([0.5, 1.0, -2.25, r.uniform(-5, 5)])), a + r.choice([0.0, 0.5, 3.25])) for i in range(80)]
    p, v = spark.createDataFrame(pts, "k string, p long, t double"), spark.createDataFrame(iv, "k string, i long, a double, z double")
    for closed in (False, True):
        for cell in (0.001, 1, 2.5):
            assert rows(intervals.interval_join(p, v, ["k"], "t", "a", "z", closed, cell), "p", "i") == joined(pts, iv, closed)


# sweeps


def test_runs_of_bins_equal_exploded_bins(spark):
    r = random.Random(6)
    b = [(r.choice("ab"), (a := r.choice([r.uniform(0, 100), float(r.randint(0, 10) * 10)])), a + r.choice([0.0, 10.0, 35.5, r.uniform(0, 200)])) for _ in range(60)] + [("far", 5.0, 6.0), ("far", 1e7, 1e7 + 1), ("c", None, 1.0)]
    df = spark.createDataFrame(b, "k string, start_s double, stop_s double")
    last = F.greatest(F.ceil(F.col("stop_s") / 10) - 1, F.floor(F.col("start_s") / 10))
    cut = df.withColumn("bin", F.explode(F.sequence(F.floor(F.col("start_s") / 10), last))).withColumn("s", F.least("stop_s", (F.col("bin") + 1) * 10) - F.greatest("start_s", F.col("bin") * 10))
    g = cut.groupBy("k", "bin").agg(F.sum("s").alias("s"))
    plain = g.select("k", "bin", F.round("s", 6).alias("s"), F.round(F.sum("s").over(Window.partitionBy("k").orderBy("bin")), 6).alias("c"))
    out = analytics.accumulated(df, ["k"], 10.0)
    assert rows(out.select("k", "bin", F.round("seconds", 6).alias("s"), F.round("cumulative", 6).alias("c")), "k", "bin", "s", "c") == rows(plain, "k", "bin", "s", "c")
    one = spark.createDataFrame([("x", 3.0, 1e9)], "k string, start_s double, stop_s double")
    assert analytics.bin_runs(one, ["k"], 1.0).count() <= 4  # a long bout is a few runs


def test_raster_runs_equal_exploded_seconds(spark):
    r = random.Random(5)
    t = [(r.choice("ab"), r.uniform(-2, 50), r.uniform(0, 60), r.choice([10.0, 20.0, -1.0, None])) for _ in range(80)]
    df = spark.createDataFrame(t, "k string, a double, z double, p double")
    x, y = F.rint("a").cast("long"), F.least(F.rint("z").cast("long"), F.lit(40).cast("long"))
    each = df.filter(y > x).select("k", F.when(F.col("p") > 0, F.col("p") / 100).otherwise(0.0).alias("intensity"), F.explode(F.sequence(x, y - 1)).alias("second"))
    assert rows(analytics.raster(df, ["k"], "a", "z", F.lit(40), "p"), "k", "second", "n", "intensity") == rows(each.groupBy("k", "second", "intensity").agg(F.count("*").alias("n")), "k", "second", "n", "intensity")


# names


@pytest.fixture(scope="module")
def named(spark):
    r = random.Random(2)
    text = lambda n: "".join(r.choice("0123_a") for _ in range(n))
    names = [(r.choice("xy"), text(r.randint(0, 30))) for _ in range(400)] + [("x", None), ("x", ""), (None, "abc"), ("y", "ü0é_")] + [("x", "aaaaaaaaaaaaaaaa")] * 3
    pats = [(r.choice("xy"), text(r.randint(1, 12))) for _ in range(200)] + [("x", ""), ("y", None), ("x", "aaaaaaaaa"), ("y", "é_"), ("y", "ü0é_"), ("z", "a")] + [("x", n[3:14]) for b, n in names[:60] if n and b == "x"]
    return names, pats, spark.createDataFrame(names, "b string, name string"), spark.createDataFrame(pats, "b string, p string")


@pytest.mark.parametrize("q", [1, 3, 6, 40])
def test_index_finds_what_contains_finds(named, q):
    names, pats, n, p = named
    expected = sorted({(b, x, y) for b, x in names for c, y in pats if b == c and b is not None and x is not None and y is not None and y in x}, key=lambda r: tuple((v is not None, str(v)) for v in r))
    assert rows(substrings.containing(n, p, ["b"], "name", "p", q), "b", "name", "p") == expected
    pairs = substrings.candidates(n, p, ["b"], "name", "p", q).count()
    assert pairs >= len([e for e in expected if e[2]])


def test_candidates_are_few(spark):
    """20,000 names and 2,000 ids in one block: 40 million pairs, of which the index looks at those that match."""
    names = spark.range(20_000).select(F.lit("b").alias("b"), F.concat(F.lit("cam"), F.xxhash64("id").cast("string"), F.lit("_2023.avi")).alias("name"))
    ids = spark.range(2_000).select(F.lit("b").alias("b"), (F.col("id") + 10_000).cast("string").alias("p"))
    found = substrings.containing(names, ids, ["b"], "name", "p")
    n = found.count()
    assert n == substrings.candidates(names, ids, ["b"], "name", "p").count()
    held = {}
    for r in names.collect():
        for i in range(len(r["name"]) - 4):
            part = r["name"][i : i + 5]
            if part.isdigit() and 10_000 <= int(part) < 12_000:
                held.setdefault(r["name"], set()).add(part)
    assert n == sum(map(len, held.values()))
    long = ids.select("b", F.concat("p", F.lit("_2023.avi")).alias("p"))
    assert substrings.candidates(names, long, ["b"], "name", "p").count() < 40_000


def test_no_patterns_and_no_names(named):
    _, _, n, p = named
    assert substrings.containing(n, p.limit(0), ["b"], "name", "p").count() == 0
    assert substrings.containing(n.limit(0), p, ["b"], "name", "p").count() == 0


def test_ambiguous_names(spark):
    files = spark.createDataFrame([("d", "x_408_40.avi"), ("d", "x_9.avi"), ("d", "cage7.avi")], "dir string, name string")
    ids = spark.createDataFrame([("d", 40), ("d", 408), ("d", 9)], "dir string, id int")
    hit = discover.match_names(ids.withColumnRenamed("id", "animal"), files, ["dir"], ["dir", "animal"], [F.col("animal")])
    out = discover.ambiguous(hit, ids, ["dir"], "animal", "id")
    assert rows(out, "animal", "name", "ambiguous_match") == [(40, "x_408_40.avi", True), (408, "x_408_40.avi", True), (9, "x_9.avi", False)]

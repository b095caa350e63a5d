"""What a review of the fourth round found."""

import random

from pyspark.sql import functions as F

from burrowline.operators import discover, products

plain = lambda df: sorted(map(repr, map(tuple, df.collect())))


def made(spark):
    """Folders with many, one and no sessions or files, without a name, and with rows that are equal."""
    r = random.Random(7)
    s = [(i, r.choice(["a", "a", "a", "b", "none", None])) for i in range(120)] + [(3, "a"), (3, "a"), (500, "one")]
    f = [(r.choice(["a", "a", "b", "idle", None]), f"n{i % 50}", i % 3) for i in range(150)] + [("a", None, 1), ("one", "x", None)]
    return spark.createDataFrame(s, "id int, dir string"), spark.createDataFrame(f, "dir string, name string, size int")


def test_a_product_by_lots_equals_the_join(spark, monkeypatch):
    """also where a key has several deals and lots, whose last ones aren't full."""
    s, f = made(spark)
    joined = s.join(f, "dir", "left")
    for lot, deal, pairs in ((4, 7, 50), (1000, 1000, 50), (1, 1, 1000), (4, 7, 1 << 40)):
        for name, size in (("LOT", lot), ("DEAL", deal), ("TASK_PAIRS", pairs)):
            monkeypatch.setattr(products, name, size)
        found = discover.with_folder(s, f)
        assert found.columns == joined.columns and found.dtypes == joined.dtypes
        assert plain(found) == plain(joined)


def test_a_large_product_is_many_tasks_work(spark, monkeypatch):
    """one folder of a small table was one task's work, and its names came in the order of the sessions' table."""
    monkeypatch.setattr(products, "LOT", 16)
    monkeypatch.setattr(products, "DEAL", 16)
    monkeypatch.setattr(products, "TASK_PAIRS", 256)
    s = spark.createDataFrame([(i, "a") for i in range(200)], "id int, dir string").coalesce(1)
    f = spark.createDataFrame([("a", f"n{i}") for i in range(100)], "dir string, name string").coalesce(1)
    found = discover.with_folder(s, f)
    tasks = found.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()
    assert len(tasks) > 20 and max(t["n"] for t in tasks) < 0.2 * 20000 and sum(t["n"] for t in tasks) == 20000


def test_matches_are_counted_before_they_are_attached(spark, monkeypatch):
    """no window or sort stands over the product; keys of several rows, without a pattern and without a match keep their reason."""
    monkeypatch.setattr(products, "TASK_PAIRS", 100)
    s = [("l", i, f"WM_{i % 7}_x") for i in range(60)] + [("l", 1, "WM_2_x"), ("l", 1, "WM_2_x"), ("m", 90, "WM_5_x"), ("m", 91, "WM"), ("m", 92, None), (None, 93, "WM_1_x"), ("l", 94, "WM_99_x"), ("m", 95, "WM__x")]
    f = [("l", f"a{i}") for i in range(40)] + [("l", "a13"), ("m", "a5"), ("m", None), (None, "a1")]
    sessions, files = spark.createDataFrame(s, "line string, id int, session string"), spark.createDataFrame(f, "line string, name string")
    held = [(line, i, x, n) for line, i, x in s for n in [n for b, n in f if n and x and line and b == line and len(x.split("_")) > 1 and x.split("_")[1] in n] or [None]]
    n_of = {i: sum(1 for h in held if h[1] == i and h[3]) for _, i, _, _ in held}
    reason = lambda n: "none" if n == 0 else "multiple" if n > 1 else None
    found = discover.match_second_token(sessions, files, ["line"], ["id"])
    assert plain(found.select("line", "id", "session", "name", "reason")) == sorted(repr((*h, reason(n_of[h[1]]))) for h in held)
    assert {reason(n) for n in n_of.values()} == {"none", "multiple", None}
    above = found._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
    assert "Window" not in above and "Generate inline" in above

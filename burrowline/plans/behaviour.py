"""Queries on bouts, events and measures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from burrowline.operators import analytics, discover, signals, trials
from burrowline.operators import events as ev
from burrowline.plans.base import EV, events, query, r4, table

SUBJECT = ["user_id", "event_type"]
BOUTS = f"""(SELECT user_id, event_type, CAST((n + 1) / 2 AS INT) AS bout, us AS start, nxt AS stop FROM (
  SELECT *, row_number() OVER w AS n, lead(us) OVER w AS nxt FROM {EV} WINDOW w AS (PARTITION BY user_id, event_type ORDER BY us, event_id)) WHERE n % 2 = 1 AND nxt IS NOT NULL)"""


def bouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.state_bouts(events(spark, sf_dir), SUBJECT, ["us", "event_id"], "us")


@query(f"SELECT user_id, event_type, count(*) AS n_bouts, round(sum(stop - start) / 1e6, 4) AS total_s, round(max(stop - start) / 1e6, 4) AS longest_s FROM {BOUTS} GROUP BY ALL")
def state_event_bouts(spark, sf_dir):
    """How long each subject spent in each behaviour."""
    d = F.col("stop") - F.col("start")
    return bouts(spark, sf_dir).groupBy(*SUBJECT).agg(F.count("*").alias("n_bouts"), r4(F.sum(d) / 1e6).alias("total_s"), r4(F.max(d) / 1e6).alias("longest_s"))


@query(f"SELECT user_id, event_type, n AS n_marks, us AS start FROM (SELECT *, row_number() OVER w AS n, lead(us) OVER w AS nxt FROM {EV} WINDOW w AS (PARTITION BY user_id, event_type ORDER BY us, event_id)) WHERE n % 2 = 1 AND nxt IS NULL")
def state_event_unmatched(spark, sf_dir):
    """Starts without a stop."""
    return ev.unmatched_marks(events(spark, sf_dir), SUBJECT, ["us", "event_id"], "us").withColumn("n_marks", F.col("n_marks").cast("long"))


@query(f"SELECT user_id, event_type, count(*) AS n_events, min(us) AS first_us, max(us) AS last_us, string_agg(CAST(us AS VARCHAR), ',' ORDER BY us, event_id) AS times FROM {EV} GROUP BY ALL")
def ragged_event_table(spark, sf_dir):
    """A13, R8."""
    rows = events(spark, sf_dir).select("user_id", F.col("event_type").alias("label"), F.struct("us", "event_id").alias("ord"), F.col("us").alias("start_s"), F.lit(None).cast("double").alias("duration_s"))
    t = F.col("event_times")
    return ev.ragged(rows, ["user_id"]).select("user_id", F.col("label").alias("event_type"), F.size(t).cast("long").alias("n_events"), F.array_min(t).alias("first_us"), F.array_max(t).alias("last_us"), F.array_join(t.cast("array<string>"), ",").alias("times"))


@query(f"""WITH f AS (SELECT user_id, CAST(ts AS DATE) AS d, min(us) OVER (PARTITION BY user_id, CAST(ts AS DATE)) AS u0, us, event_id, value FROM {EV})
SELECT user_id, event_id, round((us - u0) / 1e6, 6) AS start_s, round((us - u0) / 1e6 + value, 6) AS stop_s FROM f""")
def trial_relative_times(spark, sf_dir):
    """Trials of a subject's day, timed from the day's first."""
    from burrowline.operators.align import relative_to_first, with_stop

    rows = events(spark, sf_dir).withColumn("day", F.to_date("ts"))
    out = with_stop(relative_to_first(rows, ["user_id", "day"], ["us", "event_id"], "ts"), "start_s", "value")
    return out.select("user_id", "event_id", F.round("start_s", 6).alias("start_s"), F.round("stop_s", 6).alias("stop_s"))


@query(f"""WITH g AS (SELECT user_id, coalesce(sum((stop - start) / 1e6) FILTER (event_type = 'click'), 0) AS novel, coalesce(sum((stop - start) / 1e6) FILTER (event_type = 'view'), 0) AS familiar FROM {BOUTS} GROUP BY user_id)
SELECT user_id, round(novel, 4) AS novel, round(familiar, 4) AS familiar, round((novel - familiar) / nullif(novel + familiar, 0), 4) AS di FROM g""")
def discrimination_index(spark, sf_dir):
    """A17."""
    rows = bouts(spark, sf_dir).withColumn("seconds", (F.col("stop") - F.col("start")) / 1e6)
    out = analytics.discrimination_index(rows, ["user_id"], "event_type", "seconds", "click", "view")
    return out.select("user_id", *[r4(F.col(c)).alias(c) for c in ("novel", "familiar", "di")])


@query(f"""WITH b AS (SELECT user_id, start / 1e6 AS a, stop / 1e6 AS z FROM {BOUTS} WHERE event_type = 'view'),
c AS (SELECT user_id, a, z, unnest(generate_series(CAST(floor(a / 86400) AS BIGINT), CAST(greatest(ceil(z / 86400) - 1, floor(a / 86400)) AS BIGINT))) AS bin FROM b),
g AS (SELECT user_id, bin, sum(least(z, (bin + 1) * 86400) - greatest(a, bin * 86400)) AS s FROM c GROUP BY ALL)
SELECT user_id, bin, round(s, 3) AS seconds, round(sum(s) OVER (PARTITION BY user_id ORDER BY bin), 3) AS cumulative FROM g""")
def accumulating_bins(spark, sf_dir):
    """Seconds of a behaviour in each day, and so far."""
    b = bouts(spark, sf_dir).filter("event_type = 'view'").select("user_id", (F.col("start") / 1e6).alias("start_s"), (F.col("stop") / 1e6).alias("stop_s"))
    out = analytics.accumulated(b, ["user_id"], 86400)
    return out.select("user_id", "bin", F.round("seconds", 3).alias("seconds"), F.round("cumulative", 3).alias("cumulative"))


@query("""WITH e AS (SELECT *, sum(value) OVER w AS c, sum(CASE WHEN event_type = 'click' THEN value ELSE 0 END) OVER w AS n, sum(CASE WHEN event_type = 'view' THEN value ELSE 0 END) OVER w AS f
  FROM events WHERE event_type IN ('click', 'view') WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)),
h AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM e WHERE c >= 100),
x AS (SELECT user_id, event_id, n - CASE WHEN event_type = 'click' THEN c - 100 ELSE 0 END AS n, f - CASE WHEN event_type = 'view' THEN c - 100 ELSE 0 END AS f FROM h WHERE k = 1)
SELECT user_id, event_id, round(n, 4) AS novel, round(f, 4) AS familiar, round((n - f) / nullif(n + f, 0), 4) AS di FROM x""")
def di_at_threshold(spark, sf_dir):
    """A19."""
    rows = events(spark, sf_dir).filter(F.col("event_type").isin("click", "view"))
    out = analytics.di_at(rows, ["user_id"], ["us", "event_id"], "event_type", "value", 100.0, "click", "view")
    return out.select("user_id", "event_id", *[r4(F.col(c)).alias(c) for c in ("novel", "familiar", "di")])


@query(f"""WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, us, event_type, min(us) OVER (PARTITION BY user_id, CAST(ts AS DATE)) AS u0 FROM {EV})
SELECT user_id, CAST(day AS VARCHAR) AS day, round(coalesce(min((us - u0) / 1e6) FILTER (event_type = 'purchase'), 120.0), 4) AS latency_s FROM d GROUP BY ALL""")
def latency_with_default(spark, sf_dir):
    """A20."""
    from burrowline.operators.align import relative_to_first

    rows = relative_to_first(events(spark, sf_dir).withColumn("day", F.to_date("ts")), ["user_id", "day"], ["us", "event_id"], "ts", "since")
    out = analytics.latency(rows, ["user_id", "day"], "event_type", "purchase", F.col("since"))
    return out.select("user_id", F.col("day").cast("string").alias("day"), r4(F.col("latency_s")).alias("latency_s"))


@query("""WITH p(part_of_day, phase) AS (VALUES (0, 'baseline'), (1, 'tone'), (2, 'inter-tone'), (3, 'tone')),
b AS (SELECT user_id, phase, value, CAST(json_extract_string(props, '$.k') AS INT) + 1 AS dur FROM events JOIN p ON part_of_day = CAST(floor(extract('hour' FROM ts) / 6) AS INT))
SELECT user_id, phase, round(sum(value * dur) / sum(dur), 4) AS mean FROM b GROUP BY ALL""")
def phase_weighted_mean(spark, sf_dir):
    """A21."""
    phases = spark.createDataFrame([(0, "baseline"), (1, "tone"), (2, "inter-tone"), (3, "tone")], "part_of_day int, phase string")
    e = events(spark, sf_dir).withColumns({"part_of_day": F.floor(F.hour("ts") / 6).cast("int"), "dur": F.get_json_object("props", "$.k").try_cast("int") + 1})
    return analytics.phase_means(e, phases, ["user_id"], "value", "dur", "part_of_day").select("user_id", "phase", r4(F.col("mean")).alias("mean"))


@query(f"""WITH x AS (SELECT user_id, min(us) AS u0, CAST(ceil((max(us) - min(us)) / 3.6e9) AS BIGINT) AS len FROM {EV} GROUP BY user_id),
b AS (SELECT user_id, bout, len, (start - u0) / 3.6e9 AS a, (stop - u0) / 3.6e9 AS z FROM {BOUTS} JOIN x USING (user_id) WHERE event_type = 'error'),
r AS (SELECT *, CAST(round_even(a, 0) AS BIGINT) AS x, least(CAST(round_even(z, 0) AS BIGINT), len) AS y FROM b),
s AS (SELECT user_id, bout, unnest(generate_series(x, y - 1)) AS second FROM r WHERE y > x)
SELECT user_id, second, count(*) AS n, CAST(0.5 AS DOUBLE) AS intensity FROM s GROUP BY ALL""")
def second_raster(spark, sf_dir):
    """One row per hour that a bout covers, within the subject's own session (the hour stands for the second)."""
    length = F.ceil((F.max("us") - F.min("us")) / 3.6e9).cast("long")
    session = events(spark, sf_dir).groupBy("user_id").agg(F.min("us").alias("u0"), length.alias("len"))
    b = bouts(spark, sf_dir).filter("event_type = 'error'").join(session, "user_id")
    b = b.select("user_id", "bout", "len", ((F.col("start") - F.col("u0")) / 3.6e9).alias("a"), ((F.col("stop") - F.col("u0")) / 3.6e9).alias("z"), F.lit(50.0).alias("pct"))
    out = analytics.raster(b, ["user_id"], "a", "z", F.col("len"), "pct")
    return out.select("user_id", "second", "n", "intensity")


@query("WITH m AS (SELECT user_id, date_diff('second', TIMESTAMP '2024-01-01', max(ts)) AS e FROM events GROUP BY user_id) SELECT user_id, unnest(generate_series(0, e - 1, 21600)) AS mark FROM m WHERE e > 0")
def periodic_marks(spark, sf_dir):
    """R12."""
    ext = events(spark, sf_dir).groupBy("user_id").agg((F.floor(F.max("us") / 1000000) - 1704067200).alias("e"))
    return analytics.periodic_marks(ext, "e", 21600).select("user_id", "mark")


@query("SELECT l_returnflag, round(coalesce(sum(l_quantity) FILTER (l_linestatus = 'F'), NULL), 2) AS F, round(sum(l_quantity) FILTER (l_linestatus = 'O'), 2) AS O FROM lineitem GROUP BY l_returnflag")
def pivot_heatmap(spark, sf_dir):
    """A16."""
    out = analytics.heat_map(table(spark, sf_dir, "lineitem"), "l_returnflag", "l_linestatus", "l_quantity", ["F", "O"])
    return out.select("l_returnflag", F.round("F", 2).alias("F"), F.round("O", 2).alias("O"))


@query("""WITH o AS (SELECT o_custkey % 150 AS k, o_orderkey, row_number() OVER (PARTITION BY o_custkey % 150 ORDER BY o_orderdate, o_orderkey) AS nth FROM orders),
e AS (SELECT user_id AS k, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nth FROM events)
SELECT k, nth, o_orderkey, event_id, CASE WHEN event_id IS NULL THEN 'no partner' END AS reason FROM o LEFT JOIN e USING (k, nth)""")
def positional_pairing(spark, sf_dir):
    """The n-th trial with the n-th video."""
    o = table(spark, sf_dir, "orders").withColumn("k", F.col("o_custkey") % 150)
    e = table(spark, sf_dir, "events").withColumn("k", F.col("user_id"))
    out = trials.paired_by_position(o.select("k", "o_orderdate", "o_orderkey"), e.select("k", "ts", "event_id"), ["k"], ["o_orderdate", "o_orderkey"], ["ts", "event_id"], "left")
    return out.select("k", F.col("nth").cast("long").alias("nth"), "o_orderkey", "event_id", F.when(F.col("event_id").isNull(), "no partner").alias("reason"))


@query(f"""SELECT b.user_id, b.bout, count(*) AS n_inside, round(sum(e.value), 4) AS value FROM {BOUTS} b JOIN {EV} e ON e.user_id = b.user_id AND e.us >= b.start AND e.us < b.stop
WHERE b.event_type = 'purchase' AND e.event_type <> 'purchase' GROUP BY ALL""")
def interval_contains_join(spark, sf_dir):
    """Events inside bouts of another behaviour."""
    b = bouts(spark, sf_dir).filter("event_type = 'purchase'").select("user_id", "bout", "start", "stop")
    e = events(spark, sf_dir).filter("event_type <> 'purchase'").select("user_id", "us", "value")
    out = signals.interval_join(e, b, ["user_id"], "us", "start", "stop")
    return out.groupBy("user_id", "bout").agg(F.count("*").alias("n_inside"), r4(F.sum("value")).alias("value"))


@query(f"""WITH i AS (SELECT user_id, event_id AS interval_id, us AS start, us + CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 1000 WHEN 'error' THEN CAST(floor(value * 1000) AS BIGINT) * 3600000 ELSE 600000000 END AS stop FROM {EV})
SELECT i.user_id, interval_id, count(*) AS n_inside, min(e.event_id) AS first_event, max(e.us) AS last_us FROM i JOIN {EV} e ON e.user_id = i.user_id AND e.us >= i.start AND e.us < i.stop GROUP BY ALL""")
def mixed_interval_join(spark, sf_dir):
    """Events inside intervals of a microsecond up to days, in one join."""
    e = events(spark, sf_dir)
    kind, length = F.col("event_type"), F.floor(F.col("value") * 1000) * 3600000
    stop = F.col("us") + F.when(kind == "click", 1).when(kind == "view", 1000).when(kind == "error", length).otherwise(600000000)
    i = e.select("user_id", F.col("event_id").alias("interval_id"), F.col("us").alias("start"), stop.alias("stop"))
    out = signals.interval_join(e.select("user_id", "event_id", "us"), i, ["user_id"], "us", "start", "stop")
    return out.groupBy("user_id", "interval_id").agg(F.count("*").alias("n_inside"), F.min("event_id").alias("first_event"), F.max("us").alias("last_us"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS frame, event_type AS label, round(epoch_us(ts) / 1e6, 3) AS t_s FROM events")
def json_event_fields(spark, sf_dir):
    """Fields of the scoring records, as scoring_project_marks has them for whole projects."""
    e = events(spark, sf_dir)
    return e.select("event_id", F.from_json("props", "k int")["k"].alias("frame"), F.col("event_type").alias("label"), F.round(F.col("us") / 1e6, 3).alias("t_s"))


@query("""WITH c AS (SELECT conv_id, turn, role, length(text) AS n, lead(role) OVER w AS reply_role, lead(length(text)) OVER w AS reply_n, row_number() OVER w AS k FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
SELECT conv_id, CAST((k + 1) / 2 AS INT) AS pair, role, reply_role, CAST(n AS BIGINT) AS n, CAST(reply_n AS BIGINT) AS reply_n FROM c WHERE k % 2 = 1 AND reply_n IS NOT NULL""")
def conversation_turn_pairs(spark, sf_dir):
    """Turns paired as start and stop marks are."""
    c = table(spark, sf_dir, "conversations").withColumn("mark", F.struct("role", F.length("text").cast("long").alias("n")))
    out = ev.state_bouts(c, ["conv_id"], ["turn"], "mark")
    return out.select("conv_id", F.col("bout").alias("pair"), F.col("start.role").alias("role"), F.col("stop.role").alias("reply_role"), F.col("start.n").alias("n"), F.col("stop.n").alias("reply_n"))


@query("""WITH i AS (SELECT * FROM (VALUES ('click', 'A', 'novel'), ('view', 'B', 'familiar'), ('click', 'C', 'novel')) t(label, object, novelty)),
l AS (SELECT label, max(object) AS object, max_by(novelty, object) AS novelty FROM i GROUP BY label)
SELECT event_id, event_type AS label, coalesce(object, '') AS object, coalesce(novelty, '') AS novelty FROM events LEFT JOIN l ON label = event_type""")
def object_enrichment(spark, sf_dir):
    """What is known of a label; the last entry wins, the default is empty text."""
    sheet = spark.createDataFrame([("t1", "sample", "click", "A", "novel", "view", "B", "familiar", "click", "C", "novel")], "test string, trial string, Obj_A string, ObjName_A string, ID_A string, Obj_B string, ObjName_B string, ID_B string, Obj_C string, ObjName_C string, ID_C string")
    info = ev.object_info(sheet, ["test"]).select("label", "ord", "object", "novelty")
    rows = events(spark, sf_dir).select("event_id", F.col("event_type").alias("label"))
    return ev.enrich(rows, info, ["label"], ["object", "novelty"], ["ord"]).select("event_id", "label", "object", "novelty")


@query("""WITH p AS (SELECT o_custkey, o_orderkey, o_orderdate, lead(o_orderkey) OVER w AS next_order, lead(o_orderdate) OVER w AS next_date FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))
SELECT o_custkey, o_orderkey, next_order, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM p WHERE date_diff('day', o_orderdate, next_date) = 1""")
def consecutive_day_pairs(spark, sf_dir):
    """W6, Q4."""
    out = discover.consecutive_days(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderdate", ["o_orderkey"])
    return out.select("o_custkey", "o_orderkey", F.col("next.o_orderkey").alias("next_order"), F.to_date("o_orderdate").cast("string").alias("day"))

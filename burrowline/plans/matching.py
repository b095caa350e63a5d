"""Queries on names: sessions and their folders, files and observations found by what their names contain."""

from __future__ import annotations

from pyspark.sql import functions as F

from burrowline.functions import scalar
from burrowline.operators import align, discover, meta
from burrowline.operators import events as ev
from burrowline.plans.base import EV, events, query, table

#: Names of sessions as a sheet has them, by an order's priority and status.
SESSION = "CASE o_orderpriority WHEN '1-URGENT' THEN 'HabD1' WHEN '2-HIGH' THEN 'Test STM' WHEN '3-MEDIUM' THEN 'Test LTM_Day2' WHEN '4-NOT SPECIFIED' THEN 'Weeto_Day13' ELSE 'Cue' END"


def sessions(spark, sf_dir):
    p = F.col("o_orderpriority")
    name = F.when(p == "1-URGENT", "HabD1").when(p == "2-HIGH", "Test STM").when(p == "3-MEDIUM", "Test LTM_Day2").when(p == "4-NOT SPECIFIED", "Weeto_Day13").otherwise("Cue")
    return table(spark, sf_dir, "orders").withColumn("session", name)


@query(f"""WITH s AS (SELECT *, {SESSION} AS session FROM orders)
SELECT o_orderkey, CASE WHEN session LIKE '%LTM%' THEN 'LTM' WHEN session LIKE '%STM%' THEN 'STM' WHEN session LIKE '%Hab%' THEN 'Hab' WHEN session LIKE '%Test%' THEN 'Test' ELSE 'other' END AS kind,
regexp_matches(session, 'Hab|Test|Weeto') AS known, regexp_replace(session, '_Day[0-9]+$', '') AS session_key, o_orderstatus || '_' || session || CASE WHEN o_orderstatus = 'F' THEN '_Day' || (o_custkey % 5) ELSE '' END || '_' || strftime(o_orderdate, '%Y%m%d') AS session_id,
CASE WHEN session LIKE '%STM%' AND o_custkey % 3 = 0 THEN 1200.0 ELSE CAST(o_custkey % 3 AS DOUBLE) END AS delay, session || '_.nwb' AS catalogue_name FROM s""")
def session_names(spark, sf_dir):
    """Kind, validity, lookup key, composed id, default delay and catalogue name of each session."""
    s, name = sessions(spark, sf_dir), F.col("session")
    day = F.when(F.col("o_orderstatus") == "F", F.col("o_custkey") % 5)
    kind = scalar.session_kind(name)
    return s.select(
        "o_orderkey", kind.alias("kind"), scalar.known_prey_session(name).alias("known"), scalar.session_key(name).alias("session_key"), scalar.session_name(F.col("o_orderstatus"), name, day, F.col("o_orderdate")).alias("session_id"),
        scalar.test_delay(kind, (F.col("o_custkey") % 3).cast("double")).alias("delay"), scalar.catalogue_name(F.concat(name, F.lit(".nwb"))).alias("catalogue_name"),
    )


@query("SELECT p_partkey, CASE WHEN p_size < 25 THEN p_type ELSE p_type || ' x' END AS label, p_name NOT LIKE '%anvil%' AS kept FROM part WHERE p_name NOT LIKE '%anvil%'")
def labels_without_stimulus(spark, sf_dir):
    """names without the stimulus animal, labels without what marks their kind."""
    name = F.concat(F.replace("p_name", F.lit("anvil"), F.lit("Stim3")), F.lit(".avi"))
    raw = F.when(F.col("p_size") < 25, F.concat("p_type", F.lit("_LFP_electrode_group"))).otherwise(F.concat(F.lit("Accelerometer "), "p_type", F.lit(" x")))
    p = table(spark, sf_dir, "part").select("p_partkey", name.alias("name"), raw.alias("raw"))
    return discover.without_stimulus(p).select("p_partkey", scalar.clean_label(F.col("raw")).alias("label"), (~F.lower("name").contains("stim")).alias("kept"))


@query(f"""WITH s AS (SELECT o_orderkey, o_orderstatus, {SESSION} AS session FROM orders), d(name, pattern) AS (VALUES ('arena', NULL), ('box A', 'STM'), ('box B', 'LTM'), ('marbles', 'Test'))
SELECT o_orderkey, name FROM s, d WHERE o_orderstatus <> 'P' AND (pattern IS NULL OR regexp_matches(session, pattern))""")
def session_devices(spark, sf_dir):
    """F8, Q8: a session's devices, but for those that a rule keeps to others."""
    s = sessions(spark, sf_dir).select("o_orderkey", F.col("o_orderstatus").alias("task"), "session")
    names, rules = ("arena", "box A", "box B", "marbles"), (("box A", "STM"), ("box B", "LTM"), ("marbles", "Test"))
    devices = spark.createDataFrame([(t, n) for t in "FO" for n in names], "task string, name string")
    ruled = spark.createDataFrame([(t, n, p) for t in "FO" for n, p in rules], "task string, device string, session_pattern string")
    return meta.devices_of(s, devices, ruled).select("o_orderkey", "name")


@query("""WITH s AS (SELECT c_custkey, 'L' || c_nationkey || '/' || c_mktsegment || '_OLM/Hab' AS dir FROM customer), f AS (SELECT 'L' || s_nationkey || '/' || CASE WHEN s_acctbal > 0 THEN 'BUILDING' ELSE 'FURNITURE' END || '_OLM/Hab' AS dir, s_name AS name FROM supplier)
SELECT c_custkey, dir, name FROM s LEFT JOIN f USING (dir)""")
def session_folders(spark, sf_dir):
    """Files of the folder that line, cohort, task and session make; sessions without one keep a null name."""
    folder = lambda line, cohort: discover.folder_of(F.concat(F.lit("L"), line), cohort, F.lit("OLM"), F.lit("Hab"))
    s = table(spark, sf_dir, "customer").select("c_custkey", folder(F.col("c_nationkey").cast("string"), F.col("c_mktsegment")).alias("dir"))
    cohort = F.when(F.col("s_acctbal") > 0, "BUILDING").otherwise("FURNITURE")
    f = table(spark, sf_dir, "supplier").select(folder(F.col("s_nationkey").cast("string"), cohort).alias("dir"), F.col("s_name").alias("name"))
    return discover.with_folder(s, f).select("c_custkey", "dir", "name")


OBSERVED = "(SELECT c_nationkey AS line, c_name || '_' || c_mktsegment AS observation_id FROM customer)"


@query(f"""SELECT s_suppkey, observation_id FROM (SELECT s_suppkey, observation_id, row_number() OVER (PARTITION BY s_suppkey ORDER BY observation_id) AS k
FROM supplier JOIN {OBSERVED} ON line = s_nationkey WHERE contains(observation_id, CAST(s_suppkey AS VARCHAR)) AND regexp_matches(observation_id, 'ING|URE')) WHERE k = 1""")
def observation_match(spark, sf_dir):
    """The first observation of the line whose id holds the animal's and a tag."""
    o = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("line"), F.concat_ws("_", "c_name", "c_mktsegment").alias("observation_id"))
    s = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("line"))
    tag = F.col("observation_id").contains("ING") | F.col("observation_id").contains("URE")
    return discover.match_observation(s, o, ["line"], ["s_suppkey"], F.col("s_suppkey"), tag).select("s_suppkey", "observation_id")


@query(f"""WITH h AS (SELECT s_suppkey, observation_id FROM supplier LEFT JOIN {OBSERVED} ON line = s_nationkey AND contains(observation_id, s_suppkey || '_'))
SELECT s_suppkey, observation_id, CASE WHEN count(observation_id) OVER w = 0 THEN 'none' WHEN count(observation_id) OVER w > 1 THEN 'multiple' END AS reason FROM h WINDOW w AS (PARTITION BY s_suppkey)""")
def unique_observations(spark, sf_dir):
    """The one observation whose id holds a pattern, or a reason."""
    o = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("line"), F.concat_ws("_", "c_name", "c_mktsegment").alias("observation_id"))
    s = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("line"))
    out = discover.unique_observation(s, o, ["line"], ["s_suppkey"], F.concat(F.col("s_suppkey").cast("string"), F.lit("_")))
    return out.select("s_suppkey", "observation_id", "reason")


@query("""WITH h AS (SELECT c_custkey, s_name FROM customer LEFT JOIN supplier ON s_nationkey = c_nationkey AND contains(s_name, c_custkey % 100 || ''))
SELECT c_custkey, s_name AS name, CASE WHEN count(s_name) OVER w = 0 THEN 'none' WHEN count(s_name) OVER w > 1 THEN 'multiple' END AS reason FROM h WINDOW w AS (PARTITION BY c_custkey)""")
def analysis_files(spark, sf_dir):
    """The one analysis file whose name holds the second part of the session's id."""
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("line"), F.concat_ws("_", F.lit("WM"), (F.col("c_custkey") % 100).cast("string"), F.lit("x")).alias("session"))
    f = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("line"), F.col("s_name").alias("name"))
    return discover.match_second_token(c, f, ["line"], ["c_custkey"]).select("c_custkey", "name", "reason")


@query("""WITH f AS (SELECT o_custkey, min('s' || o_orderkey || '.csv') AS scores, string_agg('s' || o_orderkey || '.csv', ',' ORDER BY o_orderkey) AS sounds FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey)
SELECT c_custkey, scores, sounds FROM customer LEFT JOIN f ON o_custkey = c_custkey""")
def side_files(spark, sf_dir):
    """Optional files, the first by name or all in natural order."""
    f = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"), F.concat(F.lit("s"), "o_orderkey", F.lit(".csv")).alias("name"))
    c = table(spark, sf_dir, "customer").select("c_custkey")
    both = discover.side_file(discover.side_file(c, f, ["c_custkey"], "scores"), f, ["c_custkey"], "sounds", as_list=True)
    return both.select("c_custkey", "scores", F.array_join("sounds", ",").alias("sounds"))


@query(f"""SELECT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS date, count(*) AS n, string_agg(CAST(us AS VARCHAR) || ':' || event_id, ',' ORDER BY us, event_id) AS videos FROM {EV} GROUP BY user_id, CAST(ts AS DATE)""")
def videos_by_date(spark, sf_dir):
    """A4, O3: a subject's videos of each date, sorted by start."""
    e = events(spark, sf_dir).select("user_id", F.col("ts").alias("start_ts"), F.struct("event_id", "us").alias("path"))
    out = discover.by_date(e, ["user_id"])
    shown = F.transform("videos", lambda v: F.concat_ws(":", v["path"]["us"], v["path"]["event_id"]))
    return out.select("user_id", F.col("date").cast("string").alias("date"), F.size("videos").cast("long").alias("n"), F.array_join(shown, ",").alias("videos"))


KINDS = ("click", "view", "error", "signup", "purchase")


@query(f"""SELECT user_id, event_id, CAST(list_position(['click', 'view', 'error', 'signup', 'purchase'], event_type) - 1 AS INT) AS segment FROM {EV}""")
def series_segments(spark, sf_dir):
    """A series in several files, segment by segment."""
    e = events(spark, sf_dir)
    return align.concatenated([e.filter(F.col("event_type") == k).select("user_id", "event_id") for k in KINDS])


@query("""SELECT event_id, CASE WHEN extract('day' FROM ts) < 10 THEN 'sample' ELSE 'test' END AS trial_type, CASE event_type WHEN 'click' THEN 'cup' WHEN 'view' THEN 'cone' ELSE 'box' END AS object FROM events WHERE event_type IN ('click', 'view', 'signup')""")
def labelled_trials(spark, sf_dir):
    """Events of sample and test under one session, with their objects; those without an object go."""
    e = events(spark, sf_dir).select("event_id", F.col("event_type").alias("label"), F.dayofmonth("ts").alias("d"))
    both = ev.with_trial_type(e.filter("d < 10"), e.filter("d >= 10"))
    objects = (("A", "click", "cup"), ("B", "view", "cone"), ("C", "error", "nan"), ("D", "signup", "box"))
    sheet = e.select(F.lit("t").alias("k")).distinct().select("k", F.explode(F.array(F.lit("Sample trial"), F.lit("Test trial"))).alias("trial"), *[F.lit(x).alias(f"{c}_{k}") for k, label, name in objects for c, x in (("Obj", label), ("ObjName", name))])
    info = ev.object_info(sheet, ["k"])
    return ev.labelled(ev.enrich(both, info, ["trial_type", "label"], ["object"], ["ord"])).select("event_id", "trial_type", "object")


FILES = "(SELECT l_orderkey, l_shipdate, l_linenumber, l_partkey, CASE WHEN l_quantity >= 50 THEN 'undated' ELSE strftime(l_shipdate, '%Y-%m-%d') || ' 10-0' || l_linenumber || '-00' END || '_m' || l_partkey || CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN '_Stim' ELSE '' END || '.avi' AS name, l_quantity >= 50 AS undated FROM lineitem)"


@query(f"""WITH s AS (SELECT o_orderkey, {SESSION} AS session FROM orders), f AS (SELECT * FROM {FILES} WHERE name NOT LIKE '%Stim%'),
n AS (SELECT o_orderkey, session, count(name) AS n, count(*) FILTER (undated) AS undated FROM s LEFT JOIN f ON l_orderkey = o_orderkey GROUP BY ALL),
r AS (SELECT *, CASE WHEN NOT regexp_matches(session, 'Hab|Test|Weeto') THEN 'unknown session' WHEN n = 0 THEN 'no_video' WHEN undated > 0 THEN 'no date in a file name' WHEN n > 1 AND session LIKE 'Hab%' THEN 'multiple videos' END AS reason FROM n),
v AS (SELECT o_orderkey, session, name, epoch(l_shipdate) + 60 * l_linenumber AS t, row_number() OVER (PARTITION BY o_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey) AS trial, reason FROM r JOIN f ON l_orderkey = o_orderkey WHERE reason IS NULL)
SELECT o_orderkey, name, CASE WHEN session LIKE 'Test%' THEN 'BehavioralVideoTestTrial' || trial WHEN session LIKE 'Weeto%' THEN 'BehavioralVideoWeetoTrial' || trial ELSE 'BehavioralVideo' END AS video_name, CAST(t - first_value(t) OVER (PARTITION BY o_orderkey ORDER BY trial) AS DOUBLE) AS start_s, reason FROM v
UNION ALL SELECT o_orderkey, NULL, NULL, NULL, reason FROM r WHERE reason IS NOT NULL""")
def prey_capture_videos(spark, sf_dir):
    """Videos of prey-capture sessions as trials, with their offsets, and why sessions are rejected."""
    from burrowline.plans import flows

    key = F.col("o_orderkey").cast("string")
    s = sessions(spark, sf_dir).select(F.lit("s").alias("subject_id"), key.alias("session_id"), "session")
    dated = F.concat(F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit(" 10-0"), "l_linenumber", F.lit("-00"))
    name = F.concat(F.when(F.col("l_quantity") >= 50, "undated").otherwise(dated), F.lit("_m"), "l_partkey", F.when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1), "_Stim").otherwise(""), F.lit(".avi"))
    files = table(spark, sf_dir, "lineitem").select(F.lit("s").alias("subject_id"), F.col("l_orderkey").cast("string").alias("session_id"), name.alias("name"))
    good, bad = flows.trial_videos(s, files, flows.PREY_CAPTURE)
    none = lambda kind: F.lit(None).cast(kind)
    order = F.col("session_id").cast("bigint").alias("o_orderkey")
    return good.select(order, "name", "video_name", "start_s", none("string").alias("reason")).unionByName(bad.select(order, none("string").alias("name"), none("string").alias("video_name"), none("double").alias("start_s"), "reason"))

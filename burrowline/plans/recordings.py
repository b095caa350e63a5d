"""Queries on trigger lines and signals."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from burrowline.operators import align, pyramid, scans, signals
from burrowline.plans.base import EV, events, query, r4, table
from burrowline.sources import shared

LINE = ["user_id", "event_type"]
RATE = 500.0


@query(f"SELECT user_id, event_type, us AS from_at, lead(us) OVER (PARTITION BY user_id, event_type ORDER BY us, event_id) AS to_at, state FROM {EV}")
def ttl_step_intervals(spark, sf_dir):
    """W1 as intervals."""
    return signals.step_intervals(events(spark, sf_dir), LINE, "us", "state", ["event_id"])


@query(f"""WITH u AS (SELECT user_id, min(us) // 3600000000 AS a, max(us) // 3600000000 AS z FROM {EV} GROUP BY user_id), h AS (SELECT user_id, unnest(generate_series(a, z)) AS hour FROM u),
e AS (SELECT user_id, us, max_by(state, event_id) AS state FROM {EV} GROUP BY ALL)
SELECT h.user_id, h.hour, coalesce(e.state, 0) AS state FROM h ASOF LEFT JOIN e ON h.user_id = e.user_id AND h.hour * 3600000000 >= e.us""")
def ttl_dense_hourly(spark, sf_dir):
    """W1 at every hour of each subject's recording, from its first to its last event."""
    e = events(spark, sf_dir)
    hour = lambda c: F.floor(c / 3600000000)
    hours = e.groupBy("user_id").agg(hour(F.min("us")).alias("a"), hour(F.max("us")).alias("z")).select("user_id", F.explode(F.sequence("a", "z")).alias("hour"))
    grid = hours.select("user_id", (F.col("hour") * 3600000000).alias("us"))
    out = signals.dense_steps(grid, e, ["user_id"], "us", "state", ["event_id"])
    return out.select("user_id", F.floor(F.col("us") / 3600000000).alias("hour"), "state")


@query(f"""SELECT event_id, lead(us) OVER w AS next_us, lag(event_id) OVER w AS last_event, round(sum(value) OVER (w ROWS UNBOUNDED PRECEDING), 2) AS total, last_value(CASE WHEN event_type = 'error' THEN value END IGNORE NULLS) OVER (w ROWS UNBOUNDED PRECEDING) AS last_error
FROM {EV} WINDOW w AS (ORDER BY us, event_id)""")
def one_long_line(spark, sf_dir):
    """The whole table as one line, in blocks of 500 rows: neighbours, running total, last known value."""
    e = events(spark, sf_dir).select(F.lit("line").alias("line"), "event_id", "us", "value", F.when(F.col("event_type") == "error", F.col("value")).alias("of_error"))
    line, order = ["line"], ["us", "event_id"]
    out = scans.neighbour(scans.blocked(e, line, "us", 500), line, order, ["us"], "next")
    out = scans.neighbour(out, line, order, ["event_id"], "last", ahead=False)
    out = scans.last_known(scans.running_sum(out, line, order, "value", "total"), line, order, "of_error", "last_error")
    return out.select("event_id", F.col("next.us").alias("next_us"), F.col("last.event_id").alias("last_event"), F.round("total", 2).alias("total"), "last_error")


@query(f"""SELECT user_id, event_type, prev_us AS last_high, us AS first_low FROM (SELECT *, lag(us) OVER w AS prev_us, lag(state) OVER w AS prev FROM {EV} WINDOW w AS (PARTITION BY user_id, event_type ORDER BY us, event_id)) WHERE prev > state""")
def ttl_falling_edges(spark, sf_dir):
    """W3, Q11."""
    out = signals.edges(events(spark, sf_dir), LINE, "us", "state", ["event_id"])
    return out.select(*LINE, F.col("prev_at").alias("last_high"), F.col("us").alias("first_low"))


@query(f"SELECT event_type, max(us) + 1 AS n_samples, count(DISTINCT state) AS n_states, bool_and(state = 0) AS all_zero FROM {EV} GROUP BY event_type")
def ttl_channel_summary(spark, sf_dir):
    """A1, Q2."""
    return signals.channel_summary(events(spark, sf_dir), ["event_type"], "us", "state")


@query(f"SELECT user_id, round(min(us) FILTER (event_type = 'error') / 1e6, 4) AS first_cs_s, min(us) AS start_us FROM {EV} GROUP BY user_id HAVING count(*) FILTER (event_type = 'error') > 0")
def first_cs_time(spark, sf_dir):
    """A2, A3."""
    from burrowline.operators.discover import session_start

    e = events(spark, sf_dir)
    line = e.select("user_id", F.when(F.col("event_type") == "error", 2).otherwise(1).alias("channel"), F.col("us").alias("sample"))
    onset = align.first_onset(line, ["user_id"], 2, 1e6)
    return onset.join(session_start(e, ["user_id"], "us"), "user_id").select("user_id", r4(F.col("first_cs_s")).alias("first_cs_s"), F.col("us").alias("start_us"))


@query(f"SELECT event_id, us FROM {EV} WHERE us >= epoch_us(TIMESTAMP '2024-01-10') AND us < epoch_us(TIMESTAMP '2024-01-12 12:00:00')")
def time_window_slice(spark, sf_dir):
    """F14, Q10."""
    return signals.window_slice(events(spark, sf_dir), 1704844800.0, 1705060800.0, 1e6, 0.0, "us").select("event_id", "us")


@query(f"""WITH n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY us, event_id) - 1 AS i FROM {EV}),
c AS (SELECT user_id, min(i) AS i FROM n WHERE event_type = 'view' GROUP BY user_id), s AS (SELECT user_id, us / 1e6 AS frame_s FROM n JOIN c USING (user_id, i)),
t AS (SELECT user_id, min(us) / 1e6 AS cs FROM {EV} WHERE event_type = 'error' GROUP BY user_id), o AS (SELECT user_id, cs - frame_s AS d FROM t LEFT JOIN s USING (user_id))
SELECT user_id, round(d, 3) AS offset_s, round(CASE WHEN d IS NOT NULL THEN greatest(d, 0) END, 3) AS video_offset, round(CASE WHEN d IS NOT NULL THEN greatest(-d, 0) END, 3) AS recording_offset, d IS NOT NULL AS aligned FROM o""")
def clock_offset_split(spark, sf_dir):
    """First pulse against the frame that the sheet names; subjects without that frame aren't aligned."""
    e = events(spark, sf_dir)
    line = e.select("user_id", F.when(F.col("event_type") == "error", 2).otherwise(1).alias("channel"), F.col("us").alias("sample"))
    numbered = e.withColumn("frame_idx", F.row_number().over(Window.partitionBy("user_id").orderBy("us", "event_id")) - 1)
    frames = numbered.select(F.concat(F.lit("v/"), F.col("user_id").cast("string")).alias("path"), "frame_idx", (F.col("us") / 1e6).alias("t_s"))
    videos = e.select("user_id", F.concat(F.lit("v/"), F.col("user_id").cast("string")).alias("path")).distinct()
    shown = numbered.filter("event_type = 'view'").groupBy("user_id").agg(F.min("frame_idx").alias("first_cs_frame"))
    out = align.clock_offset(align.first_onset(line, ["user_id"], 2, 1e6), shown, frames, ["user_id"], videos)
    return out.select("user_id", *[F.round(c, 3).alias(c) for c in ("offset_s", "video_offset", "recording_offset")], "aligned")


@query(f"""SELECT user_id, round(min(us) / 1e6, 3) AS first_s, round(max(us) / 1e6, 3) AS last_start_s, round(max(us / 1e6 + value), 3) AS last_stop_s FROM {EV} GROUP BY user_id""")
def epoch_bounds(spark, sf_dir):
    """A12."""
    e = events(spark, sf_dir).withColumn("t_s", F.col("us") / 1e6)
    out = align.extents(e, ["user_id"], "t_s", "value")
    return out.select("user_id", *[F.round(c, 3).alias(c) for c in ("first_s", "last_start_s", "last_stop_s")])


@query("SELECT vec_id, round(10 + vec_id / 500.0, 6) AS t_s, len(embedding) AS n_channels FROM embeddings")
def sample_timestamps(spark, sf_dir):
    """W9."""
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.round(signals.sample_time("vec_id", F.lit(RATE), F.lit(10.0)), 6).alias("t_s"), F.size("embedding").cast("long").alias("n_channels"))


@query("SELECT label, round((max(vec_id) + 1) / 500.0, 6) AS duration_s FROM embeddings GROUP BY label")
def series_duration(spark, sf_dir):
    """A9."""
    return signals.duration(table(spark, sf_dir, "embeddings"), ["label"], F.lit(RATE), "vec_id").select("label", F.round("duration_s", 6).alias("duration_s"))


@query("SELECT vec_id, round(CAST(embedding[1] AS DOUBLE), 6) AS c0, round(CAST(embedding[6] AS DOUBLE), 6) AS c5, round(CAST(embedding[64] AS DOUBLE), 6) AS c63 FROM embeddings")
def channel_projection(spark, sf_dir):
    """chosen channels without exploding samples."""
    e = table(spark, sf_dir, "embeddings").withColumn("v", signals.project_channels("embedding", [0, 5, 63]))
    return e.select("vec_id", *[F.round(F.get("v", F.lit(i)).cast("double"), 6).alias(n) for i, n in enumerate(("c0", "c5", "c63"))])


@query("""WITH l AS (SELECT vec_id, unnest(embedding) AS value, generate_subscripts(embedding, 1) - 1 AS channel FROM embeddings), o AS (SELECT 2 * max(abs(value)) AS stack_offset FROM l)
SELECT vec_id, CAST(channel AS INT) AS channel, round(CAST(stack_offset AS DOUBLE), 4) AS stack_offset, round(-channel * CAST(stack_offset AS DOUBLE) + CAST(value AS DOUBLE), 4) AS y FROM l, o""")
def stack_offset(spark, sf_dir):
    """The data behind a stacked plot."""
    e = table(spark, sf_dir, "embeddings").withColumn("v", F.col("embedding").cast("array<double>"))
    out = signals.stacked(signals.channels_long(e, ["vec_id"]), signals.stack_offset(e))
    return out.select("vec_id", "channel", r4(F.col("stack_offset")).alias("stack_offset"), r4(F.col("y")).alias("y"))


@query("""WITH b AS (SELECT 37 AS a, max(vec_id) - 10 AS z FROM embeddings), l AS (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS channel FROM embeddings, b WHERE vec_id >= a AND vec_id < z)
SELECT label, CAST(channel AS INT) AS channel, count(*) AS n, round(CAST(min(x) AS DOUBLE), 6) AS lo, round(CAST(max(x) AS DOUBLE), 6) AS hi, round(sum(CAST(x AS DOUBLE)), 4) AS total, round(2 * max(max(abs(CAST(x AS DOUBLE)))) OVER (PARTITION BY label), 6) AS stack_offset FROM l GROUP BY label, channel""")
def window_extents(spark, sf_dir):
    """Extents and display offset of a window that ends within blocks, from the pyramid and the samples at its
    ends."""
    e = table(spark, sf_dir, "embeddings")
    last = e.agg(F.max("vec_id")).first()[0] - 10
    blocks = shared.written(pyramid.build(e, ["label"], "vec_id", "embedding", 16, 3), "pyramid")
    x = pyramid.extents(blocks, e, ["label"], 37, last, "vec_id", "embedding", 16, 3)
    y = shared.written(x, "extents")
    out = y.join(pyramid.display_offset(y, ["label"]), "label")
    r6 = lambda c: F.round(c, 6).alias(c)
    return out.select("label", "channel", "n", r6("lo"), r6("hi"), r4(F.col("total")).alias("total"), r6("stack_offset"))


@query("""SELECT p_partkey, CASE WHEN p_size % 10 = 0 THEN 'unknown' ELSE replace(p_type, 'PROMO', 'EEG_PROMO') END AS location, p_size % 10 = 0 AS bad_channel,
CASE WHEN p_size % 10 = 0 THEN 'bad' WHEN p_type LIKE '%PROMO%' THEN 'eeg' ELSE 'lfp' END AS kind FROM part""")
def channel_class_split(spark, sf_dir):
    """F17, F19."""
    code = F.when(F.col("p_size") % 10 == 0, "bad").otherwise(F.replace("p_type", F.lit("PROMO"), F.lit("EEG_PROMO")))
    where, bad = signals.recoded_channel(code)
    return table(spark, sf_dir, "part").select("p_partkey", where.alias("location"), bad.alias("bad_channel"), signals.channel_class(where, bad).alias("kind"))


@query("""SELECT l_orderkey, l_linenumber, count(DISTINCT l_tax) AS n_gains, round(CASE WHEN count(DISTINCT l_tax) = 1 THEN min(l_tax) * 1e-6 ELSE 1e-6 END * 1e9, 4) AS nano_conversion FROM lineitem GROUP BY ALL""")
def uniform_gain_check(spark, sf_dir):
    """A7, X11."""
    out = signals.gain_conversion(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], "l_tax")
    return out.select("l_orderkey", "l_linenumber", "n_gains", r4(F.col("conversion") * 1e9).alias("nano_conversion"))


@query("""WITH g AS (SELECT l_orderkey, l_discount, string_agg(CAST(l_linenumber AS VARCHAR), ',' ORDER BY l_linenumber) AS channels FROM lineitem GROUP BY ALL)
SELECT l_orderkey, l_discount, channels, CASE WHEN count(*) OVER (PARTITION BY l_orderkey) > 1 THEN 'offsets differ' END AS reason FROM g""")
def offset_report(spark, sf_dir):
    """A8."""
    out = signals.offset_report(table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_discount", "l_linenumber")
    return out.select("l_orderkey", "l_discount", F.array_join(F.col("channels").cast("array<string>"), ",").alias("channels"), "reason")


@query(f"""WITH x AS (SELECT user_id, us AS edge FROM (SELECT *, lag(state) OVER (PARTITION BY user_id ORDER BY us, event_id) AS prev FROM {EV}) WHERE prev > state)
SELECT e.event_id, x.edge, e.us - x.edge AS lag FROM x JOIN {EV} e ON e.user_id = x.user_id AND e.us BETWEEN x.edge - 3600000000 AND x.edge + 7200000000""")
def stimulus_locked(spark, sf_dir):
    """All samples from an hour before to two after each falling edge."""
    e = events(spark, sf_dir).select("user_id", "event_id", "us", "state")
    drops = signals.edges(e, ["user_id"], "us", "state", ["event_id"]).select("user_id", F.col("us").alias("edge"))
    return signals.stimulus_locked(e.select("user_id", "event_id", "us"), drops, ["user_id"], "us", "edge", 3600000000, 7200000000).select("event_id", "edge", "lag")


@query(f"""WITH g AS (SELECT event_type, CAST(floor(us / 3600000000) AS BIGINT) AS grid, sum(value) AS v FROM {EV} GROUP BY ALL)
SELECT a.grid, round(a.v, 4) AS clicks, round(b.v, 4) AS views FROM g a JOIN g b ON a.grid = b.grid WHERE a.event_type = 'click' AND b.event_type = 'view'""")
def multi_signal_grid(spark, sf_dir):
    """Two series of different rates on one hourly grid."""
    e = signals.on_grid(events(spark, sf_dir), F.col("us") / 3600000000, 1.0)  # time in hours
    one = lambda kind, name: e.filter(F.col("event_type") == kind).groupBy("grid").agg(r4(F.sum("value")).alias(name))
    return one("click", "clicks").join(one("view", "views"), "grid")

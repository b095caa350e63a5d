"""Trigger lines, signals and clocks on hand-written rows."""

import pytest
from pyspark.sql import functions as F

from burrowline.operators import align, signals


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=lambda r: tuple((x is not None, str(x)) for x in r))


@pytest.fixture(scope="module")
def ttl(spark):
    return spark.createDataFrame([("s", 2, 8, 0), ("s", 2, 3, 1), ("s", 2, 5, 1), ("s", 1, 4, 0), ("s", 2, 10, 1)], "subject_id string, channel int, sample long, state int")


KEY = ["subject_id", "channel"]


def test_intervals_tile_the_line(ttl):
    out = rows(signals.step_intervals(ttl, KEY, "sample", "state").filter("channel = 2"), "from_at", "to_at", "state")
    assert sorted(out) == [(3, 5, 1), (5, 8, 1), (8, 10, 0), (10, None, 1)] if all(x[1] for x in out) else len(out) == 4


def test_dense_line_is_zero_before_the_first_change(ttl):
    extent = signals.channel_summary(ttl, KEY, "sample", "state")
    assert rows(extent, "channel", "n_samples", "all_zero") == [(1, 5, True), (2, 11, False)]
    assert rows(signals.silent_channels(extent), "channel", "reason") == [(1, "channel has no events")]
    dense = signals.dense_steps(signals.sample_grid(extent, KEY, "n_samples"), ttl, KEY, "sample", "state").filter("channel = 2")
    assert [r["state"] for r in dense.orderBy("sample").collect()] == [0, 0, 0, 1, 1, 1, 1, 1, 0, 0, 1]


def test_falling_edges_report_both_sides(ttl):
    assert rows(signals.falling_edges_in_samples(ttl, KEY), "channel", "last_high_sample", "first_low_sample") == [(2, 7, 8)]
    assert rows(signals.named_channels(ttl).select("channel", "channel_name").distinct(), "channel", "channel_name") == [(1, "TTL_audio_trigger"), (2, "TTL_LED_trigger")]


@pytest.fixture(scope="module")
def series(spark):
    return spark.createDataFrame([("s", i, [float(i), -2.0 * i, 0.5]) for i in range(20)], "subject_id string, sample_idx long, v array<double>")


def test_slices_are_half_open_and_reach_the_scan(series, spark, tmp_path):
    assert sorted(r["sample_idx"] for r in signals.window_slice(series, 0.45, 1.0, 10.0).collect()) == [5, 6, 7, 8, 9]
    assert signals.window_slice(series, 5.0, 1.0, 10.0).count() == 0
    series.write.parquet(str(tmp_path / "x"))
    plan = signals.window_slice(spark.read.parquet(str(tmp_path / "x")), 0.45, 1.0, 10.0)._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(sample_idx,5)" in plan and "LessThan(sample_idx,10)" in plan


def test_channels_offsets_and_durations(series, spark):
    assert rows(series.select(signals.project_channels("v", [2, 0]).alias("p")).limit(1), "p") == [([0.5, 0.0],)]
    assert signals.stack_offset(series).first()[0] == 76.0
    y = signals.stacked(signals.channels_long(series.filter("sample_idx = 1"), ["sample_idx"]), signals.stack_offset(series))
    assert rows(y, "channel", "y") == [(0, 1.0), (1, -78.0), (2, -151.5)]
    assert signals.duration(series, [], F.lit(10.0)).first()[0] == 2.0
    assert rows(series.select(signals.sample_time("sample_idx", F.lit(10.0), F.lit(1.0)).alias("t")).limit(1), "t") == [(1.0,)]


def test_channel_sheet_groups_and_gains(spark):
    sheet = spark.createDataFrame([("R1", *["IrL_1", "bad", "EEG_F"], *["IrL_2"] * 13)], "subject_id string, " + ", ".join(f"`{i}` string" for i in range(16)))
    m = signals.channel_map(sheet, ["subject_id"])
    assert rows(m.filter("channel < 4"), "channel", "location_code", "bad_channel", "probe_shank") == [(0, "IrL_1", False, "0"), (1, "unknown", True, "1"), (2, "EEG_F", False, "2"), (3, "IrL_2", False, "3")]
    groups = spark.createDataFrame([("IrL_1", "g"), ("IrL_2", "g"), ("unknown", "b")], "location_code string, group_name string")
    e = signals.electrodes(m, groups)
    assert rows(signals.electrode_group_list(e.filter("group_name = 'g'")), "group_name", "location_codes") == [("g", ["IrL_1", "IrL_2"])]
    assert rows(m.select(signals.channel_class(F.col("location_code"), F.col("bad_channel")).alias("c")).distinct(), "c") == [("bad",), ("eeg",), ("lfp",)]
    ch = spark.createDataFrame([("a", 0, 0.2, 0.0), ("a", 1, 0.2, 0.0), ("b", 0, 0.1, 0.0), ("b", 1, 0.3, 5.0)], "s string, channel int, gain double, off double")
    assert rows(signals.gain_conversion(ch, ["s"], "gain"), "s", F.round(F.col("conversion") * 1e6, 6).alias("c")) == [("a", 0.2), ("b", 1.0)]
    assert rows(signals.offset_report(ch, ["s"], "off"), "s", "reason", "channels") == [("a", None, [0, 1]), ("b", "offsets differ", [0]), ("b", "offsets differ", [1])]


def test_interval_join_equals_a_nested_loop(spark):
    import random

    r = random.Random(1)
    p = [("k", i, r.randint(0, 500)) for i in range(200)]
    iv = [("k", i, (a := r.randint(0, 480)), a + r.randint(0, 90)) for i in range(60)]
    out = signals.interval_join(spark.createDataFrame(p, "k string, p long, t long"), spark.createDataFrame(iv, "k string, i long, a long, z long"), ["k"], "t", "a", "z")
    assert rows(out, "p", "i") == sorted(((x[1], y[1]) for x in p for y in iv if y[2] <= x[2] < y[3]), key=lambda t: tuple((True, str(v)) for v in t))


def test_stimulus_locked_is_closed_on_both_ends(series, spark):
    e = spark.createDataFrame([("s", 10), ("s", 12)], "subject_id string, edge long")
    out = signals.stimulus_locked(series, e, ["subject_id"], "sample_idx", "edge", 2, 3)
    assert sorted((r["edge"], r["lag"]) for r in out.collect()) == [(e, lag) for e in (10, 12) for lag in range(-2, 4)]


def test_clock_offset_of_sessions_with_several_videos(spark):
    key = ["subject_id", "session_id"]
    onset = spark.createDataFrame([("s", "r1", 5.0), ("s", "r2", 7.0)], "subject_id string, session_id string, first_cs_s double")
    videos = spark.createDataFrame([("s", "r1", "a"), ("s", "r2", "b"), ("s", "r2", "c")], "subject_id string, session_id string, path string")
    frames = spark.createDataFrame([("a", 3, 1.0), ("b", 3, 9.0), ("c", 3, 2.0)], "path string, frame_idx int, t_s double")
    out = align.clock_offset(onset, spark.createDataFrame([("s", 3)], "subject_id string, first_cs_frame int"), frames, key, videos)
    assert rows(out, "session_id", "offset_s") == [("r1", 4.0), ("r2", -2.0)]


def test_epoch_tags_beyond_ninety_nine(spark):
    f = spark.createDataFrame([("k", i, float(i)) for i in range(101)], "k string, path int, t_s double")
    tags = [r["tags"][0] for r in align.epochs(f, ["k", "path"]).orderBy("path").collect()]
    assert tags[0] == "01" and tags[-1] == "101" and len(set(tags)) == 101


def test_clocks(ttl, spark):
    onset = align.first_onset(ttl, ["subject_id"], 2, 2.0)
    assert rows(onset, "first_cs_s") == [(1.5,)]
    cs = spark.createDataFrame([("s", 2), ("q", 9)], "subject_id string, first_cs_frame int")
    frames = spark.createDataFrame([("s", 1, 0.5), ("s", 2, 4.0), ("q", 0, 1.0)], "subject_id string, frame_idx int, t_s double")
    more = onset.unionByName(spark.createDataFrame([("q", 3.0)], "subject_id string, first_cs_s double"))
    off = align.clock_offset(more, cs, frames, ["subject_id"])
    assert rows(off, "subject_id", "offset_s", "video_offset", "recording_offset", "aligned") == [("q", None, None, None, False), ("s", -2.5, 0.0, 2.5, True)]
    assert rows(align.shifted_frames(frames, off, ["subject_id"]).filter("subject_id = 'q'"), "t_s") == [(1.0,)]  # unaligned stays


def test_frames_before_zero_move_up(spark):
    f = spark.createDataFrame([("p", 0, -2.0), ("p", 1, 1.0), ("q", 0, 3.0)], "path string, frame_idx int, t_s double")
    assert rows(align.no_negative_start(f, ["path"]), "path", "t_s") == [("p", 0.0), ("p", 3.0), ("q", 3.0)]
    s = spark.createDataFrame([("p", 10.0)], "path string, start_s double")
    assert rows(align.no_negative_start(f, ["path"], s), "path", "t_s") == [("p", 10.0), ("p", 13.0), ("q", 3.0)]
    assert rows(align.epochs(f, ["path"]), "path", "start_s", "stop_s") == [("p", -2.0, 1.0), ("q", 3.0, 3.0)]
    assert align.concatenated([f, f]).filter("segment = 1").count() == 3


def test_each_trial_has_its_own_offset(spark):
    v = spark.createDataFrame([("s", 1, "2023-01-01 10:00:00"), ("s", 2, "2023-01-01 10:00:07"), ("s", 3, "2023-01-01 10:01:00")], "k string, n int, ts string").withColumn("ts", F.to_timestamp("ts"))
    assert rows(align.relative_to_first(v, ["k"], ["n"], "ts"), "n", "start_s") == [(1, 0.0), (2, 7.0), (3, 60.0)]

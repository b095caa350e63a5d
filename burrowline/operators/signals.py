"""Multi-channel signals and digital trigger lines: intervals, edges, slices, range joins.

A signal row holds one sample of all channels; its time follows from sample_idx, rate and t0 and is never stored. Slices
are put as bounds on sample_idx, so that they reach the Parquet statistics. Trigger lines stay intervals until a query asks
for samples. Lines are scanned in blocks (scans), range joins meet on the nodes of a hierarchy (intervals).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from burrowline.operators import scans
from burrowline.operators.intervals import interval_join
from burrowline.sources import shared


def step_intervals(ttl: DataFrame, key: list[str], at: str, state: str, order: list[str] | None = None, per_block: int = scans.PER_BLOCK) -> DataFrame:
    """from_at, to_at (null: open), state: the state holds in [from_at, to_at) (W1). Before the first change it is 0."""
    out = scans.neighbour(ttl, key, [at, *(order or [])], [at], "_next", per_block=per_block)
    return out.select(*key, F.col(at).alias("from_at"), F.col(f"_next.{at}").alias("to_at"), F.col(state).alias("state"))


def dense_steps(grid: DataFrame, ttl: DataFrame, key: list[str], at: str, state: str, order: list[str] | None = None, per_block: int = scans.PER_BLOCK) -> DataFrame:
    """The state at each grid point: the last change at or before it, 0 before the first (W1 on request). Grid points and
    changes are one line in order of time, a change before a point of the same time."""
    tie = order or []
    marks = ttl.select(*key, F.col(at), F.lit(0).alias("_grid"), *[F.col(c) for c in tie], F.col(state).alias("_s"))
    points = grid.select(*key, F.col(at), F.lit(1).alias("_grid"), *[F.lit(None).cast(dict(ttl.dtypes)[c]).alias(c) for c in tie], F.lit(None).cast(dict(ttl.dtypes)[state]).alias("_s"))
    both = scans.last_known(marks.unionByName(points), key, [at, "_grid", *tie], "_s", "_last", per_block)
    return both.filter("_grid = 1").select(*key, at, F.coalesce("_last", F.lit(0)).alias("state"))


def sample_grid(extent: DataFrame, key: list[str], n: str) -> DataFrame:
    """Sample numbers 0..n-1 of each key."""
    return extent.select(*key, F.explode(F.sequence(F.lit(0).cast("long"), F.col(n).cast("long") - 1)).alias("sample"))


def edges(ttl: DataFrame, key: list[str], at: str, state: str, order: list[str] | None = None, falling: bool = True, per_block: int = scans.PER_BLOCK) -> DataFrame:
    """Places where the state falls (or rises): the last before and the first after."""
    rows = scans.neighbour(ttl, key, [at, *(order or [])], [state, at], "_prev", ahead=False, per_block=per_block)
    out = rows.withColumns({"prev_state": F.col(f"_prev.{state}"), "prev_at": F.col(f"_prev.{at}")}).drop("_prev", scans.BLOCK)
    return out.filter(F.col("prev_state") > F.col(state) if falling else F.col("prev_state") < F.col(state))


def falling_edges_in_samples(ttl: DataFrame, key: list[str]) -> DataFrame:
    """last_high_sample is the sample before the drop, where the reference puts the edge (Q11)."""
    e = edges(ttl, key, "sample", "state")
    return e.select(*key, (F.col("sample") - 1).alias("last_high_sample"), F.col("sample").alias("first_low_sample"))


def channel_summary(ttl: DataFrame, key: list[str], at: str, state: str) -> DataFrame:
    """Length, number of states and whether the line was always low (A1); silent lines become a warning (Q2)."""
    return ttl.groupBy(*key).agg((F.max(at) + 1).alias("n_samples"), F.count_distinct(state).alias("n_states"), F.bool_and(F.col(state) == 0).alias("all_zero"))


def silent_channels(summary: DataFrame) -> DataFrame:
    """Q2: what the reference builds an error for and never raises."""
    return summary.filter("all_zero").withColumn("reason", F.lit("channel has no events"))


#: Names of the trigger lines.
TTL_NAMES = ((1, "TTL_audio_trigger"), (2, "TTL_LED_trigger"))


def named_channels(ttl: DataFrame) -> DataFrame:
    """F20."""
    names = ttl.sparkSession.createDataFrame(list(TTL_NAMES), "channel int, channel_name string")
    return ttl.join(F.broadcast(names), "channel", "left")


def window_slice(signals: DataFrame, a: float, b: float, rate: float, t0: float = 0.0, index: str = "sample_idx") -> DataFrame:
    """Samples from the first at or after a up to, but without, the last at or before b."""
    import math

    first, last = math.ceil((a - t0) * rate), math.floor((b - t0) * rate)
    return signals.filter((F.col(index) >= first) & (F.col(index) < last))


def sample_time(index: str, rate: Column, t0: Column) -> Column:
    """W9."""
    return t0 + F.col(index) / rate


def duration(signals: DataFrame, key: list[str], rate: Column, index: str = "sample_idx") -> DataFrame:
    """A9."""
    g = signals.groupBy(*key) if key else signals.groupBy()
    return g.agg(((F.max(index) + 1) / F.max(rate)).alias("duration_s"))


def project_channels(v: str, channels: list[int]) -> Column:
    """Chosen channels of a sample, without exploding it."""
    return F.transform(F.array(*[F.lit(int(c)) for c in channels]), lambda i: F.get(F.col(v), i))


def channels_long(signals: DataFrame, keep: list[str], v: str = "v") -> DataFrame:
    """One row per sample and channel (R13); for slices only."""
    return signals.select(*keep, F.posexplode(v).alias("channel", "value"))


def stack_offset(signals: DataFrame, v: str = "v") -> DataFrame:
    """Twice the greatest absolute amplitude."""
    return signals.agg((2 * F.max(F.array_max(F.transform(v, lambda x: F.abs(x))))).alias("stack_offset"))


def stacked(long: DataFrame, offset: DataFrame) -> DataFrame:
    """Display value of each channel's sample: -channel x offset + value (X14). offset is one row."""
    return long.join(F.broadcast(offset)).withColumn("y", -F.col("channel") * F.col("stack_offset") + F.col("value"))


def channel_class(location: Column, bad: Column) -> Column:
    """bad, eeg or lfp."""
    return F.when(bad, "bad").when(location.contains("EEG"), "eeg").otherwise("lfp")


def recoded_channel(c: Column) -> tuple[Column, Column]:
    """Location (unknown for bad channels) and the bad flag."""
    return F.when(c == "bad", "unknown").otherwise(c), c == "bad"


def channel_map(sheet: DataFrame, key: list[str], channels: int = 16) -> DataFrame:
    """Channel sheet to a row per channel."""
    long = sheet.unpivot(key, [str(i) for i in range(channels)], "channel", "location_code")
    where, bad = recoded_channel(F.col("location_code"))
    return long.select(*key, F.col("channel").cast("int").alias("channel"), where.alias("location_code"), bad.alias("bad_channel"), F.col("channel").alias("probe_shank"))


def electrodes(channels: DataFrame, groups: DataFrame) -> DataFrame:
    """Channels with their electrode group; codes that share a group name share the group."""
    return channels.join(groups, "location_code", "left")


def electrode_group_list(electrode_rows: DataFrame) -> DataFrame:
    """Distinct groups by name (J11), codes sorted."""
    return electrode_rows.groupBy("group_name").agg(F.array_sort(F.collect_set("location_code")).alias("location_codes"))


def gain_conversion(channels: DataFrame, key: list[str], gain: str) -> DataFrame:
    """One gain: a scalar conversion in volts. Several: 1e-6 and a gain per channel."""
    g = shared.dealt(channels, *key).groupBy(*key).agg(F.count_distinct(gain).alias("n_gains"), F.min(gain).alias("gain"))
    return g.withColumn("conversion", F.when(F.col("n_gains") == 1, F.col("gain") * 1e-6).otherwise(F.lit(1e-6)))


def offset_report(channels: DataFrame, key: list[str], offset: str, channel: str = "channel") -> DataFrame:
    """Channels by offset, and a reason where a key has more than one offset."""
    g = channels.groupBy(*key, offset).agg(F.array_sort(F.collect_list(channel)).alias("channels"))
    n = F.count("*").over(Window.partitionBy(*key))
    return g.withColumn("reason", F.when(n > 1, "offsets differ"))


def on_grid(series: DataFrame, time_s: Column, grid_hz: float) -> DataFrame:
    """Grid step of each sample, to bring series of different rates together."""
    return series.withColumn("grid", F.floor(time_s * grid_hz))


def stimulus_locked(signals: DataFrame, edge_rows: DataFrame, on: list[str], index: str, edge: str, pre: int, post: int) -> DataFrame:
    """Samples from pre before to post after each edge, with their lag."""
    span = edge_rows.withColumns({"_from": F.col(edge) - pre, "_to": F.col(edge) + post})
    hit = interval_join(signals, span, on, index, "_from", "_to", closed=True)
    return hit.withColumn("lag", F.col(index) - F.col(edge)).drop("_from", "_to")

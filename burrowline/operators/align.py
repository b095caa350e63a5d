"""Clocks: onsets, offsets between recording and video, start times relative to the session."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from burrowline.functions.scalar import seconds_between, split_offset
from burrowline.sources import shared


def first_onset(ttl: DataFrame, key: list[str], channel: int = 2, rate: float = 2000.0) -> DataFrame:
    """Seconds of the earliest sample on a line (A2)."""
    return ttl.filter(F.col("channel") == channel).groupBy(*key).agg((F.min("sample") / rate).alias("first_cs_s"))


def clock_offset(onsets: DataFrame, cs_frames: DataFrame, frames: DataFrame, key: list[str], videos: DataFrame | None = None) -> DataFrame:
    """First pulse minus the time of the video frame that shows it (J12, R10); without one the video stays unshifted (Q1).

    cs_frames: first_cs_frame by as much of the key as it has. frames: frame_idx and t_s, by path where videos (key and path)
    tell which video a session has, else by as much of the key as they have. Of several videos of a session the first by path counts."""
    if videos is not None:
        first = videos.groupBy(*key).agg(F.min("path").alias("path"))
        frames = frames.join(first, "path").select(*key, "frame_idx", "t_s")
    of = [k for k in key if k in frames.columns]
    on = [k for k in of if k in cs_frames.columns]
    wanted = cs_frames.select(*on, F.col("first_cs_frame").alias("frame_idx"))
    shown = frames.select(*of, "frame_idx", F.col("t_s").alias("frame_s")).join(wanted, [*on, "frame_idx"])
    shown = shown.groupBy(*of).agg(F.min("frame_s").alias("frame_s"))
    both = onsets.join(shown, of, "left").withColumn("offset_s", F.col("first_cs_s") - F.col("frame_s"))
    there = F.col("offset_s").isNotNull()
    video, recording = split_offset(F.col("offset_s"))
    return both.select(*key, "offset_s", F.when(there, video).alias("video_offset"), F.when(there, recording).alias("recording_offset"), there.alias("aligned"))


def shifted_frames(frames: DataFrame, offsets: DataFrame, key: list[str]) -> DataFrame:
    """Frame times on the session's clock; unaligned sessions keep theirs (Q1)."""
    return frames.join(offsets.select(*key, "video_offset"), key, "left").withColumn("t_s", F.col("t_s") + F.coalesce("video_offset", F.lit(0.0)))


def with_first(rows: DataFrame, key: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """rows with the value of their key's first row: one aggregate, written before the join, so that no key's rows are buffered
    and Spark can split those of a hot one."""
    first = shared.written(rows.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)]).agg(F.min_by(F.struct(value), F.struct(*order)).alias("_first")), "first")
    on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(key)]
    return rows.join(first, on).withColumn(name, F.col(f"_first.{value}")).drop("_first", *[f"_k{i}" for i in range(len(key))])


def relative_to_first(rows: DataFrame, key: list[str], order: list[str], at: str, column: str = "start_s") -> DataFrame:
    """Seconds since the key's first row (W4, W5); each trial gets its own offset, the first 0 (Q3)."""
    return with_first(rows, key, order, at, "_at").withColumn(column, seconds_between(F.col(at), F.col("_at"))).drop("_at")


def with_stop(rows: DataFrame, start: str = "start_s", duration: str = "duration_s") -> DataFrame:
    """W4."""
    return rows.withColumn("stop_s", F.col(start) + F.col(duration))


def no_negative_start(frames: DataFrame, key: list[str], start: DataFrame | None = None) -> DataFrame:
    """If a video's first frame is before 0 all its frames move up by that; then the start is added."""
    rows = with_first(frames, key, ["frame_idx"], "t_s", "_at0")
    add = F.lit(0.0)
    if start is not None:
        rows, add = rows.join(start.select(*key, "start_s"), key, "left"), F.coalesce("start_s", F.lit(0.0))
    return rows.withColumn("t_s", F.col("t_s") - F.least("_at0", F.lit(0.0)) + add).drop("_at0", "start_s")


def concatenated(segments: list[DataFrame]) -> DataFrame:
    """Frame times of a video in several files, segment by segment."""
    out = segments[0].withColumn("segment", F.lit(0))
    for k, s in enumerate(segments[1:], 1):
        out = out.unionByName(s.withColumn("segment", F.lit(k)))
    return out


def epochs(frames: DataFrame, key: list[str], at: str = "t_s") -> DataFrame:
    """First and last time of each video (A10); numbered tags as the reference writes them."""
    g = frames.groupBy(*key).agg(F.min(at).alias("start_s"), F.max(at).alias("stop_s"))
    n = F.row_number().over(Window.partitionBy(*key[:-1]).orderBy("start_s", key[-1])) if len(key) > 1 else F.lit(1)
    return g.withColumn("tags", F.array(F.format_string("%02d", n)))


def extents(rows: DataFrame, key: list[str], start: str, duration: str) -> DataFrame:
    """Least start, greatest start and greatest end."""
    end = F.col(start) + F.coalesce(F.col(duration), F.lit(0.0))
    return rows.groupBy(*key).agg(F.min(start).alias("first_s"), F.max(start).alias("last_start_s"), F.max(end).alias("last_stop_s"))

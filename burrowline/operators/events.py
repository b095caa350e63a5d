"""Behavioural events: scoring projects to marks, marks to bouts, bouts to ragged tables and back (SC6, R5-R8, W2, A13, A15, J13, U3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from burrowline.functions.scalar import number, whole


def marks(projects: DataFrame, aligned: DataFrame | None = None) -> DataFrame:
    """Scoring projects (observations map, see sources) to one row per mark: element 0 is the time, 2 the label, 3 the frame
    (R7). ord is the place in the array. An aligned start replaces the observation's own offset (Q7); it goes by observation
    and by whatever else both sides share, such as the project's path."""
    keep = [c for c in projects.columns if c not in ("observations", "behaviors_conf")]
    obs = projects.select(*keep, F.explode("observations").alias("observation_id", "o"))
    rows = obs.select(*keep, "observation_id", F.col("o.`time offset`").alias("time_offset"), F.posexplode("o.events").alias("ord", "e"))
    if aligned is not None:
        own = [c for c in aligned.columns if c in (*keep, "observation_id")]
        rows = rows.join(aligned.select(*own, "aligned_start"), own, "left")
    offset = F.coalesce(*([F.col("aligned_start")] if aligned is not None else []), F.col("time_offset"), F.lit(0.0))
    at = lambda k: F.try_element_at("e", F.lit(k + 1))
    return rows.select(*keep, "observation_id", "ord", (number(at(0)) + offset).alias("t_s"), at(2).alias("label"), whole(at(3), "bigint").alias("frame"))


def behaviours(projects: DataFrame) -> DataFrame:
    """label, kind (state or point; anything else null) and description of each configured behaviour."""
    keep = [c for c in projects.columns if c not in ("observations", "behaviors_conf")]
    b = projects.select(*keep, F.explode("behaviors_conf").alias("_k", "b"))
    kind = F.lower(F.col("b.type"))
    return b.select(*keep, F.col("b.code").alias("label"), F.when(kind.contains("state"), "state").when(kind.contains("point"), "point").alias("kind"), F.col("b.description").alias("description"))


def media_rate(projects: DataFrame) -> DataFrame:
    """First frame rate of each observation, the resolution, and whether the media differ."""
    rates = F.map_values("o.media_info.fps")
    keep = [c for c in projects.columns if c not in ("observations", "behaviors_conf")]
    obs = projects.select(*keep, F.explode("observations").alias("observation_id", "o"))
    return obs.select(*keep, "observation_id", F.try_element_at(rates, F.lit(1)).alias("fps"), F.try_divide(F.lit(1.0), F.try_element_at(rates, F.lit(1))).alias("resolution"), (F.size(F.array_distinct(rates)) > 1).alias("fps_differ"))


def numbered_marks(rows: DataFrame, key: list[str], order: list[str], time: str) -> DataFrame:
    """Marks of a key numbered in order, with the next mark's time: odd ones start a bout."""
    w = Window.partitionBy(*key).orderBy(*order)
    return rows.withColumn("n", F.row_number().over(w)).withColumn("next_time", F.lead(time).over(w))


def state_bouts(rows: DataFrame, key: list[str], order: list[str], time: str) -> DataFrame:
    """Complete pairs of state marks: bout number, start and stop. Pairs follow the order given, not time (Q6)."""
    n = numbered_marks(rows, key, order, time).filter((F.col("n") % 2 == 1) & F.col("next_time").isNotNull())
    return n.select(*key, ((F.col("n") + 1) / 2).cast("int").alias("bout"), F.col(time).alias("start"), F.col("next_time").alias("stop"))


def unmatched_marks(rows: DataFrame, key: list[str], order: list[str], time: str) -> DataFrame:
    """Dangling last starts; the rest of their session stays (Q5)."""
    n = numbered_marks(rows, key, order, time).filter((F.col("n") % 2 == 1) & F.col("next_time").isNull())
    return n.select(*key, F.col("n").alias("n_marks"), F.col(time).alias("start"))


def annotated_events(rows: DataFrame, kinds: DataFrame, key: list[str]) -> DataFrame:
    """State bouts and point events (null duration) in one long table; labels of neither kind are left out. kinds go by
    label and by whatever else both sides share, such as the project's path."""
    own = [c for c in kinds.columns if c in rows.columns]  # label, and the project that both are of
    typed = rows.join(kinds.select(*own, "kind").distinct(), own)
    states = state_bouts(typed.filter("kind = 'state'"), [*key, "label"], ["ord"], "t_s")
    states = states.select(*key, "label", F.col("bout").alias("ord"), F.col("start").alias("start_s"), (F.col("stop") - F.col("start")).alias("duration_s"))
    points = typed.filter("kind = 'point'").withColumn("ord", F.row_number().over(Window.partitionBy(*key, "label").orderBy("ord")))
    return states.unionByName(points.select(*key, "label", "ord", F.col("t_s").alias("start_s"), F.lit(None).cast("double").alias("duration_s")))


def ragged(long: DataFrame, key: list[str], labels: DataFrame | None = None) -> DataFrame:
    """Per label the ordered times and durations; configured labels without events keep empty arrays."""
    g = long.groupBy(*key, "label").agg(F.sort_array(F.collect_list(F.struct("ord", "start_s", "duration_s"))).alias("_e"))
    g = g.select(*key, "label", F.transform("_e", lambda x: x["start_s"]).alias("event_times"), F.transform("_e", lambda x: x["duration_s"]).alias("duration"))
    if labels is None:
        return g
    every = labels.join(g, [*key, "label"], "left")
    empty = F.array().cast("array<double>")
    return every.select(*labels.columns, F.coalesce("event_times", empty).alias("event_times"), F.coalesce("duration", empty).alias("duration"))


def unragged(table: DataFrame, key: list[str]) -> DataFrame:
    """Ragged arrays back to rows (R8); intervals are those with a duration (F16)."""
    rows = table.select(*key, "label", F.posexplode(F.arrays_zip("event_times", "duration")).alias("_i", "_e"))
    return rows.select(*key, "label", (F.col("_i") + 1).alias("ord"), F.col("_e.event_times").alias("start_s"), F.col("_e.duration").alias("duration_s"))


def with_trial_type(sample: DataFrame, test: DataFrame) -> DataFrame:
    """Events of the sample and of the test under one session."""
    return sample.withColumn("trial_type", F.lit("sample")).unionByName(test.withColumn("trial_type", F.lit("test")), allowMissingColumns=True)


def object_info(sheet: DataFrame, key: list[str], trial: str = "trial") -> DataFrame:
    """Wide object sheet (Obj_, Pos_, ID_, ObjName_ A..D) to a row per object; NaN as null, trial type from the text."""
    present = set(sheet.columns)

    def cell(prefix: str, k: str) -> Column:
        c = f"{prefix}_{k}"
        v = F.col(c).cast("string") if c in present else F.lit(None).cast("string")
        return F.when(~F.lower(v).isin("nan", ""), v)

    one = lambda k: F.struct(cell("Obj", k).alias("label"), cell("Pos", k).alias("position"), cell("ID", k).alias("novelty"), cell("ObjName", k).alias("object"))
    kind = F.when(F.lower(trial).contains("sample"), "sample").when(F.lower(trial).contains("test"), "test")
    rows = sheet.select(*key, kind.alias("trial_type"), F.posexplode(F.array(*[one(k) for k in "ABCD"])).alias("ord", "o"))
    return rows.select(*key, "trial_type", "ord", "o.*").filter(F.col("label").isNotNull())


def enrich(events: DataFrame, info: DataFrame, key: list[str], values: list[str], order: list[str]) -> DataFrame:
    """Attach what is known of each label, empty text where nothing is; the last entry of a key wins."""
    n = F.row_number().over(Window.partitionBy(*key).orderBy(*[F.desc(c) for c in order]))
    last = info.withColumn("_n", n).filter("_n = 1").select(*key, *values)
    return events.join(last, key, "left").fillna("", values)


def intervals(df: DataFrame) -> DataFrame:
    """Events that last: those with a duration (F16)."""
    return df.filter(F.col("duration_s").isNotNull() & ~F.isnan("duration_s"))


def labelled(df: DataFrame, column: str = "object") -> DataFrame:
    """F15."""
    return df.filter(F.col(column) != "")

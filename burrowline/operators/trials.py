"""Trial sheets: freeze scores, swim trials, their blocks and videos."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from burrowline.functions.scalar import day_and_clock, number, whole
from burrowline.operators.align import relative_to_first, with_stop

#: The order of a block's columns.
QUADRANTS = ("NE", "NW", "SW", "SE")
ZONES = ("NE", "NE_A", "SE", "SE_A", "SW", "SW_A", "NW", "NW_A")
#: Header, column and type of the seven standard metrics.
STANDARD = (
    ("Platform", "platform", "string"),
    ("Time to platform", "time_to_platform", "double"),
    ("Trial duration", "trial_duration", "double"),
    ("Distance travelled (cm)", "distance_travelled_cm", "double"),
    ("Average speed", "average_speed", "double"),
    ("% time near walls", "percent_time_near_walls", "double"),
    ("Platform Quadrant", "platform_quadrant", "int"),
)


#: The headers of the other columns, and of the blocks' first cells.
OTHERS = {"animal": "Animal", "day": "Day", "date": "Date", "time": "Time"}
SECONDS, PERCENT, REACHED, CROSSINGS, ZONE = "Quadrant time (sec)", "Quadrant time (%)", "Time to platform", "Platform crossings", "Zone (% time)"


def swim_places(header: Column) -> Column:
    """Where a sheet has each column and each block's first cell, as a struct of numbers from 0, null for what it lacks. Only
    the first cell of a block has a header. The platform's block is the second column of that name, or the only one; it and
    the crossings belong to sheets with quadrants (F21)."""
    at = lambda name: (F.nullif(F.array_position(header, name), F.lit(0)) - 1).cast("int")
    every = F.filter(F.sequence(F.lit(0), F.size(header) - 1), lambda i: F.coalesce(F.get(header, i) == REACHED, F.lit(False)))
    zone = F.array_position(F.transform(header, lambda h: F.coalesce(h.contains(ZONE), F.lit(False))), True)
    has = at(SECONDS).isNotNull()
    return F.struct(
        *[at(h).alias(name) for name, h in OTHERS.items()], *[at(h).alias(name) for h, name, _ in STANDARD], at(SECONDS).alias("seconds"), at(PERCENT).alias("percent"),
        F.when(has, F.coalesce(F.get(every, F.lit(1)), F.get(every, F.lit(0)))).alias("reached"), F.when(has, at(CROSSINGS)).alias("crossings"), (F.nullif(zone, F.lit(0)) - 1).cast("int").alias("zone"),
    )


def swim_trials(sheet: DataFrame, key: list[str]) -> DataFrame:
    """Sheets (c, the cells, and at, the places of their own file's columns) to typed trials (F21, F22, R2, R3). Blocks go by
    position; columns and blocks that a file lacks become nulls, so that all files share a schema."""
    cell = lambda name, k=0: F.get("c", F.col(f"at.{name}") + k)
    typed = {"string": lambda c: c, "double": number, "int": whole}
    block = lambda name, parts, label: [number(cell(name, k)).alias(label.format(n)) for k, n in enumerate(parts)]
    cols = [typed[kind](cell(name)).alias(name) for _, name, kind in STANDARD]
    cols += block("seconds", QUADRANTS, "time_in_{}_quadrant") + block("percent", QUADRANTS, "percent_time_in_{}_quadrant")
    cols += block("reached", QUADRANTS, "time_to_platform_{}") + block("crossings", QUADRANTS, "platform_crossings_{}") + block("zone", ZONES, "zone_percent_time_{}")
    return sheet.select(*key, "row_no", cell("animal").alias("animal"), whole(cell("day")).alias("day"), day_and_clock(cell("date"), cell("time")).alias("ts"), *cols)


def of_animal(rows: DataFrame, animal: str, column: str = "animal") -> DataFrame:
    """a plain substring, as the reference matches."""
    return rows.filter(F.col(column).contains(animal))


def timed(trials: DataFrame, key: list[str]) -> DataFrame:
    """Start relative to the session's first trial, stop after the trial's duration."""
    return with_stop(relative_to_first(trials, key, ["row_no"], "ts"), "start_s", "trial_duration")


def by_day(trials: DataFrame, key: list[str]) -> DataFrame:
    """Trials of each date: first day number, first time, count (A5)."""
    return trials.groupBy(*key, F.to_date("ts").alias("date")).agg(F.min_by("day", "row_no").alias("day"), F.min("ts").alias("first_ts"), F.count("*").alias("n_trials"))


def quadrants_long(trials: DataFrame, key: list[str]) -> DataFrame:
    """R2 as rows."""
    one = lambda q: F.struct(F.lit(q).alias("quadrant"), F.col(f"time_in_{q}_quadrant").alias("seconds"), F.col(f"percent_time_in_{q}_quadrant").alias("percent"), F.col(f"time_to_platform_{q}").alias("time_to_platform"), F.col(f"platform_crossings_{q}").alias("crossings"))
    return trials.select(*key, F.inline(F.array(*[one(q) for q in QUADRANTS])))


def metrics_long(df: DataFrame, key: list[str], metrics: list[str], name: str = "metric", value: str = "value") -> DataFrame:
    """Columns to rows."""
    return df.unpivot(key, metrics, name, value)


def freeze_trials(sheet: DataFrame, row_no: str = "row_no", key: list[str] | None = None) -> DataFrame:
    """Freeze-score sheets to one row per animal row and bin (R1): row 0 has onsets, row 1 durations, row 2 the bout duration
    beside the threshold column; bins lie left of it. The cells are the array c, with animal_at the animals' place, or else
    the columns beside the key. Each key has its own threshold column; a key without one has no bins."""
    key = key or []
    if dict(sheet.dtypes).get("c") == "array<string>":
        cells, animal = F.col("c"), F.col("animal_at") if "animal_at" in sheet.columns else F.lit(0)
    else:
        cells, animal = F.array(*[F.col(f"`{c}`").cast("string") for c in sheet.columns if c not in (row_no, *key)]), F.lit(0)
    rows = sheet.select(*key, F.col(row_no).alias("row_no"), cells.alias("c"), animal.alias("animal_at"))
    of = lambda df: df.groupBy(*key) if key else df.groupBy()
    edge = F.array_position(F.transform("c", lambda x: F.coalesce(x.contains("Threshold"), F.lit(False))), True)
    edges = of(rows).agg(F.min(F.when(edge > 0, edge)).cast("int").alias("edge"))  # over all rows, but of numbers
    line = lambda n: F.max(F.when(F.col("row_no") == n, F.col("c")))
    lines = of(rows.filter("row_no <= 2")).agg(line(0).alias("onset"), line(1).alias("lasts"), line(2).alias("third"))
    body = rows.filter("row_no >= 2")
    both = body.join(edges.join(lines, key), key) if key else body.join(F.broadcast(edges.join(F.broadcast(lines))))  # one row each
    at = lambda c, i: F.get(c, F.col("edge") - 1 + i)
    bins = F.posexplode(F.slice("c", F.lit(2), F.greatest(F.coalesce("edge", F.lit(2)) - 2, F.lit(0))))
    long = both.select(*key, F.col("row_no").alias(row_no), F.get("c", F.col("animal_at")).alias("animal"), at("c", 0).alias("threshold"), at("c", 2).alias("protocol"), at("third", 1).alias("bout"), "onset", "lasts", bins.alias("bin", "v"))
    start, lasts = number(F.get("onset", F.col("bin") + 1)), number(F.get("lasts", F.col("bin") + 1))
    return long.select(*key, row_no, "animal", "threshold", "protocol", "bin", number(F.col("v")).alias("freezing"), start.alias("start_s"), lasts.alias("duration_s"), number(F.col("bout")).alias("bout_duration"), (start + lasts).alias("stop_s"))


def paired_by_position(left: DataFrame, right: DataFrame, key: list[str], left_order: list, right_order: list, how: str = "inner") -> DataFrame:
    """The n-th row of one side with the n-th of the other within each key (J14); a full join shows those without partner."""
    n = lambda df, order: df.withColumn("nth", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    return n(left, left_order).join(n(right, right_order), [*key, "nth"], how)

"""Measures of the behavioural tasks (A16-A21, W11, R9, R12, X13). The clipping rules are this library's own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from burrowline.functions.scalar import intensity
from burrowline.operators import scans


def heat_map(rows: DataFrame, row: str, column: str, value: str, columns: list | None = None) -> DataFrame:
    """Value of each row and column."""
    return rows.groupBy(row).pivot(column, columns).agg(F.sum(value))


def discrimination_index(rows: DataFrame, key: list[str], kind: str, value: str, novel: str = "novel", familiar: str = "familiar") -> DataFrame:
    """(novel - familiar) / (novel + familiar) of exploration time; null without any."""
    total = lambda v: F.coalesce(F.sum(F.when(F.col(kind) == v, F.col(value))), F.lit(0.0))
    g = rows.groupBy(*key).agg(total(novel).alias("novel"), total(familiar).alias("familiar"))
    return g.withColumn("di", F.try_divide(F.col("novel") - F.col("familiar"), F.col("novel") + F.col("familiar")))


def running_total(rows: DataFrame, key: list[str], order: list[str], value: str, column: str = "cumulative") -> DataFrame:
    """W11."""
    return scans.running_sum(rows, key, order, value, column).drop(scans.BLOCK)


def bin_runs(bouts: DataFrame, key: list[str], width: float, start: str = "start_s", stop: str = "stop_s") -> DataFrame:
    """Exploration in bins of a width as runs of equal bins: first_bin, n_bins, seconds (in each) and before (until the run)
    (A18), by a sweep over the bouts' ends. A bout has seconds of its own in its first and last bin and fills those between,
    which +1 and -1 at their ends say; nothing is made per bin. A bout that ends on a bound doesn't touch the next bin."""
    a, z = F.col(start), F.col(stop)
    first = F.floor(a / width)
    last = F.greatest(F.ceil(z / width) - 1, first)
    mark = lambda at, part, fill, own: F.struct(at.alias("bin"), part.cast("double").alias("part"), fill.alias("fill"), F.lit(own).alias("own"))
    fills = (last > first + 1).cast("int")
    ends = F.array(
        mark(first, F.least(z, (first + 1) * width) - a, F.lit(0), True), mark(last, F.when(last > first, z - last * width).otherwise(0.0), F.lit(0), True),
        mark(first + 1, F.lit(0.0), fills, False), mark(last, F.lit(0.0), -fills, False),
    )
    swept = bouts.filter(a.isNotNull() & z.isNotNull()).select(*key, F.inline(ends)).groupBy(*key, "bin").agg(F.sum("part").alias("part"), F.sum("fill").alias("fill"), F.bool_or("own").alias("own"))
    line = scans.running_sum(scans.blocked(swept, key, "bin"), key, ["bin"], "fill", "full")
    line = scans.neighbour(line, key, ["bin"], ["bin"], "next")
    gap = F.coalesce(F.col("next.bin") - F.col("bin") - 1, F.lit(0))
    filled = F.col("full") * width
    line = line.withColumns({"gap": gap, "seconds": F.col("part") + filled, "rest": filled}).withColumn("both", F.col("seconds") + F.col("gap") * F.col("rest"))
    line = scans.running_sum(line, key, ["bin"], "both", "upto").withColumn("before", F.col("upto") - F.col("both"))
    run = lambda at, n, seconds, before: F.struct(at.alias("first_bin"), n.cast("long").alias("n_bins"), seconds.alias("seconds"), before.alias("before"))
    runs = F.array(run(F.col("bin"), F.when(F.col("own") | (F.col("full") > 0), 1).otherwise(0), F.col("seconds"), F.col("before")), run(F.col("bin") + 1, F.when(F.col("full") > 0, F.col("gap")).otherwise(0), F.col("rest"), F.col("before") + F.col("seconds")))
    return line.select(*key, F.inline(runs)).filter("n_bins > 0")


def accumulated(bouts: DataFrame, key: list[str], width: float) -> DataFrame:
    """Exploration per bin and up to its end (A18): the runs, a row for each of their bins."""
    each = bin_runs(bouts, key, width).select(*key, "first_bin", "seconds", "before", F.explode(F.sequence(F.col("first_bin"), F.col("first_bin") + F.col("n_bins") - 1)).alias("bin"))
    return each.select(*key, "bin", "seconds", (F.col("before") + F.col("seconds") * (F.col("bin") - F.col("first_bin") + 1)).alias("cumulative"))


def di_at(bouts: DataFrame, key: list[str], order: list[str], kind: str, value: str, threshold: float, novel: str = "novel", familiar: str = "familiar") -> DataFrame:
    """Discrimination index when exploration has reached a total; the bout that reaches it is clipped (A19). Keys that never
    reach it have no row."""
    own = lambda v: F.sum(F.when(F.col(kind) == v, F.col(value)).otherwise(0.0)).over(Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    rows = running_total(bouts, key, order, value).withColumns({"_n": own(novel), "_f": own(familiar)})
    first = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    hit = rows.filter(F.col("cumulative") >= threshold).withColumn("_k", first).filter("_k = 1")
    over = F.col("cumulative") - threshold
    cut = lambda c, v: F.col(c) - F.when(F.col(kind) == v, over).otherwise(0.0)
    n, f = cut("_n", novel), cut("_f", familiar)
    return hit.select(*key, *[F.col(c) for c in order], n.alias("novel"), f.alias("familiar"), F.try_divide(n - f, n + f).alias("di"))


def latency(rows: DataFrame, key: list[str], label: str, wanted: str, at: Column, default_s: float = 120.0) -> DataFrame:
    """Seconds to the first wanted event, the default if there is none (A20). at: seconds since the trial's start."""
    return rows.groupBy(*key).agg(F.coalesce(F.min(F.when(F.col(label) == wanted, at)), F.lit(default_s)).alias("latency_s"))


def phase_means(bins: DataFrame, phases: DataFrame, key: list[str], value: str, duration: str, phase_key: str) -> DataFrame:
    """Duration-weighted mean of each phase."""
    rows = bins.join(F.broadcast(phases), phase_key)
    return rows.groupBy(*key, "phase").agg(F.try_divide(F.sum(F.col(value) * F.col(duration)), F.sum(duration)).alias("mean"))


def raster_runs(trials: DataFrame, key: list[str], start: str, stop: str, length: Column) -> DataFrame:
    """Runs of seconds that the same number of intervals cover: first_second, past_second and n (R9), by a sweep: +1 where an
    interval begins and -1 where it ends, half-even rounded bounds, below the given length."""
    a, z = F.rint(start).cast("long"), F.least(F.rint(stop).cast("long"), length.cast("long"))
    ends = F.array(F.struct(a.alias("second"), F.lit(1).alias("step")), F.struct(z.alias("second"), F.lit(-1).alias("step")))
    swept = trials.filter(z > a).select(*key, F.inline(ends)).groupBy(*key, "second").agg(F.sum("step").alias("step")).filter("step <> 0")
    line = scans.running_sum(scans.blocked(swept, key, "second"), key, ["second"], "step", "n")
    line = scans.neighbour(line, key, ["second"], ["second"], "next").filter("n > 0")
    return line.select(*key, F.col("second").alias("first_second"), F.col("next.second").alias("past_second"), "n")


def raster(trials: DataFrame, key: list[str], start: str, stop: str, length: Column, value: str | None = None) -> DataFrame:
    """Seconds that intervals cover, how many do, and with which intensity (R9, X13): key, second, n and intensity. Intervals
    of one intensity are swept together; a row per second is made at the end only."""
    rows = trials.withColumn("intensity", intensity(F.col(value))) if value else trials
    kept = [*key, "intensity"] if value else key
    runs = raster_runs(rows, kept, start, stop, length)
    return runs.select(*kept, F.explode(F.sequence("first_second", F.col("past_second") - 1)).alias("second"), "n")


def periodic_marks(extent: DataFrame, end: str, step: int = 100) -> DataFrame:
    """0, step, 2 step ... below the end."""
    return extent.withColumn("mark", F.explode(F.when(F.col(end) > 0, F.sequence(F.lit(0).cast("long"), F.col(end).cast("long") - 1, F.lit(step).cast("long")))))

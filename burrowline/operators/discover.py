"""From subjects, session lists and file listings to sessions and rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from burrowline.functions.scalar import natural_key
from burrowline.operators import products, substrings
from burrowline.operators.guards import exactly_one
from burrowline.sources import shared


def did_task(subjects: DataFrame, task: str, column: str = "tasks") -> DataFrame:
    """Subjects that did a task; those without a list didn't (F1, Q16)."""
    return subjects.filter(F.coalesce(F.array_contains(column, task), F.lit(False)))


def session_matrix(subjects: DataFrame, sessions: DataFrame, on: list[str]) -> DataFrame:
    """Every subject with every session of its task."""
    return subjects.join(sessions, on)


def missing(expected: DataFrame, found: DataFrame, on: list[str]) -> DataFrame:
    """Expected but not found (U4)."""
    return expected.join(found.select(*on).distinct(), on, "left_anti")


def folder_of(line: Column, cohort: Column, task: Column, session: Column) -> Column:
    """Where a session's raw files lie."""
    return F.concat(line, F.lit("/"), cohort, F.lit("_"), task, F.lit("/"), session)


def with_folder(sessions: DataFrame, files: DataFrame, folder: str = "dir") -> DataFrame:
    """Attach the files of a session's folder; sessions without one keep a null name."""
    return products.attached(sessions, files, [folder])


def match_names(rows: DataFrame, files: DataFrame, block: list[str], key: list[str], patterns: list[Column], name: str = "name") -> DataFrame:
    """Files whose name contains the row's first pattern; where none does, the second, and so on (J4). block: equal columns
    of rows and files. Adds prio and n_match."""
    asked = rows.select("*", F.posexplode(F.array(*[p.cast("string") for p in patterns])).alias("prio", "_pattern"))
    pairs = substrings.containing(files, asked, block, name, "_pattern")
    hit = asked.join(pairs, [*block, "_pattern"]).join(files, [*block, name]).drop("_pattern")
    w = Window.partitionBy(*key)
    return hit.withColumn("_best", F.min("prio").over(w)).filter(F.col("prio") == F.col("_best")).drop("_best").withColumn("n_match", F.count("*").over(w))


def first_file(rows: DataFrame, files: DataFrame, block: list[str], key: list[str], patterns: list[Column], order: list[str], name: str = "name") -> DataFrame:
    """key, prio and the columns order of the first file, by order, whose name contains the row's first pattern; where none
    does, the second, and so on (J4, W7). order begins with the name, or what follows from it; key goes with the block.

    What is first is found once for each pattern, so rows that share a pattern don't meet all its files."""
    asked = rows.select(*dict.fromkeys([*key, *block]), F.posexplode(F.array(*[p.cast("string") for p in patterns])).alias("prio", "_pattern"))
    of_name = files.groupBy(*block, name).agg(F.min(F.struct(*order)).alias("_file"))
    pairs = substrings.containing(of_name, asked, block, name, "_pattern")
    of_pattern = pairs.join(of_name, [*block, name]).groupBy(*block, "_pattern").agg(F.min("_file").alias("_file"))
    best = asked.join(shared.written(of_pattern, "first"), [*block, "_pattern"]).groupBy(*key).agg(F.min(F.struct("prio", "_file")).alias("_best"))
    return best.select(*key, "_best.prio", *[F.col(f"_best._file.{c}").alias(c) for c in order])


def ambiguous(matches: DataFrame, ids: DataFrame, block: list[str], own: str, other: str, name: str = "name") -> DataFrame:
    """Whether the name of a matched file also contains another registered id (Q12): ambiguous_match."""
    every = ids.select(*block, F.col(other).cast("string").alias("_other"))
    held = substrings.containing(matches, every, block, name, "_other").groupBy(*block, name).agg(F.min("_other").alias("_lo"), F.max("_other").alias("_hi"))
    mine = F.col(own).cast("string")
    also = ~(F.col("_lo").eqNullSafe(mine) & F.col("_hi").eqNullSafe(mine)) & F.col("_lo").isNotNull()
    return matches.join(held, [*block, name], "left").withColumn("ambiguous_match", also).drop("_lo", "_hi")


def first_match(matches: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The preferred match per key."""
    n = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return matches.withColumn("_n", n).filter("_n = 1").drop("_n")


def suffix_preference(suffix: Column, order: tuple[str, ...] = (".avi", ".mp4", ".mkv")) -> Column:
    """Position of a suffix in the order of preference."""
    out = F.lit(len(order))
    for k, s in reversed(list(enumerate(order))):
        out = F.when(suffix == s, F.lit(k)).otherwise(out)
    return out


def match_observation(rows: DataFrame, observations: DataFrame, block: list[str], key: list[str], animal: Column, *also: Column, first: bool = True) -> DataFrame:
    """Scoring observations whose id contains the animal's (cast to string: Q13) and everything else asked for."""
    asked = rows.withColumn("_pattern", animal.cast("string"))
    pairs = substrings.containing(observations, asked, block, "observation_id", "_pattern")
    hit = asked.join(pairs, [*block, "_pattern"]).join(observations, [*block, "observation_id"]).drop("_pattern")
    for c in also:
        hit = hit.filter(c)
    return first_match(hit, key, [F.col("observation_id")]) if first else hit


def _left_match(rows: DataFrame, found: DataFrame, block: list[str], key: list[str], name: str, pattern: Column) -> DataFrame:
    """Every row with each of the block's names that contain its pattern, once with nulls where none does; and a reason for keys
    without exactly one. Names are counted by pattern, so that nothing is sorted or moved for each row with each name."""
    asked, on = rows.withColumn("_pattern", pattern), [*block, "_pattern"]
    hits = shared.written(substrings.containing(found, asked, block, name, "_pattern").join(found, [*block, name]), "hits")
    counted = asked.join(hits.groupBy(*on).agg(F.count("*").alias("_n")), on, "left")
    judged = exactly_one(counted, key, hits=F.sum(F.coalesce("_n", F.lit(0)))).drop("_n")
    return products.attached(judged, hits, on).drop("_pattern")


def unique_observation(rows: DataFrame, observations: DataFrame, block: list[str], key: list[str], pattern: Column) -> DataFrame:
    """Exactly one observation or a reason (Q9)."""
    return _left_match(rows, observations, block, key, "observation_id", pattern)


def match_second_token(sessions: DataFrame, files: DataFrame, block: list[str], key: list[str], session: str = "session", name: str = "name") -> DataFrame:
    """The one analysis file whose name contains the second part of the session id."""
    token = F.try_element_at(F.split(F.col(session), "_"), F.lit(2))
    return _left_match(sessions, files.select(*block, name), block, key, name, token)


def side_file(sessions: DataFrame, files: DataFrame, on: list[str], name: str, as_list: bool = False) -> DataFrame:
    """Optional files of a session: the first by name, or all in natural order."""
    how = F.transform(F.array_sort(F.collect_list(F.struct(natural_key(F.col("name")).alias("k"), F.col("name").alias("n")))), lambda x: x["n"]) if as_list else F.min("name")
    return sessions.join(files.groupBy(*on).agg(how.alias(name)), on, "left")


def without_stimulus(files: DataFrame, name: str = "name") -> DataFrame:
    """F4."""
    return files.filter(~F.lower(name).contains("stim"))


def numbered(df: DataFrame, key: list[str], order: list[Column], column: str = "trial", prefix: str | None = None) -> DataFrame:
    """1..n within each key, and a name made of it."""
    out = df.withColumn(column, F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    return out.withColumn(f"{column}_name", F.concat(F.lit(prefix), F.col(column))) if prefix else out


def consecutive_days(rows: DataFrame, key: list[str], day: str, tie: list[str]) -> DataFrame:
    """Pairs of a row and the next one where that lies a day later, across month ends too."""
    cols = [day, *tie]
    w = Window.partitionBy(*key).orderBy(*cols)
    nxt = F.lead(F.struct(*cols)).over(w)
    return rows.withColumn("next", nxt).filter(F.datediff(F.col(f"next.{day}"), day) == 1)


def session_start(rows: DataFrame, key: list[str], start: str = "start_ts") -> DataFrame:
    """A3."""
    return rows.groupBy(*key).agg(F.min(start).alias(start))


def by_date(videos: DataFrame, key: list[str], start: str = "start_ts", path: str = "path") -> DataFrame:
    """Videos of each calendar date in order (A4)."""
    return videos.groupBy(*key, F.to_date(start).alias("date")).agg(F.sort_array(F.collect_list(F.struct(start, path))).alias("videos"))


def distinct_sessions(paths: DataFrame, *cols: str) -> DataFrame:
    """U5."""
    return paths.select(*cols).distinct()


def keep_last(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Later files and rows overwrite earlier ones."""
    return first_match(df, key, [F.desc(c) for c in order])

"""Catalogue operations: restrictions, cascades, inserts, deletes, reports (F24-F26, J15-J17, SK4-SK8)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burrowline.operators.discover import first_match
from burrowline.operators.guards import exactly_one


def restrict(table: DataFrame, by: dict | str | DataFrame | list[dict]) -> DataFrame:
    """Rows that equal a dict's values (F24; null matches null), pass a SQL predicate (F25), or share the keys of a table or of
    one of several dicts (J15)."""
    if isinstance(by, str):
        return table.filter(by)
    if isinstance(by, dict):
        return table.filter(reduce(lambda a, b: a & b, [F.col(f"`{k}`").eqNullSafe(F.lit(v)) for k, v in by.items()], F.lit(True)))
    if isinstance(by, list):
        return table.filter(reduce(lambda a, b: a | b, [reduce(lambda x, y: x & y, [F.col(f"`{k}`").eqNullSafe(F.lit(v)) for k, v in d.items()], F.lit(True)) for d in by], F.lit(False)))
    shared = [c for c in table.columns if c in by.columns]
    return table.join(by.select(*shared), shared, "left_semi") if shared else table


def fetch(table: DataFrame, column: str) -> DataFrame:
    """Distinct values of one column."""
    return table.select(column).distinct()


def fetch_one(table: DataFrame, column: str, key: list[str]) -> DataFrame:
    """The value of the key's one row, with a reason where there are several."""
    return exactly_one(table, key).select(*key, column, "reason")


def cascade(tables: dict[str, DataFrame], links: list[tuple[str, str, dict[str, str]]], root: str, by: dict | str | DataFrame) -> dict[str, DataFrame]:
    """A restriction of root carried to all its descendants (J17). links in topological order: (parent, child, {child column:
    parent column}). A child with several restricted parents keeps rows that all of them reach."""
    out = {root: restrict(tables[root], by)}
    for parent, child, columns in links:
        if parent not in out:
            continue
        keys = out[parent].select(*[F.col(p).alias(f"_k_{c}") for c, p in columns.items()]).distinct()
        current = out.get(child, tables[child])
        out[child] = current.join(keys, [F.col(c) == F.col(f"_k_{c}") for c in columns], "left_semi")
    return out


def insertable(new: DataFrame, existing: DataFrame, key: list[str], parent: DataFrame | None = None, parent_key: list[str] | None = None, order: list[str] | None = None) -> DataFrame:
    """New rows whose parent exists and whose key isn't there yet, one per key: the first by order, or any (J16, SK4)."""
    rows = new
    if parent is not None:
        rows = rows.join(parent.select(*(parent_key or key)), parent_key or key, "left_semi")
    fresh = rows.join(existing.select(*key), key, "left_anti")
    return first_match(fresh, key, [F.col(c) for c in order]) if order else fresh.dropDuplicates(key)


def events_to_insert(events: DataFrame, sessions: DataFrame, existing: DataFrame, key: list[str]) -> DataFrame:
    """Sessions that have events and aren't in the table yet (SK5)."""
    having = sessions.join(events.select(*key), key, "left_semi")
    return having.join(existing.select(*key), key, "left_anti")


def lfp_series(electrodes: DataFrame, signals: DataFrame, meta: DataFrame, key: list[str]) -> DataFrame:
    """Signals of the electrodes whose group is named LFP, with the list of electrodes, rate and interval name (SK6)."""
    chosen = electrodes.filter(F.col("group_name").contains("LFP")).groupBy(*key).agg(F.array_sort(F.collect_list("electrode_id")).alias("electrode_ids"))
    named = chosen.join(meta.select(*key, "rate"), key).withColumn("interval_name", F.lit("raw data valid times"))
    rows = signals.join(named, key)
    return rows.withColumn("v", F.transform("electrode_ids", lambda i: F.get(F.col("v"), i.cast("int"))))


def without_session(tables: dict[str, DataFrame], key: DataFrame) -> dict[str, DataFrame]:
    """Every table without the rows of the session (SK7)."""
    out = {}
    for name, t in tables.items():
        shared = [c for c in key.columns if c in t.columns]
        out[name] = t.join(key.select(*shared), shared, "left_anti") if shared else t
    return out


def unused(dimension: DataFrame, key: str, users: list[DataFrame]) -> DataFrame:
    """Dimension rows that nothing refers to any more (SK7)."""
    return reduce(lambda d, u: d.join(u.select(key), key, "left_anti"), users, dimension)


def report(tables: dict[str, DataFrame], by: dict | str | DataFrame, limit: int = 12) -> dict[str, DataFrame]:
    """The first restricted rows of each table (SK8, O4, O5), in the order of their columns."""
    out = {}
    for name, t in tables.items():
        mine = {k: v for k, v in by.items() if k in t.columns} if isinstance(by, dict) else by
        plain = [c for c, kind in t.dtypes if not kind.startswith("map")]
        out[name] = restrict(t, mine).orderBy(*plain).limit(limit)
    return out

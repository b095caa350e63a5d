"""Restrictions and deletions carried along a declared graph of foreign keys (J17, SK7).

A row descends from the rows that any of its foreign keys refers to, and from what those descend from. The order of the
tables follows from the links: parents first. A link of a table to itself is followed from the rows found last until no new
ones are found. Every table's result is written once, so that a path met twice (a diamond) isn't worked out twice.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burrowline.operators.catalog import restrict
from burrowline.sources import shared


class Link(NamedTuple):
    """child's columns refer to parent's columns: {child column: parent column}."""

    child: str
    parent: str
    columns: dict[str, str]


def ordered(names: list[str], links: list[Link]) -> list[str]:
    """Tables so that parents come before children; a cycle of several tables is an error."""
    left, out = list(names), []
    while left:
        free = [t for t in left if not any(k.child == t and k.parent in left and k.parent != t for k in links)]
        if not free:
            raise ValueError(f"foreign keys go round: {', '.join(left)}")
        out += free
        left = [t for t in left if t not in free]
    return out


def _referring(rows: DataFrame, found: DataFrame, link: Link) -> DataFrame:
    keys = found.select(*[F.col(p).alias(f"_k{i}") for i, p in enumerate(link.columns.values())]).distinct()
    return rows.join(keys, [F.col(c) == F.col(f"_k{i}") for i, c in enumerate(link.columns)], "left_semi")


def descendants(tables: dict[str, DataFrame], keys: dict[str, list[str]], links: list[Link], seeds: dict[str, dict | str | DataFrame]) -> dict[str, DataFrame]:
    """Of each table the rows that are seeds or descend from one (key columns, and those that others refer to). keys: what
    tells a table's rows apart; rows that are the same in that go together."""
    out: dict[str, DataFrame] = {}
    for t in ordered(list(tables), links):
        held = list(dict.fromkeys([*keys[t], *[p for k in links if k.parent == t for p in k.columns.values()]]))
        found = [restrict(tables[t], seeds[t])] if t in seeds else []
        found += [_referring(tables[t], out[k.parent], k) for k in links if k.child == t and k.parent in out and k.parent != t]
        own = [k for k in links if k.child == t and k.parent == t]
        if not found:
            continue
        rows = found[0].select(*held)
        for f in found[1:]:
            rows = rows.unionByName(f.select(*held))
        rows = last = shared.written(rows.distinct(), f"of-{t}")
        while own and not last.isEmpty():
            more = [_referring(tables[t], last, k).select(*held) for k in own]
            step = more[0]
            for m in more[1:]:
                step = step.unionByName(m)
            last = shared.written(step.distinct().join(rows.select(*keys[t]), keys[t], "left_anti"), f"of-{t}")
            rows = rows.unionByName(last)
        out[t] = rows
    return out


def restricted(tables: dict[str, DataFrame], keys: dict[str, list[str]], links: list[Link], seeds: dict[str, dict | str | DataFrame]) -> dict[str, DataFrame]:
    """Of each table the whole rows that are seeds or descend from one; tables without a way from a seed are left out."""
    return {t: tables[t].join(rows.select(*keys[t]).distinct(), keys[t], "left_semi") for t, rows in descendants(tables, keys, links, seeds).items()}


def remaining(tables: dict[str, DataFrame], keys: dict[str, list[str]], links: list[Link], seeds: dict[str, dict | str | DataFrame]) -> dict[str, DataFrame]:
    """Every table without the seeds and what descends from them (SK7)."""
    gone = descendants(tables, keys, links, seeds)
    return {t: df.join(gone[t].select(*keys[t]).distinct(), keys[t], "left_anti") if t in gone else df for t, df in tables.items()}

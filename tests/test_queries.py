"""Every registered query of the library against its SQL, on the smallest tables; the entry module's contract."""

import duckdb
import pytest

from burrowline.plans.registry import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


def plain(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(f"{r[i]:.9g}" if isinstance(r[i], float) else repr(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    found = duck.execute(ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    assert plain([tuple(r) for r in df.collect()], df.columns) == plain(found.fetchall(), names)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert set(QUERIES) == set(ORACLES)

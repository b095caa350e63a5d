"""Queries on the catalogue: restrictions, inserts and deletes."""

from __future__ import annotations

from pyspark.sql import functions as F

from burrowline.operators import catalog, graph
from burrowline.plans.base import query, table
from burrowline.sources import batches, shared, writers

LINKS = [("region", "nation", {"n_regionkey": "r_regionkey"}), ("nation", "customer", {"c_nationkey": "n_nationkey"}), ("customer", "orders", {"o_custkey": "c_custkey"})]


def tables(spark, sf_dir):
    return {t: table(spark, sf_dir, t) for t in ("region", "nation", "customer", "orders", "lineitem")}


@query("SELECT c_custkey, c_name FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1) AND c_acctbal > 0")
def restrict_semi(spark, sf_dir):
    """F24, F25, J15."""
    t = tables(spark, sf_dir)
    keys = catalog.restrict(t["nation"], {"n_regionkey": 1}).select(F.col("n_nationkey").alias("c_nationkey"))
    return catalog.restrict(catalog.restrict(t["customer"], keys), "c_acctbal > 0").select("c_custkey", "c_name")


@query("SELECT DISTINCT c_mktsegment FROM customer WHERE c_nationkey IN (3, 7)")
def fetch_column(spark, sf_dir):
    """F26, J15 with a list of keys."""
    return catalog.fetch(catalog.restrict(table(spark, sf_dir, "customer"), [{"c_nationkey": 3}, {"c_nationkey": 7}]), "c_mktsegment")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE EXISTS (SELECT 1 FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE c_custkey = o_custkey AND r_regionkey = 2)")
def restrict_cascade(spark, sf_dir):
    """J17."""
    return catalog.cascade(tables(spark, sf_dir), LINKS, "region", {"r_regionkey": 2})["orders"].select("o_orderkey", "o_custkey")


@query("""SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F' AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
AND (o_custkey, o_orderdate) NOT IN (SELECT (o_custkey, o_orderdate) FROM orders WHERE o_orderstatus = 'F') QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey) = 1""")
def insert_new_only(spark, sf_dir):
    """J16, SK4: of the open orders those whose customer exists and has no finished order of that day yet, one a day."""
    t = tables(spark, sf_dir)
    parents = t["customer"].filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    there = t["orders"].filter("o_orderstatus = 'F'")
    out = catalog.insertable(t["orders"].filter("o_orderstatus <> 'F'"), there, ["o_custkey", "o_orderdate"], parents, ["o_custkey"], ["o_orderkey"])
    return out.select("o_orderkey")


@query("SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '5-LOW')")
def annotated_events_insert(spark, sf_dir):
    """SK5: sessions that have events and aren't in the table yet."""
    t = tables(spark, sf_dir)
    of = lambda p: t["orders"].filter(F.col("o_orderpriority") == p).select(F.col("o_custkey").alias("c_custkey"))
    return catalog.events_to_insert(of("1-URGENT"), t["customer"], of("5-LOW"), ["c_custkey"]).select("c_custkey")


@query("SELECT o_orderkey, count(l_orderkey) AS n_items FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey = 4) GROUP BY o_orderkey")
def cascade_delete(spark, sf_dir):
    """SK7: orders and items that stay when a nation's customers go."""
    t = tables(spark, sf_dir)
    gone = catalog.cascade(t, LINKS, "nation", {"n_nationkey": 4})["orders"].select("o_orderkey", F.col("o_orderkey").alias("l_orderkey"))
    left = catalog.without_session({"orders": t["orders"]}, gone.select("o_orderkey")) | catalog.without_session({"lineitem": t["lineitem"]}, gone.select("l_orderkey"))
    n = left["lineitem"].groupBy("l_orderkey").agg(F.count("*").alias("n_items"))
    return left["orders"].join(n, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_orderkey", F.coalesce("n_items", F.lit(0)).alias("n_items"))


@query("SELECT s_suppkey, s_name FROM supplier WHERE s_nationkey NOT IN (SELECT c_nationkey FROM customer WHERE c_acctbal > 9900)")
def unused_dimension(spark, sf_dir):
    """SK7: dimension rows that nothing refers to any more."""
    users = table(spark, sf_dir, "customer").filter("c_acctbal > 9900").select(F.col("c_nationkey").alias("s_nationkey"))
    return catalog.unused(table(spark, sf_dir, "supplier"), "s_nationkey", [users]).select("s_suppkey", "s_name")


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation WHERE n_regionkey = 1 ORDER BY n_nationkey LIMIT 12")
def table_report(spark, sf_dir):
    """SK8, O4, O5: the first rows of a restricted table (the limit is the report's)."""
    return catalog.report({"nation": table(spark, sf_dir, "nation")}, {"n_regionkey": 1})["nation"]


#: A graph with a diamond (items by order and by supplier) and a table that refers to itself (who brought a customer).
GRAPH = [
    graph.Link("nation", "region", {"n_regionkey": "r_regionkey"}),
    graph.Link("customer", "nation", {"c_nationkey": "n_nationkey"}),
    graph.Link("customer", "customer", {"brought_by": "c_custkey"}),
    graph.Link("supplier", "nation", {"s_nationkey": "n_nationkey"}),
    graph.Link("orders", "customer", {"o_custkey": "c_custkey"}),
    graph.Link("lineitem", "orders", {"l_orderkey": "o_orderkey"}),
    graph.Link("lineitem", "supplier", {"l_suppkey": "s_suppkey"}),
]
GRAPH_KEYS = {"region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"], "supplier": ["s_suppkey"], "orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_linenumber", "l_suppkey"]}
DESCENDANTS = """WITH RECURSIVE b AS (SELECT c_custkey, c_nationkey, CASE WHEN c_custkey % 7 = 0 THEN c_custkey // 7 END AS brought_by FROM customer), n AS (SELECT n_nationkey FROM nation WHERE n_regionkey = 1 AND n_nationkey % 2 = 0),
c AS (SELECT c_custkey FROM b WHERE c_nationkey IN (SELECT n_nationkey FROM n) UNION SELECT b.c_custkey FROM b JOIN c ON b.brought_by = c.c_custkey),
s AS (SELECT s_suppkey FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM n) OR s_suppkey = 5), o AS (SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM c))"""
GONE = "(l_orderkey IN (SELECT o_orderkey FROM o) OR l_suppkey IN (SELECT s_suppkey FROM s))"


def graph_tables(spark, sf_dir):
    t = {name: table(spark, sf_dir, name) for name in GRAPH_KEYS}
    k = F.col("c_custkey")
    return t | {"customer": t["customer"].withColumn("brought_by", F.when(k % 7 == 0, F.floor(k / 7)))}


def counted(tables):
    one = lambda name, key: tables[name].groupBy(F.col(key).alias("id")).agg(F.count("*").alias("n")).select(F.lit(name).alias("tab"), "id", "n")
    out = one("nation", "n_nationkey")
    for name, key in (("customer", "c_custkey"), ("supplier", "s_suppkey"), ("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
        out = out.unionByName(one(name, key))
    return out


SEEDS = {"nation": "n_regionkey = 1 AND n_nationkey % 2 = 0", "supplier": {"s_suppkey": 5}}


@query(f"""{DESCENDANTS} SELECT 'nation' AS tab, n_nationkey AS id, 1 AS n FROM n UNION ALL SELECT 'customer', c_custkey, 1 FROM c UNION ALL SELECT 'supplier', s_suppkey, 1 FROM s UNION ALL SELECT 'orders', o_orderkey, 1 FROM o
UNION ALL SELECT 'lineitem', l_orderkey, count(*) FROM lineitem WHERE {GONE} GROUP BY l_orderkey""")
def cascade_graph(spark, sf_dir):
    """What descends from some nations and a supplier, by every way through the graph."""
    return counted(graph.restricted(graph_tables(spark, sf_dir), GRAPH_KEYS, GRAPH, SEEDS))


@query(f"""{DESCENDANTS} SELECT 'nation' AS tab, n_nationkey AS id, 1 AS n FROM nation WHERE n_nationkey NOT IN (SELECT n_nationkey FROM n) UNION ALL SELECT 'customer', c_custkey, 1 FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM c)
UNION ALL SELECT 'supplier', s_suppkey, 1 FROM supplier WHERE s_suppkey NOT IN (SELECT s_suppkey FROM s) UNION ALL SELECT 'orders', o_orderkey, 1 FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM o)
UNION ALL SELECT 'lineitem', l_orderkey, count(*) FROM lineitem WHERE NOT {GONE} GROUP BY l_orderkey""")
def cascade_graph_delete(spark, sf_dir):
    """SK7: what stays without them."""
    return counted(graph.remaining(graph_tables(spark, sf_dir), GRAPH_KEYS, GRAPH, SEEDS))


@query("""WITH s AS (SELECT CAST(o_custkey AS VARCHAR) AS subject_id, o_orderpriority AS session_id, o_orderkey, o_orderdate < DATE '1995-01-01' AS early, o_totalprice FROM orders), k AS (SELECT subject_id, session_id, bool_and(early) AS only_early, bool_or(NOT early) AS late FROM s GROUP BY ALL)
SELECT subject_id, session_id, count(*) AS n, sum(o_orderkey) AS orders, count(*) FILTER (o_totalprice > 150000) AS n_parts, CAST(NULL AS VARCHAR) AS reason FROM s JOIN k USING (subject_id, session_id) WHERE (CASE WHEN late THEN NOT early ELSE early END) AND NOT (session_id = '5-LOW' AND CAST(subject_id AS BIGINT) % 3 = 0) GROUP BY ALL
UNION ALL SELECT DISTINCT subject_id, session_id, 0, 0, 0, 'no_video' FROM s WHERE CAST(subject_id AS BIGINT) % 11 = 0""")
def batch_ingest(spark, sf_dir):
    """SK1-SK7: sessions in batches, the later of which replace what comes again and take some back; a batch that stopped
    half-way isn't seen, one that comes twice changes nothing, rejects are there once."""
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("subject_id"), F.col("o_orderpriority").alias("session_id"), "o_orderkey", "o_orderdate", "o_totalprice")
    folder = shared.fresh_path(spark, "catalogue")
    bad = o.filter("CAST(subject_id AS BIGINT) % 11 = 0").select(*writers.KEY, F.lit("no_video").alias("reason"))
    halves = {"early": o.filter("o_orderdate < DATE'1995-01-01'"), "late": o.filter("o_orderdate >= DATE'1995-01-01'")}
    parts = lambda rows: {"event": rows.select(*writers.KEY, "o_orderkey"), "part": rows.filter("o_totalprice > 150000").select(*writers.KEY, "o_totalprice")}
    for name in ("early", "late", "early"):
        batches.ingest(spark, folder, name, halves[name].select(*writers.KEY), parts(halves[name]), bad)
    o.withColumn("o_orderkey", -F.col("o_orderkey")).select(*writers.KEY, "o_orderkey").write.parquet(f"{folder}/event/batch=stopped")
    low = o.filter("session_id = '5-LOW' AND CAST(subject_id AS BIGINT) % 3 = 0")
    batches.ingest(spark, folder, "taken-back", low.select(*writers.KEY).limit(0), {}, removed=low.select(*writers.KEY))
    key = "subject_id string, session_id string"
    e = batches.read(spark, folder, "event", f"{key}, o_orderkey bigint").groupBy(*writers.KEY).agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("orders"))
    p = batches.read(spark, folder, "part", f"{key}, o_totalprice double").groupBy(*writers.KEY).agg(F.count("*").alias("n_parts"))
    whole = e.join(p, writers.KEY, "left").select(*writers.KEY, "n", "orders", F.coalesce("n_parts", F.lit(0)).alias("n_parts"), F.lit(None).cast("string").alias("reason"))
    zero = F.lit(0).cast("long")
    return whole.unionByName(batches.rejects(spark, folder).select(*writers.KEY, zero.alias("n"), zero.alias("orders"), zero.alias("n_parts"), "reason"))

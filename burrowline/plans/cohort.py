"""Queries on registries, file names, matching and metadata."""

from __future__ import annotations

from pyspark.sql import functions as F

from burrowline.functions import merging, scalar
from burrowline.operators import discover, guards, meta, substrings, trials
from burrowline.plans.base import query, r4, table


@query("SELECT p_partkey, list_reduce(list_transform(string_split(p_name || ' ,x ', ' '), lambda s: trim(s)), lambda a, b: a || '|' || b) AS tasks, len(string_split(p_name || ' ,x ', ' ')) AS n_tasks, CAST(p_size AS INT) AS animal_id FROM part")
def subject_registry_clean(spark, sf_dir):
    """SC1, R6, X7, X9: list cell to trimmed names, text to whole numbers."""
    p = table(spark, sf_dir, "part")
    sheet = p.select("p_partkey", F.replace(F.concat("p_name", F.lit(" ,x ")), F.lit(" "), F.lit(" , ")).alias("tasks conducted"), F.concat(F.col("p_size").cast("string"), F.lit(".0")).alias("animal ID"))
    sheet = sheet.withColumn("tasks conducted", F.replace("tasks conducted", F.lit(", ,x"), F.lit(", ~x")))
    out = meta.clean_registry(sheet)
    return out.select("p_partkey", F.array_join(F.transform("tasks", lambda t: F.replace(t, F.lit("~"), F.lit(","))), "|").alias("tasks"), F.size("tasks").cast("long").alias("n_tasks"), "animal_id")


@query("SELECT p_partkey, p_brand FROM part WHERE list_contains(string_split(p_name, ' '), 'blue')")
def task_membership(spark, sf_dir):
    """F1."""
    p = table(spark, sf_dir, "part").withColumn("tasks", F.split("p_name", " "))
    return discover.did_task(p, "blue").select("p_partkey", "p_brand")


@query("""WITH o AS (SELECT o_custkey, c_nationkey AS task, o_orderpriority AS session FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT c_custkey, t.session FROM customer JOIN (SELECT DISTINCT task, session FROM o) t ON task = c_nationkey WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.o_custkey = c_custkey AND o.session = t.session)""")
def session_matrix_missing(spark, sf_dir):
    """Sessions of its task that each subject lacks; a nation's customers share a task."""
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("task"))
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("session"))
    sessions = discover.distinct_sessions(o.join(c, "c_custkey"), "task", "session")
    return discover.missing(discover.session_matrix(c, sessions, ["task"]), o, ["c_custkey", "session"]).select("c_custkey", "session")


#: Web hosts' endings as folders of animals, by the animal's number.
DIRS = ("com", "net", "org")
ANIMALS = "(SELECT c_custkey AS animal, c_custkey % 97 AS cage, ['com', 'net', 'org'][c_custkey % 3 + 1] AS dir FROM customer)"


@query(f"""WITH p AS (SELECT page_id, url, regexp_extract(url, 'example\\.([a-z]+)/', 1) AS dir FROM pages),
m AS (SELECT animal, s.dir, page_id, url, CASE WHEN contains(url, animal || '') THEN 0 WHEN contains(url, 'page=' || cage) THEN 1 END AS prio FROM {ANIMALS} s JOIN p ON s.dir = p.dir)
SELECT animal, dir, page_id, prio FROM m WHERE prio IS NOT NULL QUALIFY row_number() OVER (PARTITION BY animal, dir ORDER BY prio, url, page_id) = 1""")
def file_match_fallback(spark, sf_dir):
    """Files by the animal's id, else by its cage; the first of the better kind."""
    s, p = animals(spark, sf_dir), page_files(spark, sf_dir)
    a = F.col("animal").cast("string")
    cage = F.concat(F.lit("page="), F.col("cage").cast("string"))
    return discover.first_file(s, p, ["dir"], ["animal", "dir"], [a, cage], ["name", "page_id"]).select("animal", "dir", "page_id", "prio")


def animals(spark, sf_dir):
    c = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(c.alias("animal"), (c % 97).alias("cage"), F.get(F.array(*map(F.lit, DIRS)), (c % 3).cast("int")).alias("dir"))


def page_files(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("name"), F.regexp_extract("url", r"example\.([a-z]+)/", 1).alias("dir"))


@query(f"""WITH p AS (SELECT page_id, url AS name, regexp_extract(url, 'example\\.([a-z]+)/', 1) AS dir FROM pages), m AS (SELECT a.animal, a.dir, page_id, name FROM {ANIMALS} a JOIN p ON a.dir = p.dir AND contains(name, a.animal || ''))
SELECT animal, dir, page_id, EXISTS (SELECT 1 FROM {ANIMALS} b WHERE b.dir = m.dir AND b.animal <> m.animal AND contains(m.name, b.animal || '')) AS ambiguous_match FROM m""")
def ambiguous_names(spark, sf_dir):
    """Every file whose name contains an animal's id, and whether it contains another registered one."""
    s, p = animals(spark, sf_dir), page_files(spark, sf_dir)
    hit = discover.match_names(s, p, ["dir"], ["animal", "dir"], [F.col("animal")])
    return discover.ambiguous(hit, s, ["dir"], "animal", "animal").select("animal", "dir", "page_id", "ambiguous_match")


@query("""WITH n AS (SELECT CAST(o_orderkey % 5 AS INT) AS cohort, 'v' || o_orderkey || '_' || o_custkey || '_' || strftime(o_orderdate, '%Y-%m-%d') || '.avi' AS name FROM orders), i AS (SELECT CAST(c_custkey % 5 AS INT) AS cohort, c_custkey || CASE WHEN c_custkey % 3 = 0 THEN '_19' || (92 + c_custkey % 7) ELSE '' END AS id FROM customer)
SELECT cohort, id, count(*) AS n, min(name) AS first_name, max(name) AS last_name FROM i JOIN n USING (cohort) WHERE contains(name, id) GROUP BY cohort, id""")
def names_with_ids(spark, sf_dir):
    """The names of a cohort that contain an id, or an id and the year after it, counted."""
    o = F.col("o_orderkey")
    n = table(spark, sf_dir, "orders").select((o % 5).cast("int").alias("cohort"), F.concat(F.lit("v"), o, F.lit("_"), "o_custkey", F.lit("_"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(".avi")).alias("name"))
    c = F.col("c_custkey")
    i = table(spark, sf_dir, "customer").select((c % 5).cast("int").alias("cohort"), F.concat(c.cast("string"), F.when(c % 3 == 0, F.concat(F.lit("_19"), (92 + c % 7).cast("string"))).otherwise("")).alias("id"))
    out = substrings.containing(n, i, ["cohort"], "name", "id")
    return out.groupBy("cohort", "id").agg(F.count("*").alias("n"), F.min("name").alias("first_name"), F.max("name").alias("last_name"))


@query(r"""SELECT page_id, regexp_extract(url, '://([^/]+)/', 1) AS host, regexp_extract(url, '://[^/]+/([a-z]+)/', 1) AS lang, regexp_extract(url, '[^/]*$') AS file,
CASE WHEN regexp_matches(url, '[^/](\.[^./]+)$') THEN lower(regexp_extract(url, '[^/](\.[^./]+)$', 1)) ELSE '' END AS ext FROM pages""")
def path_template_fields(spark, sf_dir):
    """Name and suffix of a path, and parts of it."""
    p = table(spark, sf_dir, "pages")
    u = F.col("url")
    return p.select("page_id", F.regexp_extract(u, "://([^/]+)/", 1).alias("host"), F.regexp_extract(u, "://[^/]+/([a-z]+)/", 1).alias("lang"), scalar.file_name(u).alias("file"), scalar.suffix(u).alias("ext"))


@query("""WITH n AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate + INTERVAL 37 SECOND, '%Y-%m-%d %H-%M-%S') || '_rat9.ts' WHEN 1 THEN strftime(o_orderdate + INTERVAL 61 MINUTE, '%Y-%m-%d_%H-%M-%S') || '_m12.mp4'
  WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d') || '_m7_small.mp4' ELSE 'trial2.avi' END AS name FROM orders)
SELECT o_orderkey, CAST(epoch(coalesce(try_strptime(nullif(regexp_extract(name, '([0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}-[0-9]{2}-[0-9]{2})[_ ]', 1), ''), '%Y-%m-%d %H-%M-%S'),
  try_strptime(nullif(regexp_extract(name, '([0-9]{4}-[0-9]{2}-[0-9]{2}_[0-9]{2}-[0-9]{2}-[0-9]{2})_', 1), ''), '%Y-%m-%d_%H-%M-%S'),
  try_strptime(nullif(regexp_extract(name, '([0-9]{4}-[0-9]{2}-[0-9]{2})[_ ]', 1), ''), '%Y-%m-%d'))) AS BIGINT) AS t, CASE WHEN name LIKE '%.ts' THEN 'convertible' ELSE 'supported' END AS media FROM n""")
def filename_datetime(spark, sf_dir):
    """X1, F5."""
    d, k = F.col("o_orderdate").cast("timestamp"), F.col("o_orderkey") % 4
    name = F.when(k == 0, F.concat(F.date_format(d + F.expr("INTERVAL 37 SECOND"), "yyyy-MM-dd HH-mm-ss"), F.lit("_rat9.ts"))).when(k == 1, F.concat(F.date_format(d + F.expr("INTERVAL 61 MINUTE"), "yyyy-MM-dd_HH-mm-ss"), F.lit("_m12.mp4"))).when(k == 2, F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit("_m7_small.mp4"))).otherwise("trial2.avi")
    o = table(spark, sf_dir, "orders").select("o_orderkey", name.alias("name"))
    return o.select("o_orderkey", F.unix_seconds(scalar.name_time(F.col("name"))).alias("t"), scalar.media_class(F.col("name")).alias("media"))


@query("""SELECT c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS trial, 'BehavioralVideoTrial' || row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS trial_name FROM customer""")
def natural_sort_rank(spark, sf_dir):
    """Names in natural order are numbered."""
    c = table(spark, sf_dir, "customer").withColumn("name", F.concat(F.lit("trial"), F.col("c_custkey").cast("string"), F.lit(".avi")))
    out = discover.numbered(c, ["c_nationkey"], [scalar.natural_key(F.col("name"))], "trial", "BehavioralVideoTrial")
    return out.select("c_custkey", F.col("trial").cast("long").alias("trial"), "trial_name")


@query("""SELECT n_nationkey, s_suppkey, CASE WHEN count(s_suppkey) OVER (PARTITION BY n_nationkey) = 0 THEN 'none' WHEN count(s_suppkey) OVER (PARTITION BY n_nationkey) > 1 THEN 'multiple' END AS reason FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey""")
def cardinality_guard(spark, sf_dir):
    """C1."""
    j = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "supplier"), F.col("s_nationkey") == F.col("n_nationkey"), "left")
    return guards.exactly_one(j, ["n_nationkey"], F.col("s_suppkey").isNotNull()).select("n_nationkey", "s_suppkey", "reason")


@query("""WITH c AS (SELECT o_custkey, o_orderstatus, count(*) AS n_found, max(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 4 END) AS n_expected FROM orders GROUP BY ALL),
r AS (SELECT o_orderstatus AS task, CASE WHEN n_found < n_expected THEN 'too few' WHEN n_found > n_expected THEN 'too many' END AS reason FROM c)
SELECT task, reason, count(*) AS n FROM r WHERE reason IS NOT NULL GROUP BY ALL""")
def discovery_log(spark, sf_dir):
    """C2, SK2, SK3, A14: rejects by reason."""
    s = F.col("o_orderstatus")
    counted = guards.expected_count(table(spark, sf_dir, "orders"), ["o_custkey", "o_orderstatus"], F.when(s == "F", 1).when(s == "O", 2).otherwise(4))
    _, rejects = guards.split_rejects(counted.withColumnRenamed("o_orderstatus", "task"))
    return guards.discovery_log(rejects)


@query("SELECT o_custkey, o_orderkey, round(o_totalprice, 2) AS o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def keep_last_per_key(spark, sf_dir):
    """W8."""
    return discover.keep_last(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", F.round("o_totalprice", 2).alias("o_totalprice"))


@query("""WITH c AS (SELECT l_orderkey, max_by(l_partkey, (l_linenumber, l_shipdate, l_partkey, l_suppkey)) AS cage FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus = 'P' THEN o_custkey END, cage) AS cage_id FROM orders LEFT JOIN c ON l_orderkey = o_orderkey""")
def cage_lookup_left(spark, sf_dir):
    """The registry's cage, else the pooled one."""
    pooled = discover.keep_last(table(spark, sf_dir, "lineitem"), ["l_orderkey"], ["l_linenumber", "l_shipdate", "l_partkey", "l_suppkey"]).select(F.col("l_orderkey").cast("string").alias("o_orderkey"), F.col("l_partkey").alias("cage_id"))
    subjects = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "P", F.col("o_custkey")).alias("cage_id"))
    return meta.with_cage(subjects, pooled, ["o_orderkey"]).select("o_orderkey", "cage_id")


@query("""SELECT c_custkey, coalesce(CASE WHEN c_acctbal < 0 THEN c_mktsegment END, n_name, 'default') AS institution, CASE c_mktsegment WHEN 'MALE' THEN 'M' WHEN 'FEMALE' THEN 'F' ELSE 'U' END AS sex,
CAST(c_nationkey AS VARCHAR) || '-' || CAST(c_custkey AS VARCHAR) AS subject_id, CASE WHEN n_name IS NULL THEN 'unknown session type' END AS reason FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 3) ON n_nationkey = c_nationkey""")
def metadata_layers(spark, sf_dir):
    """Layers by precedence, a lookup with default, a composed id."""
    c = table(spark, sf_dir, "customer").withColumn("session_key", F.col("c_nationkey"))
    n = table(spark, sf_dir, "nation").filter("n_regionkey < 3").select(F.col("n_nationkey").alias("session_key"), "n_name")
    typed = meta.with_session_type(c, n).withColumn("institution", meta.layered(F.when(F.col("c_acctbal") < 0, F.col("c_mktsegment")), F.col("n_name")))
    filled = meta.with_defaults(typed, spark.createDataFrame([("default",)], "institution string"), ["institution"])
    return filled.select("c_custkey", "institution", scalar.sex_code(F.col("c_mktsegment")).alias("sex"), scalar.subject_name(F.col("c_custkey"), F.col("c_nationkey")).alias("subject_id"), "reason")


@query("""SELECT c_custkey, c_nationkey || '-' || c_custkey AS subject_id, CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' ELSE 'U' END AS sex, upper(n_name) AS genotype, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE 'Housing: ' || c_mktsegment || '. ' END || 'Cage ID: ' || c_custkey % 97 AS description
FROM customer JOIN nation ON n_nationkey = c_nationkey""")
def subject_descriptions(spark, sf_dir):
    """composed ids, sex codes, genotypes and housing texts of subjects."""
    k = F.col("c_custkey")
    j = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    sex = F.when(k % 3 == 0, "male").when(k % 3 == 1, "female").otherwise("not known")
    s = j.select("c_custkey", k.alias("animal_id"), F.col("c_nationkey").alias("cohort_id"), sex.alias("sex"), F.lower("n_name").alias("genotype"), F.when(k % 5 != 0, F.col("c_mktsegment")).alias("housing"), (k % 97).alias("cage_id"))
    return meta.described_subjects(s).select("c_custkey", "subject_id", "sex", "genotype", "description")


@query("""SELECT c_custkey, coalesce(CASE WHEN c_acctbal > 0 THEN n_name END, 'default') AS institution, 'lab' AS lab, c_mktsegment AS session, 'rat' AS species, CASE WHEN c_custkey % 2 = 0 THEN c_name END AS subject_id,
'a,b' || CASE WHEN c_custkey % 3 = 0 THEN ',' || c_mktsegment ELSE '' END AS keywords, 'arena=' || CASE WHEN c_custkey % 5 = 0 THEN 'path' ELSE n_name END || '/1,box=file/2' || CASE WHEN c_custkey % 5 = 1 THEN ',new=path/' ELSE '' END AS devices,
CASE WHEN c_custkey % 2 = 1 THEN 'a:low,b:' || c_nationkey ELSE 'a:' || c_custkey || ',b:' || c_nationkey || ',c:path' END AS tags FROM customer JOIN nation ON n_nationkey = c_nationkey""")
def deep_metadata(spark, sf_dir):
    """Default, file and path layers of nested metadata, merged to their leaves."""
    j = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    k, s, lit = F.col("c_custkey"), F.struct, lambda x, name: F.lit(x).alias(name)
    device = lambda name, note, order: s(F.lit(name).alias("name"), note.alias("note"), F.lit(order).alias("order"))
    base = s(s(lit("default", "institution"), lit("lab", "lab"), F.array(F.lit("a"), F.lit("b")).alias("keywords")).alias("file"), s(lit("rat", "species")).alias("subject"), F.array(device("arena", F.lit("base"), 1)).alias("devices"), F.create_map(F.lit("a"), F.lit("low")).alias("tags"))
    file = s(s(F.when(F.col("c_acctbal") > 0, F.col("n_name")).alias("institution"), F.col("c_mktsegment").alias("session")).alias("file"), F.array(s(F.lit("arena").alias("name"), F.col("n_name").alias("note")), s(F.lit("box").alias("name"), F.lit("file").alias("note"))).alias("devices"), F.create_map(F.lit("b"), F.col("c_nationkey").cast("string")).alias("tags"))
    path = s(
        s(F.when(k % 3 == 0, F.array(F.col("c_mktsegment"), F.lit("a"))).alias("keywords")).alias("file"), F.when(k % 2 == 0, s(F.col("c_name").alias("subject_id"))).alias("subject"),
        F.when(k % 5 == 0, F.array(s(F.lit("arena").alias("name"), F.lit("path").alias("note"), F.lit(None).cast("int").alias("order")), s(F.lit("box").alias("name"), F.lit(None).cast("string").alias("note"), F.lit(2).alias("order")))).when(k % 5 == 1, F.array(s(F.lit("box").alias("name"), F.lit(None).cast("string").alias("note"), F.lit(2).alias("order")), s(F.lit("new").alias("name"), F.lit("path").alias("note"), F.lit(None).cast("int").alias("order")))).otherwise(F.array(s(F.lit("box").alias("name"), F.lit(None).cast("string").alias("note"), F.lit(2).alias("order")))).alias("devices"),
        F.when(k % 2 == 0, F.create_map(F.lit("a"), k.cast("string"), F.lit("c"), F.lit("path"))).alias("tags"),
    )
    m = merging.deep_merge(j.select("c_custkey", base.alias("base"), file.alias("of_file"), path.alias("of_path")), ["base", "of_file", "of_path"], "m")
    shown = F.transform("m.devices", lambda d: F.concat(d["name"], F.lit("="), d["note"], F.lit("/"), F.coalesce(d["order"].cast("string"), F.lit(""))))
    tags = F.transform(F.array_sort(F.map_entries("m.tags")), lambda e: F.concat(e["key"], F.lit(":"), e["value"]))
    return m.select("c_custkey", "m.file.institution", "m.file.lab", "m.file.session", "m.subject.species", "m.subject.subject_id", F.array_join("m.file.keywords", ",").alias("keywords"), F.array_join(shown, ",").alias("devices"), F.array_join(tags, ",").alias("tags"))


@query("""SELECT c_custkey, task, CASE WHEN s IS NULL THEN e WHEN e = s THEN e ELSE e || ';' || s END AS people FROM (
SELECT c_custkey, 'OLM' AS task, c_mktsegment AS e, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment WHEN c_custkey % 3 = 1 THEN n_name END AS s FROM customer JOIN nation ON c_nationkey = n_nationkey
UNION ALL SELECT c_custkey, 'WM', n_name, NULL FROM customer JOIN nation ON c_nationkey = n_nationkey)""")
def experimenter_list(spark, sf_dir):
    """F12."""
    j = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    k = F.col("c_custkey") % 3
    wide = j.select("c_custkey", F.col("c_mktsegment").alias("OLM exp"), F.when(k == 0, F.col("c_mktsegment")).when(k == 1, F.col("n_name")).alias("OLM sco"), F.col("n_name").alias("WM exp"))
    return meta.task_people(wide, ["OLM", "WM"], ["c_custkey"]).select("c_custkey", "task", F.array_join("experimenters", ";").alias("people"))


@query("""SELECT l_orderkey, metric, count(*) AS n, round(sum(value), 2) AS total FROM (SELECT l_orderkey, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem) UNPIVOT (value FOR metric IN (l_quantity, l_extendedprice, l_discount, l_tax)) GROUP BY ALL""")
def unpivot_quadrants(spark, sf_dir):
    """Metrics as rows."""
    m = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    out = trials.metrics_long(table(spark, sf_dir, "lineitem").select("l_orderkey", *m), ["l_orderkey"], m)
    return out.groupBy("l_orderkey", "metric").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("""WITH a AS (SELECT l_orderkey, sum(l_quantity) AS b0, sum(l_discount) AS b1, sum(l_tax) AS b2 FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey AS animal, bin, round(CASE bin WHEN 0 THEN b0 WHEN 1 THEN b1 ELSE b2 END, 4) AS freezing, CAST(bin * 60 AS DOUBLE) AS start_s, CAST(bin * 60 + 30 AS DOUBLE) AS stop_s, CAST(2.5 AS DOUBLE) AS bout_duration, 'p1' AS protocol
FROM a, (SELECT CAST(unnest([0, 1, 2]) AS INT) AS bin)""")
def freeze_transpose(spark, sf_dir):
    """A wide freeze-score sheet, made of the line items, back to one row per animal and bin."""
    li = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(*[F.sum(c).cast("string").alias(n) for c, n in (("l_quantity", "b0"), ("l_discount", "b1"), ("l_tax", "b2"))])
    animals = li.select((F.col("l_orderkey") + 3).alias("row_no"), F.col("l_orderkey").cast("string").alias("% freeze"), "b0", "b1", "b2", F.lit("1.5").alias("t"), F.lit(None).cast("string").alias("d"), F.lit("p1").alias("p"))
    head = spark.createDataFrame([(0, "Onset", "0", "60", "120", "Threshold", "Bout", "Protocol"), (1, "Duration", "30", "30", "30", None, None, None), (2, None, None, None, None, None, "2.5", None)], "row_no bigint, `% freeze` string, b0 string, b1 string, b2 string, t string, d string, p string")
    out = trials.freeze_trials(head.unionByName(animals)).filter("animal IS NOT NULL")
    return out.select(scalar.whole(F.col("animal"), "bigint").alias("animal"), "bin", r4(F.col("freezing")).alias("freezing"), "start_s", "stop_s", "bout_duration", "protocol")

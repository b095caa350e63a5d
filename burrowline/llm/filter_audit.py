"""Filter interaction audit: what each of five filters removes, in every order that they can be applied in.

Which filters a document fails is found once. The documents of each part are counted by their five results, which makes a
tensor of 2x2x2x2x2 counts beside those of good and toxic documents; a step of an order is a contraction of the tensor that
selects, along the axis of each filter, pass (applied before), fail (applied now) or all (applied later). All orders and
steps are one einsum per part, so no document is looked at twice.

Filters A to D judge a text by itself. E fails where a document with a smaller id has an identical text anywhere in the
table. Copies pass or fail A to D together, so E needs no join of documents with their first copy: the documents of a part
that fail it are all its documents less the texts' first ones, which a grouped minimum by the text's SHA-256 yields. Hot
texts are summed up before they are shuffled.

Defined results: null or empty text: no words, fails A only (B: 0 < 0 is false) and E from its second document on; doc_id
null: never fails E and has no labels; repeated rows of the smallest id all pass E; a doc_id with several labels counts as
good or toxic if one of them says so; part null: the empty text; no rows give none; other columns are left out.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burrowline.llm.common import discard, ready, staged, text_of

FILTERS = "ABCDE"
MEASURES = ("n", "n_good", "n_toxic")
SHAPE = (len(MEASURES), *[2] * len(FILTERS))
OUT = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def failures(text: Column) -> list[Column]:
    """Whether a text fails A, B, C, D."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n = F.size(words)
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return [n < 200, 100 * F.size(F.array_distinct(words)) < 50 * n, 100 * capitals > 3 * F.length(text), text.rlike("[#$%&*|]")]


def judged(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """doc_id, part, digest, mask (bits of A to D), good, toxic of every document, staged; no texts."""
    bits = sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(failures(F.col("_t")))), F.lit(0))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), text_of().alias("_t"))
    rows = texts.select("doc_id", "part", F.unhex(F.sha2(F.col("_t").cast("binary"), 256)).alias("digest"), bits.cast("int").alias("mask"))
    known = staged(labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")), "audit-labels")
    no = F.lit(False)
    out = staged(rows.join(known.hint("merge"), "doc_id", "left").select("doc_id", "part", "digest", "mask", F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic")), "audit")
    discard(known)
    return out


def cells(rows: DataFrame) -> DataFrame:
    """part, cell (bits of A to E), n, n_good, n_toxic. The documents that fail E are those with an id, less the first of
    each text."""
    group = ["part", "mask", "good", "toxic"]
    counted = rows.groupBy(*group).agg(F.count("*").alias("all"), F.count("doc_id").alias("with_id")).withColumn("first", F.lit(0).cast("long"))
    # first rows: equal ones are summed up, then all parts of the smallest id of each text are kept together
    each = rows.filter("doc_id IS NOT NULL").groupBy("digest", "doc_id", *group).agg(F.count("*").alias("k"))
    by_id = each.groupBy("digest", "doc_id").agg(F.sort_array(F.collect_list(F.struct(*group, "k"))).alias("e"))  # as many as parts
    first = by_id.groupBy("digest").agg(F.min(F.struct("doc_id", "e")).alias("f")).select(F.inline("f.e"))
    firsts = first.groupBy(*group).agg(F.sum("k").alias("first")).select(*group, F.lit(0).cast("long").alias("all"), F.lit(0).cast("long").alias("with_id"), "first")
    both = counted.unionByName(firsts).groupBy(*group).agg(*[F.sum(c).alias(c) for c in ("all", "with_id", "first")])
    repeats = F.col("with_id") - F.col("first")
    split = both.select(*group, F.inline(F.array(F.struct(F.lit(0).alias("e"), (F.col("all") - repeats).alias("k")), F.struct(F.lit(1).alias("e"), repeats.alias("k")))))
    one = lambda c: F.sum(F.when(c, F.col("k")).otherwise(0))
    return split.groupBy("part", (F.col("mask") + F.col("e") * 16).alias("cell")).agg(F.sum("k").alias("n"), one(F.col("good")).alias("n_good"), one(F.col("toxic")).alias("n_toxic"))


def selections() -> tuple[list[tuple[str, int]], dict[str, np.ndarray]]:
    """The steps (order, number from 1) and, for removed, kept and unique failures, which results each step takes along each
    filter's axis: [step, axis, (pass, fail)]."""
    steps = [("".join(p), k) for p in permutations(FILTERS) for k in range(1, len(FILTERS) + 1)]
    passes, fails, either = (1, 0), (0, 1), (1, 1)
    kinds = {"removed": (passes, fails, either), "kept": (passes, passes, either), "failing": (either, fails, either), "unique_fails": (passes, fails, passes)}
    pick = lambda before, now, later: np.array([[before if o.index(f) < k - 1 else now if o.index(f) == k - 1 else later for f in FILTERS] for o, k in steps], np.int64)
    return steps, {name: pick(*of) for name, of in kinds.items()}


def contracted(counts: pd.DataFrame) -> pd.DataFrame:
    """All orders and steps of one part, of its 32 cells at most."""
    flat = np.zeros((len(MEASURES), 1 << len(FILTERS)), np.int64)
    for i, m in enumerate(MEASURES):
        np.add.at(flat[i], counts["cell"].to_numpy(), counts[m].to_numpy())
    tensor = flat.reshape(SHAPE)  # the highest bit, E, is the first axis of the five
    steps, take = selections()
    select = lambda name: np.einsum("medcba,sa,sb,sc,sd,se->ms", tensor, *(take[name][:, i] for i in range(len(FILTERS))), optimize=True)
    removed, kept, failing, alone = (select(x) for x in ("removed", "kept", "failing", "unique_fails"))
    out = pd.DataFrame({"part": counts["part"].iloc[0], "filter_order": [o for o, _ in steps], "step": np.array([k for _, k in steps], np.int32), "kept": kept[0], "removed": removed[0], "redundant": failing[0] - removed[0], "unique_fails": alone[0], "good_lost": removed[1], "toxic_lost": removed[2]})
    own = pd.Series([o[k - 1] for o, k in steps])
    return out.assign(shapley=out["removed"].groupby(own).transform("sum"))


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """A row per part, order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    ready(docs.sparkSession)
    return cells(judged(docs, labels, part)).groupBy("part").applyInPandas(contracted, OUT)


SQL = r"""WITH l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
w AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
d AS (SELECT doc_id, part, [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w), 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t), regexp_matches(t, '[#$%&*|]'), coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)] AS f FROM w),
j AS (SELECT part, f, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (toxic) AS x FROM d LEFT JOIN l USING (doc_id) GROUP BY ALL),
i AS (SELECT unnest([1, 2, 3, 4, 5]) AS v),
o AS (SELECT [a.v, b.v, c.v, d.v, e.v] AS o FROM i a, i b, i c, i d, i e WHERE len(list_distinct([a.v, b.v, c.v, d.v, e.v])) = 5),
s AS (SELECT part, array_to_string([substr('ABCDE', k, 1) for k in o], '') AS filter_order, i.v AS step, o[i.v] AS own, n, g, x, f[o[i.v]] AS fails, len([k for k in o[1:i.v - 1] if f[k]]) = 0 AS reached, len([k for k in f if k]) AS n_fails FROM j, o, i),
r AS (SELECT part, filter_order, CAST(step AS INT) AS step, own, coalesce(sum(n) FILTER (reached AND NOT fails), 0) AS kept, coalesce(sum(n) FILTER (reached AND fails), 0) AS removed, coalesce(sum(n) FILTER (fails AND NOT reached), 0) AS redundant,
coalesce(sum(n) FILTER (fails AND n_fails = 1), 0) AS unique_fails, coalesce(sum(g) FILTER (reached AND fails), 0) AS good_lost, coalesce(sum(x) FILTER (reached AND fails), 0) AS toxic_lost FROM s GROUP BY ALL)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM r"""

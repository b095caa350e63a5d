"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are grouped by length: sorted by norm over the whole table and cut into buckets of at most BUCKET. The bucket with
the greatest norms is scored in full first, which gives each query a lower bound for its k-th best product. With it every
later bucket has a local cosine threshold per query, bound / (query's norm x bucket's greatest norm):
  over 1            the query skips the bucket (whole pairs of query block and bucket are skipped before any data moves);
  COORDINATE to 1   coordinate pruning: at the query's strongest coordinate a vector must lie within the interval that a
                    cosine this large allows;
  below             length pruning: only the bucket's vectors of at least bound / query's norm are looked at.
Products are then verified in exact integer arithmetic. Queries and buckets meet block by block; a query's best k of each
bucket are merged by a window whose partial limit runs before the shuffle.

Queries are cut into blocks by the norm that a bucket must reach to matter to them, so that a weak query keeps only others like
it from skipping buckets.

Components are quantised by floor(scale * x), as longs. Products that doubles hold exactly are taken in doubles, others in
longs, and where longs could overflow in Python's integers; a score beyond a long's range becomes that range's end, and so
does a quantised component. Defined results: vectors that are null or hold null or non-finite components,
and rows without vec_id, take no part; shorter vectors are filled up with zeros; empty vectors score 0; rows that share a
vec_id count as one candidate, with its best product, and as one query; ties go to the smaller vec_id; other columns are
left out.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from burrowline.llm.common import ready, staged

BUCKET, QUERIES, COORDINATE, COMPONENTS = 4096, 1024, 0.7, 1 << 22
BLOCK = "block long, n int, dim int, greatest double, needs double, ids binary, vectors binary, bounds binary"
LONG = (-(1 << 63), (1 << 63) - 1)


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id, v (array of long), norm; only vectors that take part."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    fine = F.coalesce(F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))), F.lit(False))
    kept = vectors.filter(F.col("vec_id").isNotNull() & fine).select(F.col("vec_id").cast("long"), F.transform(x, lambda c: F.floor(c * scale)).alias("v"))
    return kept.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))))


def matrix(ids: bytes, vectors: bytes, dim: int) -> tuple[np.ndarray, np.ndarray]:
    i = np.frombuffer(ids, np.int64)
    return i, np.frombuffer(vectors, np.int64).reshape(len(i), dim)


def filled(vectors: list[np.ndarray]) -> np.ndarray:
    """Vectors as rows, shorter ones filled up with zeros."""
    m = np.zeros((len(vectors), max(map(len, vectors), default=0)), np.int64)
    for r, v in zip(m, vectors, strict=True):
        r[: len(v)] = v
    return m


def blocks(rows: DataFrame, size: int, by: str) -> DataFrame:
    """rows (vec_id, v, norm, bound, need) sorted by a falling column and cut into blocks of at most size vectors and some
    COMPONENTS components; block numbers are unique but not consecutive."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, components = TaskContext.get().partitionId(), 0, 0
        held: list[tuple[int, np.ndarray, float, float, float]] = []
        types = (pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.binary(), pa.binary(), pa.binary())
        names = [x.split()[0] for x in BLOCK.split(", ")]

        def flush() -> pa.RecordBatch:
            nonlocal number, components
            ids, vectors, norms, bounds, needs = zip(*held, strict=True)
            m = filled(list(vectors))
            packed = [np.array(x, t).tobytes() for x, t in ((ids, np.int64), (m, np.int64), (bounds, np.float64))]
            row = [(part << 32) + number, len(held), m.shape[1], max(norms), min(needs), *packed]
            number, components = number + 1, 0
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], names=names)

        for b in batches:
            others = [b.column(c).to_pylist() for c in ("norm", "bound", "need")]
            for i, v, *rest in zip(b.column("vec_id").to_pylist(), b.column("v"), *others, strict=True):
                held.append((i, v.values.to_numpy(), *rest))
                components += len(held[-1][1])
                if len(held) == size or components >= COMPONENTS:
                    yield flush()
        if held:
            yield flush()

    ready(rows.sparkSession)
    order = [F.desc(by), F.col("vec_id")]  # vec_id parts the vectors of one length
    sorted_ = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return staged(sorted_.select("vec_id", "v", "norm", "bound", "need").mapInArrow(run, BLOCK), "blocks")


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer products; in doubles where these hold them exactly, beyond longs in Python's integers."""
    dim = min(q.shape[1], c.shape[1])
    q, c = q[:, :dim], c[:, :dim]
    most = dim * float(np.abs(q.astype(np.float64)).max(initial=0)) * float(np.abs(c.astype(np.float64)).max(initial=0))
    if most < 2**53:
        return (q.astype(np.float64) @ c.T.astype(np.float64)).astype(np.int64)
    if most < 2**62:
        return q @ c.T
    exact = q.astype(object) @ c.T.astype(object) if dim else np.zeros((len(q), len(c)), object)
    return np.clip(exact, *LONG).astype(np.int64)


def least_needed(bound: np.ndarray, divisor: np.ndarray | float) -> np.ndarray:
    """What a norm (or a cosine times a norm) must reach for a product of at least bound, a little less for rounding; 0 for
    bounds that anything reaches."""
    low = bound - 0.5 - np.abs(bound) * 1e-12
    return np.where(bound > 0, low / np.maximum(divisor, 1e-300), 0.0)


def best(ids: np.ndarray, scores: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best other ids of one query: by score, then id; an id counts once."""
    ok = ids != own
    ids, scores = ids[ok], scores[ok]
    if len(ids) > 64 * k:
        cut = np.partition(scores, len(scores) - 8 * k)[len(scores) - 8 * k]
        near = scores >= cut
        if len(np.unique(ids[near])) >= k:
            ids, scores = ids[near], scores[near]
    order = np.lexsort((ids, -scores))
    ids, scores = ids[order], scores[order]
    _, first = np.unique(ids, return_index=True)
    first = np.sort(first)[:k]
    return ids[first], scores[first]


def searched(q_ids: np.ndarray, q: np.ndarray, bound: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per query of a block: its best k of one bucket that can reach its bound."""
    norm_q = np.sqrt((q.astype(np.float64) ** 2).sum(1))
    norm_c = np.sqrt((c.astype(np.float64) ** 2).sum(1))
    greatest = norm_c.max(initial=0.0)
    with np.errstate(divide="ignore", invalid="ignore"):
        local = np.where(bound > 0, least_needed(bound, norm_q * greatest), -np.inf)
        least = least_needed(bound, norm_q)
        unit = np.where(norm_c[:, None] > 0, c / norm_c[:, None], 0.0)
    by_coordinate = (local >= COORDINATE) & (local <= 1)
    by_length = local < COORDINATE
    for r in np.flatnonzero(by_coordinate):
        direction = q[r] / norm_q[r]
        f = int(np.abs(direction[: c.shape[1]]).argmax())
        slack = np.sqrt(max(0.0, 1 - local[r] ** 2) * max(0.0, 1 - direction[f] ** 2)) + 1e-9
        near = np.flatnonzero((np.abs(unit[:, f] - direction[f] * local[r]) <= slack + abs(direction[f]) * (1 - local[r])) & (norm_c >= least[r]))
        if len(near):
            s = products(q[r : r + 1], c[near])[0]
            reach = s >= bound[r]
            if reach.any():
                yield r, *best(c_ids[near][reach], s[reach], q_ids[r], k)
    rows = np.flatnonzero(by_length)
    for at in range(0, len(rows), 256):
        part = rows[at : at + 256]
        long_enough = np.flatnonzero(norm_c >= least[part].min())
        if not len(long_enough):
            continue
        s = products(q[part], c[long_enough])
        for r, mine in zip(part, s, strict=True):
            reach = mine >= bound[r]
            if reach.any():
                yield r, *best(c_ids[long_enough][reach], mine[reach], q_ids[r], k)


def bounded(asked: DataFrame, seeds: list[tuple[bytes, bytes, int]], k: int) -> DataFrame:
    """asked (vec_id, v, norm) with bound, the k-th best product with the seeds, and need, the norm that others must reach."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [matrix(*s) for s in seeds]
        for b in batches:
            for at in range(0, b.num_rows, QUERIES):
                part = b.slice(at, QUERIES)
                ids, q = part.column("vec_id").to_numpy(), filled([v.values.to_numpy() for v in part.column("v")])
                bound = np.full(len(ids), -np.inf)
                for c_ids, c in known:
                    for row, _, found in searched(ids, q, bound.copy(), c_ids, c, k):
                        if len(found) == k:
                            bound[row] = found[-1]
                need = least_needed(bound, part.column("norm").to_numpy())
                cols = [*part.select(["vec_id", "v", "norm"]).columns, pa.array(bound), pa.array(need)]
                yield pa.RecordBatch.from_arrays(cols, names=["vec_id", "v", "norm", "bound", "need"])

    return asked.select("vec_id", "v", "norm").mapInArrow(run, "vec_id long, v array<long>, norm double, bound double, need double")


def top_k(vectors: DataFrame, query_step: int = 50, k: int = 5, scale: int = 256, bucket: int = BUCKET) -> DataFrame:
    """query_id, rank, vec_id, score for every query (vec_id divisible by query_step)."""
    rows = staged(quantised(vectors, scale), "quantised")
    free = rows.withColumns({"bound": F.lit(float("-inf")), "need": F.lit(0.0)})
    buckets = blocks(free, bucket, "norm")
    seed = buckets.orderBy(F.desc("greatest"), "block").limit(1).collect()  # one bucket: BUCKET vectors, COMPONENTS components
    seeds = [(r["ids"], r["vectors"], r["dim"]) for r in seed]
    queries = staged(bounded(rows.filter(F.col("vec_id") % query_step == 0), seeds, k), "bounded")
    asked = blocks(queries, QUERIES, "need")
    asked = asked.select(F.col("block").alias("q_block"), F.col("dim").alias("q_dim"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"), "bounds", "needs")
    buckets = buckets.select("block", "dim", "greatest", "ids", "vectors")
    # which blocks meet: block numbers only, then each side's data by an equal key
    part = F.shiftright("block", 32).cast("int")
    last = buckets.agg(F.max(part)).first()[0]
    wanted = asked.select("q_block", "needs", F.explode(F.sequence(F.lit(0), F.lit(last or 0))).alias("part"))
    met = buckets.select("block", "greatest", part.alias("part")).join(wanted, "part").filter("greatest >= needs").select("block", "q_block")
    pairs = met.join(buckets, "block").join(asked, "q_block")

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                row = {c: b.column(c)[r].as_py() for c in ("ids", "vectors", "dim", "q_ids", "q_vectors", "q_dim", "bounds")}
                q_ids, q = matrix(row["q_ids"], row["q_vectors"], row["q_dim"])
                c_ids, c = matrix(row["ids"], row["vectors"], row["dim"])
                out: tuple[list, ...] = ([], [], [])
                for at, ids, scores in searched(q_ids, q, np.frombuffer(row["bounds"]), c_ids, c, k):
                    out[0].append(np.full(len(ids), q_ids[at]))
                    out[1].append(ids)
                    out[2].append(scores)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(o) if o else np.zeros(0, np.int64), pa.int64()) for o in out], names=["query_id", "vec_id", "score"])

    found = pairs.select("ids", "vectors", "dim", "q_ids", "q_vectors", "q_dim", "bounds").mapInArrow(search, "query_id long, vec_id long, score long")
    found = staged(found, "found").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
e AS (SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM v),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, sum(q.x * c.x) AS score FROM e q JOIN e c ON q.i = c.i AND q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0 GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, CAST(score AS BIGINT) AS score FROM r WHERE rank <= 5
"""

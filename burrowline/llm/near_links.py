"""Links between documents whose shingle sets have a Jaccard similarity of a given bound or more, each one verified.

A document's set of shingles is its node; equal sets are one node. Which nodes are compared comes from two sides:
  SimHash   the BK-trees of ``simhash`` over 64-bit fingerprints, for sets so close that their fingerprints link;
  bands     BANDS keys of ROWS of the set's MINIMA least hashes each. Two sets at 0.8 miss all of them with (1 - 0.8^3)^16,
            about one pair in 100,000; only pairs that share a key and agree in NEAR of their least hashes are taken up (at 0.8 a
            pair agrees in 154 of them, give or take 5.5), which about 2.5 pairs in 10,000 at 0.8 don't.
Under a key not all pairs are formed. Small groups propose theirs, of larger ones a row leads and is held against all others:
three or four pairs for each row at most. Of these each class's most promising one comes first, then the best of 64, 4096, ...
shares of its pairs, and those whose ends have come together meanwhile are dropped: classes grow as in a spanning forest, so
that about as many pairs are compared as there are nodes, and those that fail. The best of a share is a grouped maximum: no
class meets in one task.

Whatever is proposed, a pair links only if the shingles of its two texts say so. Pairs are dealt into blocks by their end of
fewer pairs, and a block gets each text that it needs once, compressed: a hub's text goes to many blocks, the texts around it
to one each, and none goes along with every pair.
Groups that aren't one class then get the texts of their rows, and a task compares all rows of a group that aren't yet of one
class, exactly: no pair leaves it, only links, fewer than the group has rows. The least hashes don't decide anything there.
A key of more than CROWD nodes or FILL shingles is dealt out in parts, and COMMON of its nodes stand in every part, so that
classes grow. Of the keys that aren't one class then, every two parts meet, DIAGONALS of distances at a time: no two nodes of
a key stay apart without having met.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burrowline.llm.common import discard, staged
from burrowline.llm.components import components

MINIMA, BANDS, ROWS, NEAR, SURE = 192, 16, 3, 134, 165
#: Pairs of a node in one block; pairs and rows handled together; groups done at once; groups dealt out, and what they share.
HUB, PAIRS, CHUNK, SMALL, CROWD, COMMON = 4096, 1 << 14, 1 << 14, 8, 1 << 15, 16
#: Shingles of a key, and bytes of texts, that are together in a task.
FILL, HELD = 1 << 21, 1 << 24
#: Growth of the number of rows that lead in a round: a group is read about log(size) / log(WIDER) times.
WIDER = 64
#: Distances of parts of crowded keys that are dealt at once; shingles counted together.
DIAGONALS, COUNTED, BUCKETS = 16, 1 << 20, 256
#: What a block of pairs to compare holds, about: pairs, and compressed bytes of their texts. Bytes of shingle sets kept.
BLOCK_PAIRS, BLOCK_BYTES, SETS_BYTES = 2048, 1 << 24, 1 << 23

_rng = np.random.default_rng(20240607)
FACTORS = _rng.integers(0, 1 << 63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
MIX = _rng.integers(0, 1 << 63, ROWS + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: bytes, size: int) -> np.ndarray:
    """The set of a text's shingles as sorted XXH64; a text of fewer words is one shingle."""
    parts = text.lower().split()  # bytes: A-Z only, and white space of ASCII only
    hash64 = xxhash.xxh64_intdigest
    lines = [b" ".join(parts[i : i + size]) for i in range(max(1, len(parts) - size + 1))]
    return np.unique(np.array([hash64(x, 42) for x in lines], np.uint64))


def similarity_of(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def least_hashes(found: np.ndarray) -> np.ndarray:
    """The set's least hash under each of MINIMA orders."""
    out = np.full(MINIMA, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 1 << 9):
        out = np.minimum(out, (found[at : at + (1 << 9), None] * FACTORS).min(axis=0))
    return out


def band_keys(least: np.ndarray) -> np.ndarray:
    rows = least[: BANDS * ROWS].reshape(BANDS, ROWS)
    x = (rows * MIX[:ROWS]).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64) * MIX[ROWS]
    return (x ^ (x >> np.uint64(31))).view(np.int64)


def changes(*cols: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before it."""
    new = np.ones(len(cols[0]), bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in cols], axis=0)
    return new


def by_group(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches sorted by key and part, put together so that groups are never parted."""
    held: list[pa.RecordBatch] = []
    count = size = 0
    for b in batches:
        held.append(b)
        count, size = count + b.num_rows, size + b.nbytes
        if count >= CHUNK or size >= HELD:
            t = pa.Table.from_batches(held)
            cut = int(np.flatnonzero(changes(t.column("key").to_numpy(), t.column("part").to_numpy()))[-1])
            if cut:
                yield t.slice(0, cut)
            held, count = t.slice(cut).combine_chunks().to_batches(), t.num_rows - cut
            size = sum(x.nbytes for x in held)
    if count:
        yield pa.Table.from_batches(held)


GROUP = "key long, part int, node long, n long, sketch binary"


def crowded_keys(keyed: DataFrame) -> DataFrame:
    """key and parts of the keys of more than CROWD nodes or FILL shingles."""
    counts = keyed.groupBy("key").agg(F.count("*").alias("rows"), F.greatest(F.count("*") / CROWD, F.sum("n") / FILL).alias("fills"))
    parts = F.least(F.col("rows"), F.ceil("fills")).cast("int")
    return staged(counts.filter("rows > 1 AND fills > 1").select("key", parts.alias("parts")), "crowded")


def keyed_rows(nodes: DataFrame) -> DataFrame:
    """key, node, n, sketch of the keys that more than one row has; sketches move for those alone."""
    keys = nodes.select(F.explode("keys").alias("key"), "node")
    shared = staged(keys.groupBy("key").agg(F.count("*").alias("rows")).filter("rows > 1").select("key"), "shared")
    sketches = staged(nodes.select("node", "n", "sketch").dropDuplicates(["node"]), "sketches")
    found = staged(keys.join(shared, "key", "left_semi").distinct().join(sketches, "node").select("key", "node", "n", "sketch"), "keyed")
    discard(shared, sketches)
    return found


def parted(keyed: DataFrame, crowded: DataFrame) -> DataFrame:
    """keyed with the part of its key that a node is in, and parts, their number."""
    parts = F.coalesce("parts", F.lit(1))
    return keyed.join(crowded, "key", "left").select("key", F.pmod(F.xxhash64("node"), parts).cast("int").alias("part"), "node", "n", "sketch", parts.alias("parts"))


def dealt(keyed: DataFrame, crowded: DataFrame) -> DataFrame:
    """keyed (key, node, n, sketch) -> GROUP: the groups of several nodes, crowded keys in parts."""
    every = parted(keyed, crowded).select("key", "part", "node", "n", "sketch")
    if not crowded.isEmpty():
        lead = [F.min(F.struct(F.xxhash64("node", F.lit(i)), "node", "n", "sketch")) for i in range(COMMON)]
        shared = keyed.join(crowded, "key").groupBy("key", "parts").agg(F.array(*lead).alias("lead"))
        shared = shared.select("key", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.explode("lead").alias("l"))
        every = every.unionByName(shared.select("key", "part", "l.node", "l.n", "l.sketch"))
    return every


def opposite(keyed: DataFrame, crowded: DataFrame, roots: DataFrame, low: int) -> DataFrame:
    """GROUP of every two parts of a crowded key at a distance of low to low + DIAGONALS - 1, of the keys that aren't one class."""
    rooted = keyed.join(crowded, "key", "left_semi").select("key", "node").join(roots, "node", "left")
    root = F.coalesce("root", "node")
    mixed = staged(rooted.groupBy("key").agg(F.min(root).alias("a"), F.max(root).alias("z")).filter("a <> z").select("key").join(crowded, "key"), "mixed")
    of = parted(keyed.join(mixed, "key", "left_semi"), mixed)
    step = F.explode(F.sequence(F.lit(low), F.lit(low + DIAGONALS - 1)))
    each = of.select("*", step.alias("step"))
    first = F.array_compact(F.array(F.when(F.col("part") + F.col("step") < F.col("parts"), F.col("part")), F.when(F.col("part") >= F.col("step"), F.col("part") - F.col("step"))))
    met = each.select("key", F.explode(first).alias("first"), "step", "parts", "node", "n", "sketch")
    return met.select(F.xxhash64("key", "step").alias("key"), F.col("first").cast("int").alias("part"), "node", "n", "sketch")


def profiles(nodes: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """node, profile: a byte for each of BUCKETS, how many of the node's shingles in it another one of the nodes has too. Sets
    with more in a bucket than a byte holds get none. texts as in linked()."""
    of = lambda packed, length: shingles(pa.decompress(packed, length, "zstd", asbytes=True), size)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, np.ndarray]] = []
        many = 0

        def solve() -> pa.RecordBatch:
            found, first, rows = np.unique(np.concatenate([x for _, x in held]), return_index=True, return_counts=True)
            owner = np.repeat(np.array([k for k, _ in held], np.int64), [len(x) for _, x in held])[first]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(owner), pa.array(rows)], names=["shingle", "node", "rows"])

        for b in batches:
            for node, length, packed in zip(*(b.column(c).to_pylist() for c in ("node", "size", "packed")), strict=True):
                held.append((node, of(packed, length)))
                many += len(held[-1][1])
                if many >= COUNTED:
                    yield solve()
                    many = 0
        if held:
            yield solve()

    def fill(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r in range(b.num_rows):
                found, lone = of(b.column("packed")[r].as_py(), b.column("size")[r].as_py()), b.column("lone")[r]
                if lone.is_valid:
                    found = np.setdiff1d(found, lone.values.to_numpy().view(np.uint64), assume_unique=True)
                held = np.bincount((found >> np.uint64(56)).astype(np.int64), minlength=BUCKETS)
                out.append(held.astype(np.uint8).tobytes() if held.max() < 256 else None)
            yield pa.RecordBatch.from_arrays([b.column("node"), pa.array(out, pa.binary())], names=["node", "profile"])

    open_ = staged(texts.join(nodes, "node", "left_semi").select("node", "size", "packed"), "open")
    counts = open_.mapInArrow(count, "shingle long, node long, rows long")
    own = counts.groupBy("shingle").agg(F.sum("rows").alias("rows"), F.min("node").alias("node")).filter("rows = 1")
    lone = own.groupBy("node").agg(F.collect_list("shingle").alias("lone"))  # a part of one text's shingles
    found = staged(open_.join(lone, "node", "left").mapInArrow(fill, "node long, profile binary"), "profiles")
    discard(open_)
    return found


ROUND = "kind int, key long, part int, node long, n long, sketch binary, u long, v long, alike int"


def proposed(open_: DataFrame, similarity: float, turn: int) -> DataFrame:
    """GROUP with root and profile -> ROUND: pairs of different classes that some rows of each group lead (kind 1), and the rows
    that haven't led of groups where these aren't one class (kind 0): what has led has met its whole group."""
    wide = WIDER**turn

    def solve(t: pa.Table) -> Iterator[pa.RecordBatch]:
        key, part, node, n, root = (t.column(c).to_numpy() for c in ("key", "part", "node", "n", "root"))
        once = np.flatnonzero(changes(key, part, node))
        key, part, node, n, root = (x[once] for x in (key, part, node, n, root))
        group = np.cumsum(changes(key, part)) - 1
        size = np.bincount(group)
        # the class that most of a group's rows are in
        by = np.lexsort((root, group))
        first = np.flatnonzero(changes(group[by], root[by]))
        count = np.diff(np.append(first, len(by)))
        top = np.lexsort((root[by][first], -count, group[by][first]))
        main = root[by][first][top][changes(group[by][first][top])] if len(by) else root
        mixed = np.bincount(group[by][first], minlength=len(size)) > 1
        minor = root != main[group]
        # leaders: rows of lesser classes first
        by = np.lexsort((node * 0x9E3779B9 ^ turn, ~minor, group))
        rank = np.empty(len(by), np.int64)
        rank[by] = np.arange(len(by)) - (np.cumsum(size) - size)[group[by]]
        leads = mixed[group] & (rank < np.where(size <= SMALL, size, wide)[group])
        sketch = np.frombuffer(b"".join(t.column("sketch").to_pylist()), np.uint8).reshape(-1, MINIMA)[once]
        held = t.column("profile").take(pa.array(once))
        known = held.is_valid().to_numpy()
        profile = np.frombuffer(b"".join(x or bytes(BUCKETS) for x in held.to_pylist()), np.uint8).reshape(-1, BUCKETS)
        room = np.where(known, profile.sum(axis=1, dtype=np.int64), n)  # shingles that another set can have
        reach = lambda a, b, both: both >= similarity * (n[a] + n[b] - both) - 1e-9
        start, left, out = np.cumsum(size) - size, np.flatnonzero(leads), []
        while len(left):
            pairs = np.cumsum(size[group[left]])
            take = max(1, int(np.searchsorted(pairs, PAIRS, side="right")))
            some, left = left[:take], left[take:]
            many = size[group[some]]
            a = np.repeat(some, many)
            b = np.repeat(start[group[some]] - (np.cumsum(many) - many), many) + np.arange(many.sum())
            can = (root[a] != root[b]) & reach(a, b, np.minimum(room[a], room[b]))
            a, b = a[can], b[can]
            alike = (sketch[a] == sketch[b]).sum(axis=1)
            near = alike >= NEAR
            a, b, alike = a[near], b[near], alike[near]
            can = ~(known[a] & known[b]) | reach(a, b, np.minimum(profile[a], profile[b]).sum(axis=1, dtype=np.int64))
            a, b, alike = a[can], b[can], alike[can]
            out.append(np.stack([np.minimum(node[a], node[b]), np.maximum(node[a], node[b]), alike]))
        pairs = np.concatenate(out, axis=1) if out else np.zeros((3, 0), np.int64)
        by = np.lexsort((pairs[1], pairs[0]))
        pairs = pairs[:, by[changes(pairs[0][by], pairs[1][by])]]
        later = np.flatnonzero(mixed[group] & ~leads)
        by = later[np.lexsort((root[later], group[later]))]
        stays = np.bincount(group[by][changes(group[by], root[by])], minlength=len(size)) > 1
        rows = later[stays[group[later]]]
        none = lambda k, kind: pa.nulls(k, kind)
        k, m = len(rows), pairs.shape[1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat([0, 1], [k, m]).astype(np.int32))]
            + [pa.concat_arrays([pa.array(x), none(m, y)]) for x, y in ((key[rows], pa.int64()), (part[rows].astype(np.int32), pa.int32()), (node[rows], pa.int64()), (n[rows], pa.int64()))]
            + [pa.concat_arrays([pa.array([x.tobytes() for x in sketch[rows]], pa.binary()), none(m, pa.binary())])]
            + [pa.concat_arrays([none(k, y), pa.array(x.astype(z))]) for x, y, z in zip(pairs, (pa.int64(), pa.int64(), pa.int32()), (np.int64, np.int64, np.int32), strict=True)],
            names=[x.split()[0] for x in ROUND.split(", ")],
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in by_group(batches):
            yield from solve(t)

    order = ("key", "part", "node")
    chosen = open_.select(*order, "n", "sketch", "root", "profile").repartition("key", "part").sortWithinPartitions(*order)
    return staged(chosen.mapInArrow(run, ROUND), "round", partition_by="kind")


def squeezed(texts: DataFrame) -> DataFrame:
    """texts (node, text) with the text compressed: node, size, packed."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = [t.as_buffer() for t in b.column("text")]
            packed = pa.array([pa.compress(x, "zstd", asbytes=True) for x in raw], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("node"), pa.array([x.size for x in raw], pa.int64()), packed], names=["node", "size", "packed"])

    return texts.select("node", "text").mapInArrow(run, "node long, size long, packed binary")


def in_blocks(pairs: DataFrame, texts: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """block, node, size, packed (the texts of a block, once each) and block, u, v (its pairs) as rows of one table; and the
    written tables that it is read from.

    A pair goes by its end of fewer pairs; one that stands in more than HUB even so is parted by the other end."""
    tried = staged(pairs.select("u", "v"), "tried")
    ends = staged(tried.select(F.explode(F.array("u", "v")).alias("node")).groupBy("node").agg(F.count("*").alias("degree")), "ends")
    rows = staged(texts.join(ends, "node").withColumn("bytes", F.octet_length("packed")), "sides")
    weight = rows.agg(F.sum("degree"), F.sum(F.col("degree") * F.col("bytes"))).first()
    blocks = 1 + (weight[0] or 0) // 2 // BLOCK_PAIRS + (weight[1] or 0) // BLOCK_BYTES
    both = tried
    for side in "uv":
        both = both.join(ends.select(F.col("node").alias(side), F.col("degree").alias(f"{side}_degree")), side)
    lesser = F.col("v_degree") <= F.col("u_degree")
    home, other = F.when(lesser, F.col("v")).otherwise(F.col("u")), F.when(lesser, F.col("u")).otherwise(F.col("v"))
    part = F.pmod(F.xxhash64(other), F.ceil(F.least("u_degree", "v_degree") / HUB))
    placed = staged(both.select(F.pmod(F.xxhash64(home, part), F.lit(blocks)).alias("block"), "u", "v"), "placed")
    wanted = placed.select("block", F.explode(F.array("u", "v")).alias("node")).distinct()
    sent = wanted.join(rows.select("node", "size", "packed"), "node").select("block", "node", "size", "packed")
    return sent.unionByName(placed, allowMissingColumns=True), [tried, ends, rows, placed]


def linked(pairs: DataFrame, texts: DataFrame, size: int, similarity: float) -> DataFrame:
    """The pairs (u, v) whose shingle sets have at least this similarity. texts: node, size, packed, one row of each node."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, sets, kept = None, {}, {}, 0

        def of(node: int) -> np.ndarray:
            nonlocal kept
            if node not in sets:
                packed, length = held[node]
                found = shingles(pa.decompress(packed, length, "zstd", asbytes=True), size)
                if kept + found.nbytes > SETS_BYTES:
                    sets.clear()
                    kept = 0
                sets[node] = found
                kept += found.nbytes
            return sets[node]

        for b in (x.slice(i, 1024) for x in batches for i in range(0, x.num_rows, 1024)):
            out: tuple[list[int], list[int]] = ([], [])
            for at, node, length, packed, u, v in zip(*(b.column(c).to_pylist() for c in ("block", "node", "size", "packed", "u", "v")), strict=True):
                if at != block:
                    block, held, sets, kept = at, {}, {}, 0
                if node is not None:
                    held[node] = packed, length
                elif similarity_of(of(u), of(v)) >= similarity:
                    out[0].append(u)
                    out[1].append(v)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["u", "v"])

    every, read = in_blocks(pairs, texts)
    order = ("block", F.col("node").asc_nulls_last(), "u", "v")
    placed = every.select("block", "node", "size", "packed", "u", "v").repartition("block").sortWithinPartitions(*order)
    found = staged(placed.mapInArrow(run, "u long, v long"), "links")
    discard(*read)
    return found


def apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs (u, v, ...) whose ends are of different classes, with u_root and v_root."""
    r = roots.select(F.col("node").alias("_n"), F.col("root").alias("_r"))
    out = pairs.drop("u_root", "v_root")
    for side in "uv":
        out = out.join(r, F.col(side) == F.col("_n"), "left").withColumn(f"{side}_root", F.coalesce("_r", side)).drop("_n", "_r")
    return staged(out.filter("u_root <> v_root"), "apart")


def promising(pairs: DataFrame, shares: int) -> DataFrame:
    """Of pairs as apart() has them: the best (u, v) of each share of a class's pairs. A class would rather be tied to a node
    that many pairs share, among those that are surely alike, so that classes grow around hubs and few pairs are compared."""
    sure, share = F.col("alike") >= SURE, F.pmod(F.xxhash64("u", "v"), F.lit(shares))
    side = lambda a, b: F.struct(F.col(f"{a}_root").alias("root"), share.alias("share"), F.struct(sure.alias("sure"), F.col(f"{b}_degree").alias("degree"), "alike", (-F.col(a)).alias("first"), "u", "v").alias("rank"))
    ends = pairs.select(F.inline(F.array(side("u", "v"), side("v", "u"))))
    best = ends.groupBy("root", "share").agg(F.max("rank").alias("rank"))
    return staged(best.select("rank.u", "rank.v").distinct(), "chosen")


def merged_roots(roots: DataFrame, more: DataFrame) -> DataFrame:
    """roots after new links (u, v): their classes, not their nodes, are connected, and no link of before is looked at again."""
    own, ends = roots.select(F.col("node").alias("_n"), F.col("root").alias("_r")), more
    for side in "uv":
        ends = ends.join(own, F.col(side) == F.col("_n"), "left").withColumn(f"{side}_root", F.coalesce("_r", side)).drop("_n", "_r")
    new = components(ends.select(F.col("u_root").alias("u"), F.col("v_root").alias("v")))  # a root is its class's smallest node
    moved = roots.join(new.select(F.col("node").alias("root"), F.col("root").alias("to")), "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    out = staged(moved.unionByName(new.select("node", "root")), "roots")
    discard(new)
    return out


def with_degrees(pairs: DataFrame) -> DataFrame:
    """pairs with the number of pairs that each node is in."""
    ends = staged(pairs.select(F.explode(F.array("u", "v")).alias("node")).groupBy("node").agg(F.count("*").alias("degree")), "degrees")
    out = pairs
    for side in "uv":
        out = out.join(ends.select(F.col("node").alias(side), F.col("degree").alias(f"{side}_degree")), side)
    return out


def similar_classes(nodes: DataFrame, close: DataFrame, size: int, similarity: float) -> DataFrame:
    """node, root for every node that isn't its class's smallest. nodes: node, n, keys, sketch, text; close: pairs (u, v)
    that fingerprints propose."""
    texts = staged(squeezed(nodes).dropDuplicates(["node"]), "texts")
    links = linked(close.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), texts, size, similarity)
    roots = components(links)
    discard(links)
    keyed = keyed_rows(nodes)
    crowded = crowded_keys(keyed)
    found = proposed(rooted(dealt(keyed, crowded), roots).withColumn("profile", F.lit(None).cast("binary")), similarity, 0)
    roots = grown(found.filter("kind = 1"), roots, texts, size, similarity)
    roots = met(found.filter("kind = 0"), roots, texts, size, similarity)
    discard(found)
    most = crowded.agg(F.max("parts")).first()[0] or 0
    for low in range(1, most, DIAGONALS):
        roots = met(opposite(keyed, crowded, roots, low), roots, texts, size, similarity)
    discard(keyed, crowded, texts)
    return roots


def rooted(rows: DataFrame, roots: DataFrame) -> DataFrame:
    return rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def with_links(roots: DataFrame, more: DataFrame) -> DataFrame:
    """roots after new links, which are removed, as are the roots of before."""
    out = roots
    if not more.isEmpty():
        out = merged_roots(roots, more)
        discard(roots)
    discard(more)
    return out


def grown(pairs: DataFrame, roots: DataFrame, texts: DataFrame, size: int, similarity: float) -> DataFrame:
    """roots after the links among proposed pairs (u, v, alike)."""
    each = staged(pairs.groupBy("u", "v").agg(F.max("alike").alias("alike")), "pairs")
    left, shares = apart(with_degrees(each), roots), 1
    discard(each)
    while not left.isEmpty():
        chosen = promising(left, shares)
        roots = with_links(roots, linked(chosen, texts, size, similarity))
        last, left = left, apart(left.join(chosen, ["u", "v"], "left_anti"), roots)
        discard(last, chosen)
        shares *= 64  # what is left after the first pairs lies mostly below the bound
    discard(left)
    return roots


def links_within(sets: list[np.ndarray], root: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """Links between sets (sorted, none empty) that connect all those of at least this similarity, besides what has one root
    already: fewer than there are sets. Each set outside of the main class is held against all sets of like size at once."""
    n = np.array([len(x) for x in sets])
    by = np.argsort(n, kind="stable")
    n, label = n[by], np.unique(root[by], return_inverse=True)[1]
    main = np.bincount(label).argmax()
    _, shingle, rows = np.unique(np.concatenate([sets[i] for i in by]), return_inverse=True, return_counts=True)
    several = rows[shingle] > 1  # what only one set has is in no intersection
    at = np.concatenate([[0], np.cumsum(several)])[np.concatenate([[0], np.cumsum(n)])]
    shingle = shingle[several].astype(np.int32)
    low, high = np.searchsorted(n, n * similarity - 1e-6), np.searchsorted(n, n / similarity + 1e-6, side="right")
    marked, out = np.zeros(len(rows), bool), []
    for a in range(len(by)):
        if label[a] == main:
            continue
        some = slice(low[a], high[a])
        other = label[some] != label[a]
        if not other.any():
            continue
        own = shingle[at[a] : at[a + 1]]
        marked[own] = True
        held = np.concatenate([[0], np.cumsum(marked[shingle[at[some.start] : at[some.stop]]])])
        marked[own] = False
        from_ = at[some.start : some.stop + 1] - at[some.start]
        both = np.diff(held[from_])
        alike = np.flatnonzero(other & (both / (n[a] + n[some] - both) >= similarity)) + some.start
        joined, first = np.unique(label[alike], return_index=True)
        if len(joined):
            out += [(int(by[a]), int(by[b])) for b in alike[first]]
            label[np.isin(label, np.append(joined, label[a]))] = main if main in joined else label[a]
    return out


def met(open_: DataFrame, roots: DataFrame, texts: DataFrame, size: int, similarity: float) -> DataFrame:
    """roots after all links within the groups of open_ (key, part, node), each row compared with its group's in one task."""

    def solve(t: pa.Table) -> pa.RecordBatch:
        key, part, node, root = (t.column(c).to_numpy() for c in ("key", "part", "node", "root"))
        once = np.flatnonzero(changes(key, part, node))
        cuts = np.append(np.flatnonzero(changes(key[once], part[once])), len(once))
        length, packed = t.column("size"), t.column("packed")
        out: list[tuple[int, int]] = []
        for rows in (once[a:z] for a, z in itertools.pairwise(cuts)):
            sets = [shingles(pa.decompress(packed[i].as_py(), length[i].as_py(), "zstd", asbytes=True), size) for i in rows.tolist()]
            out += [(node[rows[a]], node[rows[b]]) for a, b in links_within(sets, root[rows], similarity)]
        pairs = np.array(out, np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(pairs.min(axis=1)), pa.array(pairs.max(axis=1))], names=["u", "v"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from map(solve, by_group(batches))

    order = ("key", "part", "node")
    rows = staged(rooted(open_.select(*order), roots), "open")
    mixed = staged(rows.groupBy("key", "part").agg(F.min("root").alias("a"), F.max("root").alias("z")).filter("a <> z").select("key", "part"), "mixed")
    sent = rows.join(mixed, ["key", "part"], "left_semi").join(texts, "node").select(*order, "root", "size", "packed")
    links = staged(sent.repartition("key", "part").sortWithinPartitions(*order).mapInArrow(run, "u long, v long"), "links")
    discard(rows, mixed)
    return with_links(roots, links)

"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked within a Hamming radius through BK-trees.

A BK-tree keys a node's children by their integer distance to it; a search follows only edges within the radius of the
query's own distance. One tree over all documents would have to sit in one place, so the fingerprints are sharded first:
of five bit blocks, two that link within 3 bits share at least two, so each of the ten pairs of blocks is a key, and one
tree is built for each key's value. All trees of a task are built and searched level by level in numpy.

Documents with one fingerprint count as one from the start (grouped before any comparison), so copies cost nothing. A key
that more than SHARD distinct fingerprints share is refined: its free bits are cut into four blocks, of which two linked
fingerprints share one, and each block's value makes a finer key - again and again, until no key is crowded. So no tree
and no set of searches is larger than SHARD, and no link is lost. A task doesn't return pairs: what it finds connected
becomes a star of links, at most one per fingerprint, and components() joins the stars. The trees move by shuffle and not
by broadcast, since their size has no bound that the data can't break.

Which of two texts are similar by a given Jaccard similarity no radius decides: sets at one similarity differ in a number of
bits that varies by chance. ``keep_one`` therefore takes fingerprint links as proposals, which ``near_links`` verifies by
the shingles and completes by what fingerprints can't reach.

Defined results: null text counts as empty; texts without words have
fingerprint zero and link like any other; repeated rows share a fingerprint and each keep their row; an empty table gives
no rows; a null doc_id is never a component's smallest id unless all its documents have none.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import accumulate, combinations, pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burrowline.llm.common import forgotten, ready, staged, text_of
from burrowline.llm.components import components
from burrowline.llm.near_links import band_keys, least_hashes, shingles, similar_classes

RADIUS, WIDTHS, SHARD, FRONTIER, CHUNK, SEEN = 3, (13, 13, 13, 13, 12), 4096, 1 << 18, 1 << 16, 1 << 20


def fingerprint(text: bytes, size: int = 3, seed: int = 42) -> np.ndarray:
    """Majority of the bits of the shingles' XXH64, unsigned."""
    parts = text.lower().split()  # bytes: A-Z only, and white space of ASCII only
    if not parts:
        return np.zeros(1, "<u8")
    line, hash64 = b" ".join(parts), xxhash.xxh64_intdigest
    starts = list(accumulate((len(w) + 1 for w in parts), initial=0))
    spans = zip(starts, starts[size:], strict=False) if len(parts) > size else [(0, len(line) + 1)]
    hashes = np.array([hash64(line[a : b - 1], seed) for a, b in spans], "<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        some = hashes[at : at + (1 << 14), None]
        ones += np.unpackbits(np.ascontiguousarray(some).view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """doc_id, fp0: the fingerprint's bits as a signed long."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_buffer().to_pybytes(), size) for t in b.column(1)], np.uint64).reshape(-1)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp0"])

    ready(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).mapInArrow(run, "doc_id long, fp0 long")


def block_keys(fp: Column) -> Column:
    """The keys under which a fingerprint meets all others within the radius."""
    blocks, at = [], 0
    for w in WIDTHS:
        blocks.append(F.shiftrightunsigned(fp, at).bitwiseAND(F.lit((1 << w) - 1)))
        at += w
    return F.array(*[F.shiftleft(F.lit(k).cast("long"), 32).bitwiseOR(F.shiftleft(a, 13)).bitwiseOR(b) for k, (a, b) in enumerate(combinations(blocks, 2))])


class Forest:
    """BK-trees of several groups at once: rows are nodes, a child is the first row of those at one distance from its parent."""

    def __init__(self, fps: np.ndarray, group: np.ndarray, in_tree: np.ndarray):
        """fps: a row of 64-bit words for each fingerprint."""
        self.fps, self.bits = fps, 64 * fps.shape[1]
        rows = np.flatnonzero(in_tree)
        rows = rows[np.argsort(group[rows], kind="stable")]
        label = group[rows]
        first = np.concatenate([[True], label[1:] != label[:-1]]) if len(rows) else np.zeros(0, bool)
        self.root = np.full(int(group.max(initial=-1)) + 1, -1, np.int64)
        self.root[label[first]] = rows[first]
        keys, kids = [], []
        while len(rows):
            head = rows[first][np.cumsum(first) - 1]
            rest = ~first
            rows, head = rows[rest], head[rest]
            key = head * (self.bits + 1) + self.distance(rows, head)
            order = np.argsort(key, kind="stable")
            rows, key = rows[order], key[order]
            first = np.concatenate([[True], key[1:] != key[:-1]]) if len(rows) else np.zeros(0, bool)
            keys.append(key[first])
            kids.append(rows[first])
        self.keys = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        self.kids = np.concatenate(kids) if kids else np.zeros(0, np.int64)
        order = np.argsort(self.keys)
        self.keys, self.kids = self.keys[order], self.kids[order]

    def distance(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.bitwise_count(self.fps[a] ^ self.fps[b]).sum(axis=1, dtype=np.int64)

    def links(self, queries: np.ndarray, group: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query row, tree row) within the radius, slice by slice."""
        root = self.root[group[queries]]
        stack = [(queries[root >= 0], root[root >= 0])]
        while stack:
            q, node = stack.pop()
            if len(q) > FRONTIER:
                stack += [(q[FRONTIER:], node[FRONTIER:])]
                q, node = q[:FRONTIER], node[:FRONTIER]
            d = self.distance(q, node)
            near = (d <= radius) & (q != node)
            if near.any():
                yield q[near], node[near]
            low = np.searchsorted(self.keys, node * (self.bits + 1) + np.maximum(d - radius, 0))
            n = np.searchsorted(self.keys, node * (self.bits + 1) + np.minimum(d + radius, self.bits), side="right") - low
            if n.any():
                at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
                stack.append((np.repeat(q, n), self.kids[at]))


def joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """label with the classes of a and b put together; every row points at its class's smallest row."""
    while True:
        x, y = label[a], label[b]
        differ = x != y
        if not differ.any():
            return label
        np.minimum.at(label, np.maximum(x, y)[differ], np.minimum(x, y)[differ])
        while (label[label] != label).any():
            label = label[label]


def stars(keyed: DataFrame, radius: int) -> DataFrame:
    """keyed (key, node, fp0) -> links (u, v) of nodes that connect what is linked under a key."""

    def solve(cols: tuple[np.ndarray, ...]) -> pa.RecordBatch:
        key, node, fp = cols
        group = np.cumsum(np.concatenate([[True], key[1:] != key[:-1]])) - 1
        several = np.bincount(group)[group] > 1
        group, node, fp = group[several], node[several], fp[several].view(np.uint64)[:, None]
        label = np.arange(len(node))
        if len(node):
            for a, b in Forest(fp, group, np.ones(len(node), bool)).links(label.copy(), group, radius):
                label = joined(label, a, b)
        moved = np.flatnonzero(label != np.arange(len(label)))
        return pa.RecordBatch.from_arrays([pa.array(node[moved]), pa.array(node[label[moved]])], names=["u", "v"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        count = 0
        for b in batches:
            held.append(tuple(c.to_numpy(zero_copy_only=False) for c in b.columns))
            count += b.num_rows
            if count >= CHUNK:
                cols = tuple(np.concatenate(x) for x in zip(*held, strict=True))
                other = np.flatnonzero(cols[0] != cols[0][-1])
                cut = int(other[-1]) + 1 if len(other) else 0
                if cut:
                    yield solve(tuple(c[:cut] for c in cols))
                held, count = [tuple(c[cut:] for c in cols)], len(cols[0]) - cut
        if count:
            yield solve(tuple(np.concatenate(x) for x in zip(*held, strict=True)))

    chosen = keyed.select("key", "node", "fp0").repartition("key").sortWithinPartitions("key", "node")
    return chosen.mapInArrow(run, "u long, v long")


def cut_bits(free: int, parts: int = RADIUS + 1) -> list[int]:
    """Masks that cut the free bits into blocks."""
    bits = [b for b in range(64) if free >> b & 1]
    at = [len(bits) * k // parts for k in range(parts + 1)]
    return [sum(1 << b for b in bits[a:z]) for a, z in pairwise(at)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def refined(distinct: DataFrame) -> DataFrame:
    """distinct (node, fp0) -> (key, node, fp0): each fingerprint under its keys, none of them with more than SHARD."""
    every, blocks, at = (1 << 64) - 1, [], 0
    for w in WIDTHS:
        blocks.append(((1 << w) - 1) << at)
        at += w
    frees = [every & ~(a | b) for a, b in combinations(blocks, 2)]
    keyed = distinct.select("node", "fp0", F.posexplode(block_keys(F.col("fp0"))).alias("path", "key"))
    done = None
    while True:
        counts = keyed.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > SHARD).select("key")
        crowded = staged(counts, "crowded")
        if not max(map(int.bit_count, frees)) or crowded.isEmpty():
            fine = keyed.select("key", "node", "fp0")
            return fine if done is None else done.unionByName(fine)
        fine = keyed.join(crowded, "key", "left_anti").select("key", "node", "fp0")
        done = fine if done is None else done.unionByName(fine)
        finer = [cut_bits(f) for f in frees]
        masks = F.array(*[F.array(*[F.lit(signed(m)).cast("long") for m in ms]) for ms in finer])
        again = keyed.join(crowded, "key", "left_semi").select("node", "fp0", "path", "key", F.posexplode(F.get(masks, F.col("path"))).alias("k", "mask"))
        value = F.xxhash64("key", "k", F.col("fp0").bitwiseAND(F.col("mask")))
        keyed = staged(again.select("node", "fp0", (F.col("path") * (RADIUS + 1) + F.col("k")).alias("path"), value.alias("key")), "finer")
        frees = [f & ~m for f, ms in zip(frees, finer, strict=True) for m in ms]


def classes(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """prints (doc_id, fp0) -> fp0, component_id: the smallest doc_id of all that links reach."""
    if not 0 <= radius <= RADIUS:
        raise ValueError("the block keys hold for radii up to 3")
    distinct = staged(prints.groupBy("fp0").agg(F.min("doc_id").alias("least")).withColumn("node", F.col("fp0")), "fingerprints")
    roots = components(stars(refined(distinct), radius))
    rooted = distinct.join(roots.withColumnRenamed("node", "_n"), F.col("node") == F.col("_n"), "left").select("fp0", "least", F.coalesce("root", "node").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(least, "root").select("fp0", "component_id")


def near_duplicates(docs: DataFrame, size: int = 3, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id, by 64 bits and a radius of at most 3."""
    prints = staged(fingerprints(docs, size), "prints")
    named = staged(classes(prints, radius), "classes")
    return prints.join(named, "fp0").select("doc_id", F.lower(F.lpad(F.hex("fp0"), 16, "0")).alias("fingerprint"), "component_id")


def prepared(docs: DataFrame, size: int) -> DataFrame:
    """docs' columns as c0, c1, ... with rid (a row's own number), text, node (digest of its shingle set; null: no words), n
    (the set's size) and, for the task's first row of a node, its fingerprint, least hashes and band keys."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forgotten()
        rid, seen = TaskContext.get().partitionId() << 40, set()
        for b in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            for t in b.column("text"):
                raw = t.as_buffer().to_pybytes()
                found = shingles(raw, size) if raw.split(None, 1) else None
                node = None if found is None else xxhash.xxh3_64_intdigest(found.tobytes(), len(found)) - (1 << 63)
                row: tuple = (node, None if found is None else len(found), None, None, None)
                if node is not None and node not in seen:
                    seen.add(node)
                    least = least_hashes(found)
                    row = (node, len(found), int(fingerprint(raw, size).view(np.int64)[0]), (least >> np.uint64(32)).astype(np.uint8).tobytes(), band_keys(least))
                for o, v in zip(out, row, strict=True):
                    o.append(v)
            if len(seen) > SEEN:
                seen.clear()
            types = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()))
            rids = pa.array(range(rid, rid + b.num_rows), pa.int64())
            rid += b.num_rows
            yield pa.RecordBatch.from_arrays([*b.columns, rids, *(pa.array(o, t) for o, t in zip(out, types, strict=True))], names=[*b.schema.names, "rid", "node", "n", "fp0", "sketch", "keys"])

    ready(docs.sparkSession)
    named = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)], text_of("`text`").alias("text"))
    own = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema))
    return staged(named.mapInArrow(run, f"{own}, text string, rid long, node long, n long, fp0 long, sketch binary, keys array<long>"), "prepared")


def fingerprint_links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """nodes (node, fp0) -> pairs (u, v) that the BK-trees connect, each node with the first one of its class."""
    distinct = staged(nodes.groupBy("fp0").agg(F.min("node").alias("node")), "fingerprints")
    equal = nodes.select("node", "fp0").join(distinct.withColumnRenamed("node", "u"), "fp0").filter("u <> node").select("u", F.col("node").alias("v"))
    return equal.unionByName(staged(stars(refined(distinct), radius), "stars"))


def keep_one(docs: DataFrame, size: int = 5, similarity: float = 0.8) -> DataFrame:
    """docs with one row of each class of rows that links of this similarity or more connect: the one with the smallest
    doc_id (null last), then the longest text, then the smallest digest of it, then the first read. Rows without words all
    stay. Rows go by what they hold, not by their id: rows that share a doc_id stay unless their texts link."""
    rows = prepared(docs, size)
    nodes = rows.filter("keys IS NOT NULL")
    roots = similar_classes(nodes, fingerprint_links(nodes), size, similarity)
    at = f"c{docs.columns.index('doc_id')}"
    rank = F.struct(F.col(at).isNull(), F.col(at), -F.length("text"), F.xxhash64("text"), "rid")
    named = rows.filter("node IS NOT NULL").select("node", "rid", rank.alias("rank")).join(roots, "node", "left").select(F.coalesce("root", "node").alias("root"), "rid", "rank")
    named = staged(named, "named")
    first = staged(named.groupBy("root").agg(F.min("rank").alias("first")).select("root", F.col("first.rid").alias("first")), "first")
    gone = named.join(first, "root").filter("rid <> first").select("rid")
    return rows.join(gone, "rid", "left_anti").select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])

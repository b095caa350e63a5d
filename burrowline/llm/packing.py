"""Best-fit-decreasing packing of documents into sequences of a fixed number of tokens.

Best fit looks at lengths only, and there are no more different lengths than a sequence has places. So the lengths of all
pieces are counted in Spark, the packing itself is done once over the counts, and its outcome - runs of equal pieces that
go to runs of sequences - is looked up by every piece from its length and its rank among the pieces of that length. The
result is the best-fit-decreasing packing of the whole table, not of one shard at a time. Within the packing a segment
tree over remaining capacities finds the tightest open sequence in logarithmic time; pieces of one length move together.

Ranks come from two steps that any table can bear: a running count within each written part, and for each part the number
of such pieces in the parts before it. No length, however common, goes to one task.

Defined results: null or empty text: one piece holding the end id; repeated rows are packed each for itself (rows that
share a doc_id too); an empty table gives no rows; other input columns are left out; doc_id may be null.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from burrowline.llm.common import ready, staged, text_of
from burrowline.llm.word_ids import opened

#: Documents handled together.
ROWS = 1024
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, local_rank long"
PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """Cut every document's ids (with the end id) at multiples of capacity; local_rank counts equal lengths within a part."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = opened(tokenizer), np.array([end_id], "<u4").tobytes()
        seen = np.zeros(capacity + 1, np.int64)
        part = TaskContext.get().partitionId()
        for b in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            out: tuple[list, ...] = ([], [], [], [], [], [])
            flat, size = encoder.batch(b.column(1))
            raw, to = flat.tobytes(), 4 * np.cumsum(size)
            for doc, a, z in zip(b.column(0).to_pylist(), (to - 4 * size).tolist(), to.tolist(), strict=True):
                ids = raw[a:z] + end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    one = ids[at : at + 4 * capacity]
                    n = len(one) // 4
                    for o, v in zip(out, (doc, k, at // 4, n, zlib.crc32(one), int(seen[n])), strict=True):
                        o.append(v)
                    seen[n] += 1
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            cols = [pa.array(o, t) for o, t in zip(out, types, strict=True)]
            cols.insert(5, pa.array(np.full(len(out[0]), part, np.int32)))
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "local_rank"])

    ready(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).mapInArrow(cut, PIECES)


class Tightest:
    """Segment tree over remaining capacities 0..capacity: which of them open sequences have."""

    def __init__(self, capacity: int):
        self.size = 1 << (capacity + 1).bit_length()
        self.tree = bytearray(2 * self.size)

    def put(self, r: int, there: bool) -> None:
        i = r + self.size
        self.tree[i] = there
        while i > 1:
            i >>= 1
            now = self.tree[2 * i] | self.tree[2 * i + 1]
            if self.tree[i] == now:
                break
            self.tree[i] = now

    def at_least(self, r: int) -> int | None:
        i = r + self.size
        if self.tree[i]:
            return r
        while i > 1:
            if not i & 1 and self.tree[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.tree[2 * i] else 2 * i + 1
                return i - self.size
            i >>= 1
        return None


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int]], int]:
    """Runs (length, first rank, first sequence, offset) and the number of sequences.

    Items of one length that reach an open sequence fill it as far as they fit, since it then is the tightest; sequences
    with equal remaining room are kept as ranges of numbers and served together."""
    tree, rooms, runs, fresh = Tightest(capacity), [[] for _ in range(capacity + 1)], [], 0

    def give(r: int, first: int, n: int) -> None:
        if n and r:
            rooms[r].append((first, n))
            tree.put(r, True)

    for length in sorted(counts, reverse=True):
        done, total = 0, counts[length]
        while done < total:
            r = tree.at_least(length)
            if r is None:
                r = capacity
                each = r // length
                bins = -(-(total - done) // each)
                first, fresh = fresh, fresh + bins
            else:
                each = r // length
                first, n = rooms[r].pop()
                bins = min(n, -(-(total - done) // each))
                if bins < n:
                    rooms[r].append((first + bins, n - bins))
                elif not rooms[r]:
                    tree.put(r, False)
            items = min(total - done, bins * each)
            last = items - (bins - 1) * each  # in the last of these sequences
            for slot in range(each):
                here = bins if slot < last else bins - 1
                if here:
                    runs.append((length, done, first, capacity - r + slot * length))
                    done += here
            give(r - each * length, first, bins - 1)
            give(r - last * length, first + bins - 1, 1)
    return runs, fresh


def pack(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    cut = staged(pieces(docs, tokenizer, capacity, end_id), "pieces")
    per_part = cut.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    per_part = staged(per_part.withColumn("before", before), "pieces-before")
    counts = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # capacity rows at most
    runs, _ = best_fit_decreasing(counts, capacity)
    lengths, ranks, sequences, offsets = (np.array(x, np.int64) for x in zip(*runs, strict=True)) if runs else [np.zeros(0, np.int64)] * 4
    keys = (lengths << 48) + ranks
    order = np.argsort(keys, kind="stable")
    keys, ranks, sequences, offsets = keys[order], ranks[order], sequences[order], offsets[order]

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            k = np.searchsorted(keys, (length << 48) + rank, side="right") - 1
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(sequences[k] + rank - ranks[k]), pa.array(offsets[k])], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    ranked = cut.join(per_part.select("part", "length", "before").hint("merge"), ["part", "length"])
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("local_rank")).alias("rank")).mapInArrow(place, PLACED)

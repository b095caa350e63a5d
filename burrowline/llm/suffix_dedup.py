"""Removal of repeated byte strings by a hash-compared suffix sort, sharded by content.

A byte goes if a string of ``length`` (100) bytes that covers it also starts earlier: in a smaller doc_id, or earlier in
the same document. Equal strings must meet in one place without moving every suffix there:

1. Anchors. In each 100-byte string the leftmost smallest hash of its 32-byte substrings is its anchor; equal strings have
   equal anchors at equal places. Consecutive strings with one anchor form a run (some 35 of them), known by its anchor's
   hash, its length and a digest of its bytes. Runs meet by anchor hash. Of runs with equal content the first is the
   earlier one and all strings of the others go; a task sends on only the earliest of those that it has seen together (it
   compares their bytes), and remembers those that were repeated, so a passage that a third of the documents hold reaches
   its group about once per task.
2. Suffix sort. Where runs of different content share an anchor hash, their bytes are fetched and, group by group, the
   suffixes from the anchors are sorted by merging sorted runs. Two suffixes are compared by their longest common
   extension, which a binary search over prefix polynomial hashes finds in a logarithmic number of steps. Neighbours'
   extensions bound how far strings agree to the right of the anchor, prefix hashes tell what agrees to its left.
   An anchor hash with more than HOT contents (the edge of a passage that very many documents hold) is not sorted in one
   place: its runs are cut at fixed distances before the anchor to pieces that meet by the bytes which all of a piece's
   strings hold. Spark groups equal pieces for the earliest place, first within each task; pieces with few others under
   their key are sorted, and what is crowded even so is cut finer, down to single strings.
   Anchors that a sample of the documents shows to be so crowded don't even meet: their runs are dealt out by content.
3. Verification. What digests call equal is put together to spans of a document that equal spans of an earlier one; both
   sides' bytes are fetched and compared. What the sort calls equal is compared byte for byte, and so are the neighbours of
   the sorted order up to the byte after their extension. Where hashes clash, nothing is removed by them: the anchors
   concerned are judged once more by the bytes of their strings alone.
4. Per document the spans are put together and cut out.

Everything within a task is numpy over some MB at a time; documents of any length are read in overlapping slices.

Defined results: null text: no bytes; texts under 100 bytes keep all; a null doc_id counts as smaller than any other; rows
that share a doc_id count as one document, so equal strings at equal places don't remove each other (different texts under
one doc_id are told apart by 64 bits of their SHA-256); repeated rows get a row each; an empty table gives no rows; other
columns stay with ``dedup``, but for those named as its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burrowline.llm.common import ready, staged, text_of

LENGTH, GRAM = 100, 32
#: Bytes looked at together; places within them take 24 bits of a hash, which leaves 40 to compare.
SLICE, PLACE_BITS = 2 << 20, 24
CHUNK_BYTES = 3 << 20
#: Contents of one anchor hash that are sorted together.
HOT = 4096
#: Pieces of a crowded anchor's runs that are sorted together; into how many each piece of before is cut.
FINE, CUT = 256, 4
#: Documents looked at to find crowded anchors, and contents among them that make one crowded.
SAMPLE, CROWDED = 4000, 64
#: Documents, strings and repeated runs that a task remembers as sent; spans that meet one copy of their lead.
SEEN, STRINGS, KNOWN, SHARED = 1 << 18, 1 << 18, 1 << 16, 32
NO_ID = -(1 << 63)

_rng = np.random.default_rng(20240229)
#: A random 64-bit value for each byte; polynomial base, odd so that it has an inverse modulo 2^64.
VALUE = _rng.integers(0, 1 << 64, 256, dtype=np.uint64)
BASE = int(_rng.integers(0, 1 << 63)) * 2 + 1
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^i and BASE^-i modulo 2^64 for i below n."""
    if len(_POWERS[0]) < n:
        for k, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            _POWERS[k] = np.multiply.accumulate(p)
    return _POWERS[0][:n], _POWERS[1][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Prefix:
    """Prefix polynomial hashes of a byte string: any substring's hash in a few operations."""

    def __init__(self, data: np.ndarray):
        up, self.down = powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(VALUE[data] * up[:-1], out=self.sums[1:])

    def of(self, start: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        return (self.sums[start + size] - self.sums[start]) * self.down[start]

    def grams(self, size: int) -> np.ndarray:
        """Hashes of all substrings of one size."""
        return (self.sums[size:] - self.sums[:-size]) * self.down[: len(self.sums) - size]

    def extension(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Longest common extension of the suffixes at a and b, up to most, by binary search."""
        low, high = np.zeros(len(a), np.int64), most.copy()
        while (open_ := low < high).any():
            mid = (low + high + 1) >> 1
            same = self.of(a, mid) == self.of(b, mid)
            low, high = np.where(open_ & same, mid, low), np.where(open_ & ~same, mid - 1, high)
        return low


def sliding_least(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w consecutive entries, from running minima of blocks in both directions."""
    n = len(x)
    whole = np.full(-(-n // w) * w, np.iinfo(x.dtype).max, x.dtype)
    whole[:n] = x
    rows = whole.reshape(-1, w)
    ahead = np.minimum.accumulate(rows, axis=1).reshape(-1)
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[: n - w + 1], ahead[w - 1 : n])


def runs_of(data: np.ndarray, bounds: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """start, number of strings, anchor's place and anchor hash of each run; bounds: where the texts in data begin and end."""
    none = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    n = len(data)
    if n < length:
        return none
    hashes = mixed(Prefix(data).grams(gram))
    bits = np.uint64(PLACE_BITS)
    place = np.arange(len(hashes), dtype=np.uint64)
    least = sliding_least((hashes >> bits << bits) | place, length - gram + 1)
    anchor = (least & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    ok = np.zeros(n - length + 2, np.int64)
    size = np.diff(bounds)
    first, last = bounds[:-1][size >= length], bounds[1:][size >= length] - length
    np.add.at(ok, first, 1)
    np.add.at(ok, last + 1, -1)
    ok = np.cumsum(ok[:-1]) > 0
    new = ok.copy()
    new[1:] &= (anchor[1:] != anchor[:-1]) | ~ok[:-1]
    new[first] = True
    end = ok.copy()
    end[:-1] &= new[1:] | ~ok[1:]
    start = np.flatnonzero(new)
    return start, np.flatnonzero(end) + 1 - start, anchor[start], hashes[anchor[start]]


def slices(size: int, length: int) -> Iterator[tuple[int, int]]:
    """Slices of a text that hold each string of the given length once."""
    for at in range(0, max(size - length + 1, 1), SLICE):
        yield at, min(size, at + SLICE + length - 1)


def firsts(key: tuple[np.ndarray, ...], order: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Rows sorted by key then order, and which of them are the first of their key."""
    at = np.lexsort((*reversed(order), *reversed(key)))
    new = np.ones(len(at), bool)
    if len(at):
        new[1:] = np.any([k[at][1:] != k[at][:-1] for k in key], axis=0)
    return at, new


class Known:
    """Repeated runs that a task has sent, with their bytes: what stands later and has the same bytes needn't be sent."""

    def __init__(self):
        self.of: dict[tuple[int, int], tuple[int, int, bytes]] = {}
        self.keys = np.zeros(0, np.int64)

    def repeated(self, k, digest, dk, at, text) -> np.ndarray:
        """Which runs a known one stands before."""
        out = np.zeros(len(k), bool)
        for i in np.flatnonzero(member(k ^ digest, self.keys)).tolist():
            found = self.of.get((int(k[i]), int(digest[i])))
            out[i] = found is not None and found[:2] < (int(dk[i]), int(at[i])) and found[2] == text(i)
        return out

    def keep(self, rows, k, digest, dk, at, text) -> None:
        """Take up runs, at most KNOWN of them; an earlier place replaces a later one."""
        for i in rows.tolist():
            key, place = (int(k[i]), int(digest[i])), (int(dk[i]), int(at[i]))
            if (key in self.of and place < self.of[key][:2]) or (key not in self.of and len(self.of) < KNOWN):
                self.of[key] = *place, text(i)
        if len(rows):
            self.keys = np.unique(np.array([a ^ b for a, b in self.of], np.int64))


RUNS = "part long, k long, digest long, dk long, sid long, start long, n int, repeated boolean"


def runs(keyed: DataFrame, length: int, gram: int, crowded: np.ndarray, bits: int = 64) -> DataFrame:
    """keyed (dk, sid, text) -> RUNS; repeated: an equal run stands earlier, seen within the task. part: where runs meet, by
    anchor hash or, for crowded ones (sorted), by content too. Digests are cut to some bits."""
    mask = np.uint64((1 << bits) - 1)

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, int, bytes]] = []
        size = 0
        known = Known()

        def solve() -> pa.RecordBatch:
            data = b"".join(x[3] for x in held)
            sizes = np.array([len(x[3]) for x in held])
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            start, n, anchor, k = runs_of(np.frombuffer(data, np.uint8), bounds, length, gram)
            k = k.view(np.int64)
            digest64 = xxhash.xxh3_64_intdigest
            digest = np.array([digest64(data[a:b], 7) for a, b in zip(start.tolist(), (start + n + length - 1).tolist(), strict=True)], np.uint64)
            digest = (digest & mask).view(np.int64)
            doc = np.searchsorted(bounds, start, side="right") - 1
            dk, sid, base = (np.array([x[c] for x in held], np.int64)[doc] for c in range(3))
            at_doc = start - bounds[doc] + base
            at, new = firsts((k, digest), (dk, at_doc))
            # rows that share a doc_id: an equal place isn't earlier
            lead = at[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))] if len(at) else at
            same_place = (dk[at] == dk[lead]) & (at_doc[at] == at_doc[lead])
            gone = np.zeros(len(at), bool)
            gone[at] = ~same_place
            first = np.empty_like(at)
            first[at] = lead
            there, again = np.flatnonzero(gone), first[gone]
            spans = zip(start[there].tolist(), n[there].tolist(), start[again].tolist(), n[again].tolist(), strict=True)
            more = length - 1
            gone[there] = [data[x : x + i + more] == data[y : y + j + more] for x, i, y, j in spans]
            often = np.unique(again[gone[there]])  # first ones of this slice that have been repeated
            before = known.repeated(k, digest, dk, at_doc, lambda i: data[start[i] : start[i] + n[i] + more])
            known.keep(often[~before[often]], k, digest, dk, at_doc, lambda i: data[start[i] : start[i] + n[i] + more])
            gone |= before
            # neighbouring runs that go are sent as one, dealt out by their document
            order = np.lexsort((at_doc, doc))
            order = order[gone[order]]
            cut = np.ones(len(order), bool)
            if len(order):
                cut[1:] = (doc[order][1:] != doc[order][:-1]) | (at_doc[order][1:] != (at_doc + n)[order][:-1])
            total = np.add.reduceat(n[order], np.flatnonzero(cut)) if len(order) else np.zeros(0, np.int64)
            head, stay = order[cut], np.flatnonzero(~gone)
            spread = mixed((dk[head] * 31 + at_doc[head]).view(np.uint64)).view(np.int64)
            both = lambda a, b: pa.array(np.concatenate([a, b]))
            part = np.where(member(k, crowded), mixed((k ^ digest * 31).view(np.uint64)).view(np.int64), k)
            return pa.RecordBatch.from_arrays([both(part[stay], spread), both(k[stay], spread), both(digest[stay], spread * 0), both(dk[stay], dk[head]), both(sid[stay], sid[head]), both(at_doc[stay], at_doc[head]), both(n[stay].astype(np.int32), total.astype(np.int32)), both(np.zeros(len(stay), bool), np.ones(len(head), bool))], names=["part", "k", "digest", "dk", "sid", "start", "n", "repeated"])

        for b in batches:
            for dk, sid, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                raw = text.as_buffer()
                if raw.size < length:
                    continue
                for a, z in slices(raw.size, length):
                    if held and size + z - a > SLICE:
                        yield solve()
                        held.clear()
                        size = 0
                    held.append((dk, sid, a, raw.slice(a, z - a).to_pybytes()))
                    size += z - a
        if held:
            yield solve()

    return keyed.select("dk", "sid", "text").mapInArrow(scan, RUNS)


def member(x: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Which of x are in a sorted array."""
    return of[np.minimum(np.searchsorted(of, x), len(of) - 1)] == x if len(of) else np.zeros(len(x), bool)


def crowded_anchors(keyed: DataFrame, length: int, gram: int) -> np.ndarray:
    """Anchor hashes with many contents in a sample of the documents, sorted. They decide how runs are dealt, not what goes."""
    n = keyed.count()
    if not n:
        return np.zeros(0, np.int64)
    some = runs(keyed.sample(min(1.0, SAMPLE / n), 11), length, gram, np.zeros(0, np.int64)).filter("NOT repeated")
    counts = some.groupBy("k").agg(F.count_distinct("digest").alias("n")).filter(F.col("n") > CROWDED)
    return np.sort(counts.select("k").toArrow().column("k").to_numpy())  # the sample's runs / CROWDED at most


def grouped(batches: Iterable[pa.RecordBatch], enough: int, weight, columns: tuple[str, ...] = ("k",)) -> Iterator[pa.Table]:
    """Batches sorted by columns, put together into tables that never part rows with the same values of them."""
    held: list[pa.RecordBatch] = []
    size = 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        size += weight(b)
        if size >= enough:
            t = pa.Table.from_batches(held)
            keys = [t.column(c).to_numpy() for c in columns]
            before = np.flatnonzero(np.any([k != k[-1] for k in keys], axis=0))
            if len(before):
                cut = int(before[-1]) + 1
                yield t.slice(0, cut)
                rest = t.slice(cut)
                held = rest.combine_chunks().to_batches()
                size = sum(map(weight, held))
    if held:
        yield pa.Table.from_batches(held)


MARKS = "kind int, k long, dk long, sid long, start long, n int, ldk long, lsid long, lstart long"
#: Kinds of marks: strings that go (bytes compared); strings that go if their bytes are those of the lead (ldk, lsid, lstart);
#: first runs of the contents of one anchor, to be sorted, or too many of them.
GONE, EQUAL, COMPARE, CROWD = range(4)


def judged(found: DataFrame, crowded: np.ndarray) -> DataFrame:
    """RUNS met by anchor hash -> MARKS. Rows come sorted and pass through; at most HOT contents of an anchor are held."""
    most = HOT

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("k", "digest", "dk", "sid", "start", "n")
        last = np.zeros((6, 0), np.int64)  # the content that the next rows may repeat
        held: list[np.ndarray] = []  # contents of the anchor that the next rows may go on with
        over = None  # an anchor that has had more than HOT

        def marks(kind: int, rows: np.ndarray, leads: np.ndarray | None = None) -> pa.RecordBatch:
            cols = [pa.array(np.full(rows.shape[1], kind, np.int32)), *(pa.array(rows[i]) for i in (0, 2, 3, 4)), pa.array(rows[5].astype(np.int32))]
            cols += [pa.array(leads[i]) for i in (2, 3, 4)] if leads is not None else [pa.nulls(rows.shape[1], pa.int64())] * 3
            return pa.RecordBatch.from_arrays(cols, names=[x.split()[0] for x in MARKS.split(", ")])

        def closed(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
            """Contents of anchors of which no more will come."""
            _, at, count = np.unique(rows[0], return_inverse=True, return_counts=True)
            size, hot = count[at] if rows.shape[1] else count, member(rows[0], crowded)
            yield marks(CROWD, rows[:, hot | (size > most)])
            yield marks(COMPARE, rows[:, ~hot & (size > 1) & (size <= most)])

        for b in batches:
            rows = np.stack([b.column(c).to_numpy().astype(np.int64) for c in names])
            repeated = b.column("repeated").to_numpy(zero_copy_only=False)
            yield marks(GONE, rows[:, repeated])
            rows = np.concatenate([last, rows[:, ~repeated]], axis=1)
            if not rows.shape[1]:
                continue
            new = np.ones(rows.shape[1], bool)
            new[1:] = (rows[0, 1:] != rows[0, :-1]) | (rows[1, 1:] != rows[1, :-1])
            lead = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
            later = ~new & ((rows[2] != rows[2, lead]) | (rows[4] != rows[4, lead]))
            yield marks(EQUAL, rows[:, later], rows[:, lead[later]])
            new[: last.shape[1]] = False  # was taken up before
            last = rows[:, lead[-1:]]
            heads = np.concatenate([*held, rows[:, new]], axis=1)
            if over is not None:
                yield marks(CROWD, heads[:, heads[0] == over])
                heads = heads[:, heads[0] != over]
            end = heads[0] == last[0, 0]
            yield from closed(heads[:, ~end])
            held = [heads[:, end]]
            if over != last[0, 0]:
                over = None
            if held[0].shape[1] > most:
                over = int(last[0, 0])
                yield marks(CROWD, held[0])
                held = []
        yield from closed(np.concatenate([*held, np.zeros((6, 0), np.int64)], axis=1))

    order = ("part", "k", "digest", "dk", "start")
    return found.repartition("part").sortWithinPartitions(*order).mapInArrow(run, MARKS)


SPANS = "dk long, sid long, start long, n int, ldk long, lsid long, lstart long"


def joined_spans(marks: DataFrame) -> DataFrame:
    """EQUAL marks -> SPANS: neighbouring runs of a document that equal neighbouring runs of one other document, as one."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in grouped(batches, 200_000, lambda b: b.num_rows, ("dk", "sid")):
            cols = [t.column(c).to_numpy() for c in ("dk", "sid", "start", "n", "ldk", "lsid", "lstart")]
            dk, sid, start, n, ldk, lsid, lstart = cols
            new = np.ones(len(dk), bool)
            same = (dk[1:] == dk[:-1]) & (sid[1:] == sid[:-1]) & (ldk[1:] == ldk[:-1]) & (lsid[1:] == lsid[:-1])
            new[1:] = ~(same & (start[1:] == (start + n)[:-1]) & (lstart[1:] == (lstart + n)[:-1]))
            head = np.flatnonzero(new)
            total = np.add.reduceat(n, head).astype(np.int32) if len(head) else n
            yield pa.RecordBatch.from_arrays([pa.array(total if c is n else c[head]) for c in cols], names=[x.split()[0] for x in SPANS.split(", ")])

    rows = marks.filter(F.col("kind") == EQUAL).select("dk", "sid", "start", "n", "ldk", "lsid", "lstart")
    by = ("dk", "sid")  # a text that very many documents have is dealt out by them
    return staged(rows.repartition(*by).sortWithinPartitions(*by, "ldk", "lsid", "start").mapInArrow(run, SPANS), "spans")


CONTEXTS = "kind int, k long, lead boolean, dk long, sid long, start long, n int, anchor int, context binary"


def wanted_spans(spans: DataFrame) -> DataFrame:
    """Both sides of each of SPANS, under one key: kind, k, lead, dk, sid, start, n. Spans that very many documents share with
    one lead come under several keys, SHARED to each, with a copy of the lead."""
    of = ["ldk", "lsid", "lstart", "n"]
    often = spans.groupBy(*of).agg(F.ceil(F.count("*") / SHARED).cast("int").alias("parts")).filter("parts > 1")
    often = staged(often, "often")
    part = F.coalesce(F.pmod(F.xxhash64("dk", "sid", "start"), F.col("parts")).cast("int"), F.lit(0))
    dealt = spans.join(often, of, "left").withColumn("part", part)
    key = F.xxhash64(*of, "part").alias("k")
    later = dealt.select(F.lit(EQUAL).alias("kind"), key, F.lit(False).alias("lead"), "dk", "sid", "start", "n")
    every = spans.select(*of).distinct().join(often, of, "left").select(*of, F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part"))
    first = every.select(F.lit(EQUAL).alias("kind"), key, F.lit(True).alias("lead"), F.col("ldk").alias("dk"), F.col("lsid").alias("sid"), F.col("lstart").alias("start"), "n")
    return later.unionByName(first)


def contexts(keyed: DataFrame, wanted: DataFrame, length: int, gram: int) -> DataFrame:
    """The bytes of the runs that must be compared, read from their documents; anchor: its place in the context (0 for spans,
    whose bytes come compressed)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                raw = pa.decompress(b.column("packed")[r].as_py(), b.column("size")[r].as_py(), "zstd", asbytes=True)
                asked = [x.to_numpy(zero_copy_only=False) for x in b.column("runs")[r].values.flatten()]
                room = np.cumsum(asked[4].astype(np.int64) + length - 1) // CHUNK_BYTES
                for some in np.split(np.arange(len(room)), np.flatnonzero(np.diff(room)) + 1):
                    kind, k, lead, start, n = (x[some] for x in asked)
                    texts = [raw[a : a + m + length - 1] for a, m in zip(start.tolist(), n.tolist(), strict=True)]
                    # the anchor is where the run's first string has its least hash: found as in runs_of
                    anchor = np.zeros(len(texts), np.int32)
                    own = np.flatnonzero(kind != EQUAL)
                    if len(own):
                        hashes = mixed(Prefix(np.frombuffer(b"".join([texts[i][:length] for i in own]), np.uint8)).grams(gram))
                        rows = np.arange(len(own))[:, None] * length + np.arange(length - gram + 1)[None, :]
                        anchor[own] = (hashes[rows] == k[own].view(np.uint64)[:, None]).argmax(axis=1)
                    squeezed_: dict[tuple[int, int], bytes] = {}  # copies of a lead are one span
                    for i in np.flatnonzero(kind == EQUAL):
                        span = int(start[i]), int(n[i])
                        if span not in squeezed_:
                            squeezed_[span] = len(texts[i]).to_bytes(8, "little") + pa.compress(texts[i], "zstd", asbytes=True)
                        texts[i] = squeezed_[span]
                    m = len(texts)
                    same = [pa.array(np.full(m, b.column(c)[r].as_py(), np.int64)) for c in ("dk", "sid")]
                    yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(k), pa.array(lead, pa.bool_()), *same, pa.array(start), pa.array(n), pa.array(anchor), pa.array(texts, pa.binary())], names=[x.split()[0] for x in CONTEXTS.split(", ")])

    want = wanted.groupBy("dk", "sid").agg(F.collect_list(F.struct("kind", "k", "lead", "start", "n")).alias("runs"))
    return squeezed(keyed).join(want, ["dk", "sid"]).select("dk", "sid", "packed", "size", "runs").mapInArrow(run, CONTEXTS)


def squeezed(keyed: DataFrame) -> DataFrame:
    """keyed with its text compressed (packed, size), so that less moves; a task sends repeated rows once."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for b in batches:
            keys = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
            new = [i for i, x in enumerate(keys) if not (x in seen or seen.add(x))]
            if len(seen) > SEEN:
                seen.clear()
            raw = [b.column(2)[i].as_buffer() for i in new]
            take = pa.array(new, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take), pa.array([pa.compress(x, "zstd", asbytes=True) for x in raw], pa.binary()), pa.array([x.size for x in raw], pa.int64())], names=["dk", "sid", "packed", "size"])

    return keyed.select("dk", "sid", "text").mapInArrow(run, "dk long, sid long, packed binary, size long")


def merge_sorted(prefix: Prefix, group: np.ndarray, at: np.ndarray, size: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mergesort of the suffixes data[at : at + size] within each group (rows come group by group).

    All merges of a level run together: a row's place in its sibling run is found by binary search, each comparison being
    one common extension and the byte after it. Returns the order and each row's extension with the one before it."""
    n = len(at)
    first = np.concatenate([[True], group[1:] != group[:-1]])
    begin = np.flatnonzero(first)[np.cumsum(first) - 1]
    count = np.bincount(np.cumsum(first) - 1)[np.cumsum(first) - 1]
    order, width, place = np.arange(n), 1, np.arange(n) - begin
    most = int(count.max(initial=1))
    while width < most:
        rows = np.flatnonzero(count > width)
        p = place[rows]  # row i of the level stands at begin + p, in run p // width
        other = (p // width) ^ 1
        low = begin[rows] + other * width
        end = begin[rows] + np.minimum((other + 1) * width, count[rows])
        right = (p // width) & 1 == 1
        lone = low >= begin[rows] + count[rows]
        high = np.where(lone, low, end)
        base = low.copy()
        me = order[rows]
        while (open_ := low < high).any():
            go = np.flatnonzero(open_)
            mid = (low[go] + high[go]) >> 1
            you, mine = order[mid], me[go]
            both = np.minimum(size[you], size[mine])
            ext = prefix.extension(at[you], at[mine], both)
            done = ext == both
            a = np.where(ext < size[you], data[np.minimum(at[you] + ext, len(data) - 1)].astype(np.int64), -1)
            b = np.where(ext < size[mine], data[np.minimum(at[mine] + ext, len(data) - 1)].astype(np.int64), -1)
            tie = done & (size[you] == size[mine])
            before = np.where(tie, right[go], a < b)  # does the sibling's row stand before mine
            low[go] = np.where(before, mid + 1, low[go])
            high[go] = np.where(before, high[go], mid)
        pair = (p // (2 * width)) * 2 * width
        new = begin[rows] + pair + (p % width) + np.where(lone, 0, low - base)
        moved = order.copy()
        moved[new] = me
        order = moved
        width *= 2
    ext = np.zeros(n, np.int64)
    if n > 1:
        a, b = order[:-1], order[1:]
        ext[1:] = prefix.extension(at[a], at[b], np.minimum(size[a], size[b]))
    ext[first] = 0
    return order, ext


def equal_bytes(eights: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether size bytes (8 or more) at a and at b are the same, eight at a time."""
    equal, most = np.ones(len(a), bool), int(size.max(initial=0))
    for step in range(0, most, 8):
        at = np.minimum(step, size - 8)
        equal &= (eights[a + at] == eights[b + at]).all(axis=1)
    return equal


def matched(k, dk, start, n, anchor, texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and starts of the strings that an earlier one of the same anchor group equals, by the suffix sort; by the bytes of
    the strings alone if any hash turns out to have clashed."""
    data = np.frombuffer(b"".join(texts) + bytes(16), np.uint8)
    sizes = np.array([len(x) for x in texts], np.int64)
    base = np.cumsum(sizes) - sizes
    prefix = Prefix(data)
    at = base + anchor
    order, ext = merge_sorted(prefix, k, at, sizes - anchor, data)
    eights = np.lib.stride_tricks.sliding_window_view(data, 8)
    # neighbours agree as far as their extension says and no farther, and stand in the right order
    one, two, both = at[order[:-1]], at[order[1:]], ext[1:]
    room = [(sizes - anchor)[order[:-1]], (sizes - anchor)[order[1:]]]
    long = both >= 8
    fine = bool(equal_bytes(eights, one[long], two[long], both[long]).all())
    for step in range(8):
        some = ~long & (both > step)
        fine &= bool((data[one[some] + step] == data[two[some] + step]).all())
    inner = (both < np.minimum(*room)) & (k[order[:-1]] == k[order[1:]])
    fine &= bool((data[(one + both)[inner]] < data[(two + both)[inner]]).all())
    rank = np.argsort(np.lexsort((start + anchor, dk)))[order]  # which comes earlier, at one offset
    low, high = (anchor - n + 1)[order], anchor[order].astype(np.int64)
    at_sorted, by_rank = at[order], np.argsort(rank)
    rows, firsts_, offsets = [], [], []
    where = dk[order], (start + anchor)[order]
    for o in range(max(0, int(low.min(initial=0))), int(high.max(initial=-1)) + 1):
        # offset o: strings that begin o bytes before the anchor; extensions tell what agrees from the anchor on
        here = by_rank[(low[by_rank] <= o) & (o <= high[by_rank])]
        if len(here) < 2:
            continue
        block = np.cumsum(ext < length - o)
        tag = mixed(prefix.of(at_sorted[here] - o, o) + block[here].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        srt = np.argsort(tag, kind="stable")
        tag, here = tag[srt], here[srt]
        new = np.concatenate([[True], tag[1:] != tag[:-1]])
        lead = here[np.maximum.accumulate(np.where(new, np.arange(len(here)), 0))]
        later = ~new & ((where[0][here] != where[0][lead]) | (where[1][here] != where[1][lead]))
        fine &= bool((k[order][here] == k[order][lead]).all())
        rows.append(here[~new])
        firsts_.append(lead[~new])
        offsets.append(np.where(later[~new], o, -1 - o))
    row, lead, o = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (rows, firsts_, offsets))
    later, o = o >= 0, np.where(o >= 0, o, -1 - o)
    fine &= bool(equal_bytes(eights, at_sorted[row] - o, at_sorted[lead] - o, np.full(len(row), length)).all())
    if fine:
        row, o = order[row[later]], o[later]
        return row, start[row] + anchor[row] - o
    first: dict[tuple[int, bytes], tuple[int, int]] = {}
    strings = [(i, j, (int(k[i]), texts[i][j : j + length]), (int(dk[i]), int(start[i]) + j)) for i in range(len(texts)) for j in range(int(n[i]))]
    for _, _, x, place in strings:
        first[x] = min(first.get(x, place), place)
    gone = [(i, int(start[i]) + j) for i, j, x, place in strings if place != first[x]]
    return np.array([i for i, _ in gone], np.int64), np.array([x for _, x in gone], np.int64)


FOUND = "dk long, sid long, start long, n int, clash boolean"


def compared(found: DataFrame, length: int) -> DataFrame:
    """CONTEXTS -> FOUND: strings that an earlier one of the same anchor group equals, and spans whose bytes are the lead's; with
    clash the spans that only share the lead's digests."""

    def sorted_group(t: pa.Table) -> pa.RecordBatch:
        k, dk, sid, start, n, anchor = (t.column(c).to_numpy() for c in ("k", "dk", "sid", "start", "n", "anchor"))
        d, s = matched(k, dk, start, n, anchor, t.column("context").to_pylist(), length)
        by = np.lexsort((s, sid[d], dk[d]))
        s, d = s[by], d[by]
        cut = np.ones(len(s), bool)
        if len(s):
            cut[1:] = (dk[d][1:] != dk[d][:-1]) | (sid[d][1:] != sid[d][:-1]) | (s[1:] > s[:-1] + 1)
        head = np.flatnonzero(cut)
        last = np.concatenate([head[1:], [len(s)]]) - 1 if len(s) else head
        return rows(dk[d[head]], sid[d[head]], s[head], s[last] - s[head] + 1, np.zeros(len(head), bool))

    def rows(dk, sid, start, n, clash) -> pa.RecordBatch:
        cols = [pa.array(np.asarray(x, np.int64)) for x in (dk, sid, start)]
        return pa.RecordBatch.from_arrays([*cols, pa.array(np.asarray(n, np.int32)), pa.array(np.asarray(clash, bool))], names=["dk", "sid", "start", "n", "clash"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leads: dict[tuple, bytes] = {}  # of one key, which come before what repeats them
        key = None

        def spans() -> Iterator[pa.RecordBatch]:
            nonlocal key
            for b in batches:
                equal = pc.equal(b.column("kind"), EQUAL)
                if pc.any(equal).as_py():
                    out: tuple[list, ...] = ([], [], [], [], [])
                    mine = b.filter(equal)
                    cols = [mine.column(c).to_pylist() for c in ("k", "lead", "dk", "sid", "start", "n", "context")]
                    for k, lead, dk, sid, start, n, packed in zip(*cols, strict=True):
                        if k != key:
                            key = k
                            leads.clear()
                        raw = pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), "zstd", asbytes=True)
                        if lead:
                            leads[dk, sid, start, n] = raw
                        else:  # several leads under one key would be a clash of that key
                            for o, v in zip(out, (dk, sid, start, n, len(leads) != 1 or raw not in leads.values()), strict=True):
                                o.append(v)
                    waiting.append(rows(*out))
                if not pc.all(equal).as_py():
                    yield b.filter(pc.invert(equal))

        waiting: list[pa.RecordBatch] = []
        for t in grouped(spans(), CHUNK_BYTES, lambda b: b.column("context").nbytes):
            yield from waiting
            waiting.clear()
            yield sorted_group(t)
        yield from waiting

    return staged(found.repartition("k").sortWithinPartitions("kind", "k", F.desc("lead"), "dk", "start").mapInArrow(run, FOUND), "found")


def finer_runs(found: DataFrame, width: int, length: int) -> DataFrame:
    """CONTEXTS -> (k, content, dk, sid, start, n, anchor): each run cut at every width-th place before its anchor. k: the bytes
    that all strings between two such places hold, so that equal strings have an equal k. With null for content the pieces that
    the task has seen before, which stand later, neighbours as one. Rows come in the order of their places."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, tuple[int, int]] = {}
        for b in batches:
            out: tuple[list, ...] = tuple([] for _ in range(7))
            cols = [b.column(c).to_pylist() for c in ("dk", "sid", "start", "n", "anchor", "context")]
            for dk, sid, start, n, anchor, text in zip(*cols, strict=True):
                later, i = None, 0
                while i < n:
                    low = (anchor - i) // width * width  # of the piece's strings, at most so far before the anchor as the first is
                    m = min(n, anchor - low + 1) - i
                    content, place = text[i : i + m + length - 1], (dk, start + i)
                    again = (first := seen.setdefault(content, place)) < place
                    if place < first:
                        seen[content] = place
                    if again and later is not None:
                        out[5][later] += m
                    else:
                        later = len(out[0]) if again else None
                        held = text[anchor - low : anchor - low - width + 1 + length]
                        k = xxhash.xxh3_64_intdigest(held, width << 32 | low) - (1 << 63)
                        for o, v in zip(out, (k, None if again else content, dk, sid, start + i, m, anchor - i), strict=True):
                            o.append(v)
                    i += m
            if len(seen) > STRINGS:
                seen.clear()
            kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(o, k) for o, k in zip(out, kinds, strict=True)], names=["k", "content", "dk", "sid", "start", "n", "anchor"])

    rows = found.select("dk", "sid", "start", "n", "anchor", "context").sortWithinPartitions("dk", "start")
    return staged(rows.mapInArrow(run, "k long, content binary, dk long, sid long, start long, n int, anchor int"), "strings")


def strings_compared(found: DataFrame, length: int, gram: int) -> DataFrame:
    """CONTEXTS -> (dk, sid, start, n): the same as compared(), but no anchor's contexts must meet. Runs are cut to ever finer
    pieces, which meet by the bytes that their strings have in common: equal pieces are grouped by their bytes, pieces that at
    most FINE share a key with are sorted, and only what is crowded even so is cut again, down to single strings."""
    width, out, few = length - gram + 1, [], []
    while True:
        width = -(-width // CUT)
        each = finer_runs(found, width, length)
        own = each.filter("content IS NOT NULL")
        least = staged(own.groupBy("k", "content").agg(F.min(F.struct("dk", "start")).alias("first")), "least")
        met = staged(own.join(least, ["k", "content"]).withColumn("again", F.struct("dk", "start") != F.col("first")).drop("first"), "met")
        out += [each.filter("content IS NULL"), met.filter("again")]
        heads = met.filter("NOT again")
        sizes = staged(heads.groupBy("k").agg(F.count("*").alias("size")).filter("size > 1"), "sizes")
        sized = heads.join(sizes, "k").select(F.lit(COMPARE).alias("kind"), "k", F.lit(False).alias("lead"), "dk", "sid", "start", "n", "anchor", F.col("content").alias("context"), "size")
        few.append(sized.filter((F.col("size") <= FINE) | F.lit(width == 1)).drop("size"))
        found = None if width == 1 else staged(sized.filter(F.col("size") > FINE), "finer")
        if found is None or found.isEmpty():
            break
    out.append(compared(reduce(DataFrame.unionByName, few), length))
    return reduce(DataFrame.unionByName, [x.select("dk", "sid", "start", "n") for x in out])


def keyed_docs(docs: DataFrame) -> DataFrame:
    """docs' columns as c0, c1, ..., with dk, sid and text."""
    named = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]
    t = text_of("`text`")
    return docs.select(*named, F.coalesce(F.col("`doc_id`").cast("long"), F.lit(NO_ID)).alias("dk"), F.xxhash64(F.sha2(t, 256)).alias("sid"), t.alias("text"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, bits: int = 64) -> DataFrame:
    """dk, sid, spans: per document the starts and numbers of the strings that go (in any order, may overlap). bits: of the
    digests that runs go by; fewer make clashes, and more work, but no other result."""
    if not 8 <= gram < length:
        raise ValueError("the anchor's substring must be shorter than the string")
    keyed = keyed_docs(docs).select("dk", "sid", "text")
    ready(docs.sparkSession)
    crowded = crowded_anchors(keyed, length, gram)
    every_run = runs(keyed, length, gram, crowded, bits)
    marks = staged(judged(every_run, crowded), "marks")
    own = ["kind", "k", F.lit(False).alias("lead"), "dk", "sid", "start", "n"]
    wanted = marks.filter(F.col("kind") == COMPARE).select(*own).unionByName(wanted_spans(joined_spans(marks)))
    found = compared(contexts(keyed, wanted, length, gram), length)
    out = [marks.filter(F.col("kind") == GONE), found.filter("NOT clash")]
    crowd = marks.filter(F.col("kind") == CROWD)
    if not found.filter("clash").isEmpty():
        clash = found.filter("clash").select("dk", "sid", F.col("start").alias("a"), (F.col("start") + F.col("n")).alias("z"))
        anchors = marks.filter(F.col("kind") == EQUAL).join(clash, ["dk", "sid"]).filter("start >= a AND start < z").select("k").distinct()
        again = every_run.filter("NOT repeated").join(anchors, "k").withColumn("kind", F.lit(CROWD))
        crowd = crowd.select(*own).unionByName(again.select(*own)).distinct()
    if not crowd.isEmpty():
        fetched = staged(contexts(keyed, crowd.select(*own), length, gram), "crowd")
        out.append(strings_compared(fetched, length, gram))
    every = [x.select("dk", "sid", "start", "n") for x in out]
    return reduce(DataFrame.unionByName, every).groupBy("dk", "sid").agg(F.collect_list(F.struct("start", "n")).alias("spans"))


def kept_bytes(raw: bytes, start: np.ndarray, n: np.ndarray, length: int) -> tuple[bytes, int, int, list[tuple[int, int]]]:
    """The bytes that stay, how many go, in how many maximal runs, and the pieces that stay."""
    by = np.argsort(start, kind="stable")
    a, z = start[by], (start + n + length - 1)[by]
    z = np.maximum.accumulate(z)
    new = np.concatenate([[True], a[1:] > z[:-1]])
    head = np.flatnonzero(new)
    a, z = a[head], z[np.concatenate([head[1:], [len(z)]]) - 1]
    stay = list(zip([0, *z.tolist()], [*a.tolist(), len(raw)], strict=True))
    return b"".join([raw[x:y] for x, y in stay]), int((z - a).sum()), len(a), stay


def _applied(docs: DataFrame, length: int, gram: int, as_text: bool, bits: int = 64) -> DataFrame:
    last = "text" if as_text else "kept_sha256"
    made = ("n_bytes", "n_removed", "n_spans", last)
    stay = [(i, f) for i, f in enumerate(docs.schema) if f.name == "doc_id" or (as_text and f.name not in ("n_bytes", "n_removed", "n_spans", "text"))]
    own = [f"c{i}" for i, _ in stay]

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = [t.as_buffer() for t in b.column("text")]
            cols = [c for c in b.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in cols), pa.array([x.size for x in raw], pa.int64()), pa.array([pa.compress(x, "zstd", asbytes=True) for x in raw], pa.binary())], names=[*cols, "size", "packed"])

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: tuple[list, ...] = ([], [], [], [])
            for size, packed, spans in zip(b.column("size").to_pylist(), b.column("packed").to_pylist(), b.column("spans"), strict=True):
                raw = pa.decompress(packed, size, "zstd", asbytes=True)
                gone, runs_ = 0, 0
                if spans.is_valid:
                    start, n = (x.to_numpy() for x in spans.values.flatten())
                    raw, gone, runs_, _ = kept_bytes(raw, start, n.astype(np.int64), length)
                for o, v in zip(out, (size, gone, runs_, raw.decode("utf-8", "ignore") if as_text else hashlib.sha256(raw).hexdigest()), strict=True):
                    o.append(v)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in own), *(pa.array(o, pa.int64()) for o in out[:3]), pa.array(out[3], pa.string())], names=[*own, *made])

    described = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in stay)
    packed = keyed_docs(docs).select(*own, "dk", "sid", "text").mapInArrow(pack, f"{described}, dk long, sid long, size long, packed binary")
    spans = staged(repeated_spans(docs, length, gram, bits), "cuts")  # written, so that Spark can split the join of a hot text
    both = packed.join(spans, ["dk", "sid"], "left").select(*own, "size", "packed", "spans")
    done = both.mapInArrow(cut, f"{described}, n_bytes long, n_removed long, n_spans long, {last} string")
    return done.toDF(*[f.name for _, f in stay], *made)


def dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id and the other columns, n_bytes, n_removed, n_spans, and text: what stays (a character that was cut is left out)."""
    return _applied(docs, length, gram, True)


def op9(docs: DataFrame) -> DataFrame:
    return _applied(docs, LENGTH, GRAM, False)

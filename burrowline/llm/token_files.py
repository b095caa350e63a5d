"""Token-id files: canonical length-limited Huffman codes in independent blocks.

Format, a folder with three Parquet tables:
  codebook  id, length: code lengths; the codes are canonical (by length, then id), so lengths say all
  blocks    part, block, before (ids of this part before the block), doc_ids, doc_lens, marks, payload: whole documents,
            coded most significant bit first; marks holds the bit offset of every 256th id, from where decoding can start
  index     part, base: ids of all parts before it. Parts and blocks follow ascending doc_id
Blocks are read and decoded alone; decoding goes through one table of 2^limit entries, all marks of a block at once.

Lengths come from global counts by package-merge, limited to 20 bits (more if the ids need it).

Defined results: null or empty text: the end id alone; a null doc_id comes first; rows that share a doc_id are kept each,
ordered by their number of ids, then by a hash of them; an empty table gives empty tables; other input columns are left
out. A document is never cut, so a block holds one document at least and about 2^18 ids unless one document is longer.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from burrowline.llm.common import fresh_path, ready, staged, text_of
from burrowline.llm.word_ids import opened

MARK, BLOCK_IDS, LIMIT, ROWS = 256, 1 << 18, 20, 1024


def width(tokenizer: str, end_id: int) -> str:
    """Ids on their way to the files take two bytes if all of them fit."""
    return "<u2" if max(opened(tokenizer).tokenizer.get_vocab_size(True), end_id + 1) <= 1 << 16 else "<u4"


def ended(ids: np.ndarray, size: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of texts, each followed by the end id, and their numbers."""
    end = np.cumsum(size)
    return np.insert(ids, end, np.uint32(end_id)), size + 1


TOKENS = "doc_id long, n long, ids binary, counts boolean"


def encoded(docs: DataFrame, tokenizer: str, kind: str, end_id: int = 1) -> DataFrame:
    """TOKENS: a document's ids with the end id, compressed; and of each task one row (counts) that tells how often each id
    came up in it, so that the ids need not be read again to count them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = opened(tokenizer)
        total = np.zeros(max(encoder.tokenizer.get_vocab_size(True), end_id + 1), np.int64)
        types = (pa.int64(), pa.int64(), pa.binary(), pa.bool_())
        rows = lambda *cols: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["doc_id", "n", "ids", "counts"])
        for b in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            ids, size = ended(*encoder.batch(b.column(1)), end_id)
            total += np.bincount(ids, minlength=len(total))
            raw = ids.astype(kind)
            end = np.cumsum(size)
            packed = [pa.compress(raw[a:z].tobytes(), "zstd", asbytes=True) for a, z in zip((end - size).tolist(), end.tolist(), strict=True)]
            yield rows(b.column(0), size, packed, np.zeros(len(size), bool))
        yield rows([None], [len(total)], [pa.compress(total.tobytes(), "zstd", asbytes=True)], [True])

    ready(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).mapInArrow(run, TOKENS)


def unpacked(b: pa.RecordBatch, kind: str) -> list[np.ndarray]:
    size = np.dtype(kind).itemsize
    return [np.frombuffer(pa.decompress(x.as_buffer(), n * size, "zstd"), kind) for n, x in zip(b.column("n").to_pylist(), b.column("ids"), strict=True)]


def id_counts(tokens: DataFrame) -> DataFrame:
    """id, n over all documents, from the tasks' counts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for one in unpacked(b, "<i8"):
                at = np.flatnonzero(one)
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(one[at], pa.int64())], names=["id", "n"])

    return tokens.filter("counts").select("n", "ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Optimal code lengths of at most limit bits (package-merge); counts are positive."""
    n = len(counts)
    if n <= 1:
        return np.ones(n, np.int64)
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.int64)
    level, own = leaves, [np.ones(n, bool)]
    for _ in range(limit - 1):
        packages = level[: len(level) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([leaves, packages])
        at = np.argsort(both, kind="stable")
        level = both[at]
        own.append(at < n)
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for flags in reversed(own):
        k = int(flags[:take].sum())
        lengths[:k] += 1
        take = 2 * (take - k)
    out = np.zeros(n, np.int64)
    out[order] = lengths
    return out


class Book:
    """Canonical codes of ids with given lengths."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        at = np.lexsort((ids, lengths))
        self.ids, self.lengths = ids[at].astype(np.int64), lengths[at].astype(np.int64)
        self.limit = int(self.lengths.max(initial=1))
        span = np.int64(1) << (self.limit - self.lengths)
        self.codes = (np.cumsum(span) - span) >> (self.limit - self.lengths)

    def to_codes(self) -> tuple[np.ndarray, np.ndarray]:
        size = int(self.ids.max(initial=0)) + 1
        codes, lengths = np.zeros(size, np.uint64), np.zeros(size, np.int64)
        codes[self.ids], lengths[self.ids] = self.codes, self.lengths
        return codes, lengths

    def to_table(self) -> np.ndarray:
        """For each run of limit bits the id that it begins with, and that id's length in the last 6 bits."""
        span = np.int64(1) << (self.limit - self.lengths)
        table = np.ones(1 << self.limit, np.int64 if self.ids.max(initial=0) >= 1 << 25 else np.int32)
        table[: span.sum()] = np.repeat((self.ids << 6) | self.lengths, span)
        return table


def pack_bits(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The coded ids, and the bit offset of every MARK-th of them."""
    size = lengths[ids]
    end = np.cumsum(size)
    start = end - size
    words = np.zeros((int(end[-1]) >> 6) + 2, np.uint64)
    word, bit = start >> 6, start & 63
    free = 64 - bit - size  # below zero: the code goes on in the next word
    code = codes[ids]
    high = np.where(free >= 0, code << np.maximum(free, 0).astype(np.uint64), code >> np.maximum(-free, 0).astype(np.uint64))
    first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    words[word[first]] = np.bitwise_or.reduceat(high, first)
    over = np.flatnonzero(free < 0)
    words[word[over] + 1] |= code[over] << (64 + free[over]).astype(np.uint64)
    return words.astype(">u8").tobytes(), start[::MARK]


def unpack_bits(payload: bytes, marks: np.ndarray, n: int, table: np.ndarray, limit: int) -> np.ndarray:
    """All stretches between marks at once, one id of each per step."""
    words = np.frombuffer(payload, ">u8").astype(np.uint64)
    at = marks.astype(np.int64)
    out = np.zeros((MARK, len(marks)), table.dtype)
    shift, top, one, last = np.uint64(64 - limit), len(words) - 2, np.uint64(1), np.uint64(63)
    for step in range(min(MARK, n)):
        word, bit = np.minimum(at >> 6, top), (at & 63).astype(np.uint64)
        found = table[((words[word] << bit) | ((words[word + 1] >> one) >> (last - bit))) >> shift]
        out[step] = found
        at += found & 63
    return (out >> 6).T.reshape(-1)[:n]


def write(docs: DataFrame, tokenizer: str, end_id: int = 1, path: str | None = None) -> str:
    """Write the files of docs and return their folder."""
    spark = docs.sparkSession
    path = path or fresh_path(spark, "token-files")
    kind = width(tokenizer, end_id)
    tokens = staged(encoded(docs, tokenizer, kind, end_id), "tokens", partition_by="counts")
    counted = sorted((r["id"], r["n"]) for r in id_counts(tokens).collect())  # as many rows as the vocabulary has ids, at most
    ids, counts = (np.array([x[k] for x in counted], np.int64) for k in (0, 1))
    lengths = code_lengths(counts, max(LIMIT, len(ids).bit_length() + 1))
    codebook = spark.createDataFrame([(int(i), int(n)) for i, n in zip(ids, lengths, strict=True)], "id long, length int")
    codebook.coalesce(1).write.parquet(f"{path}/codebook")

    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, sizes = Book(ids, lengths).to_codes()
        part, block, before = TaskContext.get().partitionId(), 0, 0
        docs_here: list[int | None] = []
        held: list[np.ndarray] = []
        names = ["part", "block", "before", "doc_ids", "doc_lens", "marks", "payload"]

        def flush() -> pa.RecordBatch:
            nonlocal block, before
            payload, marks = pack_bits(np.concatenate(held), codes, sizes)
            lens = [len(x) for x in held]
            row = pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([before], pa.int64()), pa.array([docs_here], pa.list_(pa.int64())), pa.array([lens], pa.list_(pa.int64())), pa.array([marks], pa.list_(pa.int64())), pa.array([payload], pa.binary())], names=names)
            block, before = block + 1, before + sum(lens)
            docs_here.clear()
            held.clear()
            return row

        waiting = 0
        for b in batches:
            for doc, ids_here in zip(b.column("doc_id").to_pylist(), unpacked(b, kind), strict=True):
                docs_here.append(doc)
                held.append(ids_here)
                waiting += len(ids_here)
                if waiting >= BLOCK_IDS:
                    waiting = 0
                    yield flush()
        if held:
            yield flush()

    schema = "part int, block int, before long, doc_ids array<long>, doc_lens array<long>, marks array<long>, payload binary"
    # rows that share a doc_id part by what else tells them apart, and equal rows by their place, so no id fills one task
    tie = tokens.filter("NOT counts").select("doc_id", "n", "ids", F.xxhash64("ids").alias("_h"), F.monotonically_increasing_id().alias("_at"))
    order = [F.col("doc_id").asc_nulls_first(), "n", "_h", "_at"]
    ordered = tie.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "n", "ids")
    ordered.mapInArrow(blocks, schema).write.option("compression", "uncompressed").parquet(f"{path}/blocks")
    sizes = spark.read.parquet(f"{path}/blocks").select("part", F.aggregate("doc_lens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    rows, base = [], 0
    for r in sizes.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect():  # a row for each written part
        rows.append((r["part"], base))
        base += r["n"]
    spark.createDataFrame(rows, "part int, base long").coalesce(1).write.parquet(f"{path}/index")
    return path


def read(spark: SparkSession, path: str, checksum: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids (little-endian 32-bit), from the files alone; or ids_crc32 in place of ids."""
    book = spark.read.parquet(f"{path}/codebook").collect()  # as many rows as the vocabulary has ids, at most
    ids, lengths = (np.array([r[k] for r in book], np.int64) for k in ("id", "length"))
    base = {r["part"]: r["base"] for r in spark.read.parquet(f"{path}/index").collect()}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = Book(ids, lengths)
        table = book.to_table()
        for b in batches:
            for r in range(b.num_rows):
                row = {c: b.column(c)[r].as_py() for c in b.schema.names}
                lens = np.array(row["doc_lens"], np.int64)
                ends = np.cumsum(lens)
                found = unpack_bits(row["payload"], np.array(row["marks"]), int(ends[-1]), table, book.limit).astype("<u4")
                out = [found[e - n : e].tobytes() for e, n in zip(ends, lens, strict=True)]
                last = pa.array(list(map(zlib.crc32, out)), pa.int64()) if checksum else pa.array(out, pa.binary())
                starts = base[row["part"]] + row["before"] + ends - lens
                yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], pa.int64()), pa.array(starts), pa.array(lens), last], names=["doc_id", "start", "n_tokens", name])

    ready(spark)
    name = "ids_crc32" if checksum else "ids"
    return spark.read.parquet(f"{path}/blocks").mapInArrow(run, f"doc_id long, start long, n_tokens long, {name} {'long' if checksum else 'binary'}")


def op10(docs: DataFrame, tokenizer: str) -> DataFrame:
    spark = docs.sparkSession
    return read(spark, write(docs, tokenizer), checksum=True)



"""Token counts from a cache keyed by content digest and tokenizer-version digest.

Counts are stored as Parquet rows (content, tokenizer, n_tokens). Documents are joined to them by the SHA-256 of their
normalised content; of the contents without a stored count each distinct one is encoded once, and its count is appended
to the cache. Normalising must not change a count, so it only turns null into the empty text.

A table can be counted in several shares, one after another: what the first share stored is a hit for the next, as a crawl
that repeats what an earlier one held. The cache is read by content, so a count that two writers appended is one.

Copies are dropped twice before anything is encoded: within each task as it reads (so a text that a third of the rows
hold moves once per task at most), and where equal digests meet. Texts move compressed. A task that is run again writes
the same rows, and the cache is only read after its write has been committed.

Defined results: null or empty text: 0 bytes and the tokenizer's count of "" (0); repeated rows get a row each; an empty
table gives no rows; other input columns are left out; doc_id may be null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from burrowline.llm.common import fresh_path, ready, staged, text_of

CACHE = "content binary, tokenizer string, n_tokens long"
SEEN = 200_000


def version(tokenizer: str) -> str:
    """Digest of the tokenizer's file and of the library that runs it."""
    import importlib.metadata

    library = "sentencepiece" if tokenizer.endswith(".model") else "tokenizers"
    with open(tokenizer, "rb") as f:
        return hashlib.sha256(f.read() + f"{library} {importlib.metadata.version(library)}".encode()).hexdigest()


_OPEN: dict = {}


def counter(path: str):
    """texts -> token counts, as the library gives them; one per Python worker and file."""
    if path not in _OPEN:
        if path.endswith(".model"):
            import sentencepiece

            library = sentencepiece.SentencePieceProcessor(model_file=path)
            _OPEN[path] = lambda texts: [len(x) for x in library.encode(texts, num_threads=1)] if texts else []
        else:
            from burrowline.llm.word_ids import opened

            _OPEN[path] = lambda texts: opened(path).batch(pa.array(texts, pa.string()))[1].tolist()
    return _OPEN[path]


def stored(spark: SparkSession, cache: str, tokenizer: str) -> DataFrame | None:
    """The cached counts of this tokenizer version; None if nothing has been stored yet."""
    try:
        rows = spark.read.schema(CACHE).parquet(cache).filter(F.col("tokenizer") == tokenizer)
        return rows.groupBy("content").agg(F.min("n_tokens").alias("n_tokens"))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def add_missing(docs: DataFrame, tokenizer: str, cache: str) -> None:
    """Encode what the cache doesn't hold and append the counts."""

    def distinct_texts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for b in batches:
            keys, texts = [], []
            for x in b.column(0):
                raw = x.as_buffer()
                k = hashlib.sha256(raw).digest()
                if k not in seen:
                    seen.add(k)
                    keys.append(k)
                    texts.append(len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True))
            if len(seen) > SEEN:
                seen.clear()
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(texts, pa.binary())], names=["content", "text"])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, last = counter(tokenizer), None  # rows come sorted by content
        for b in batches:
            for at in range(0, b.num_rows, 128):
                part = b.slice(at, 128)
                texts = {}
                for k, z in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    if k != last:
                        last = k
                        texts[k] = pa.decompress(z[8:], int.from_bytes(z[:8], "little"), "zstd", asbytes=True).decode()
                yield pa.RecordBatch.from_arrays([pa.array(list(texts), pa.binary()), pa.array(run(list(texts.values())), pa.int64())], names=["content", "n_tokens"])

    spark = docs.sparkSession
    ready(spark)
    texts = docs.select(text_of().alias("text")).mapInArrow(distinct_texts, "content binary, text binary")
    v = version(tokenizer)
    known = stored(spark, cache, v)
    if known is not None:
        texts = texts.join(known, "content", "left_anti")
    counted = texts.repartition("content").sortWithinPartitions("content").mapInArrow(count, "content binary, n_tokens long")
    counted.select("content", F.lit(v).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache)


def token_counts(docs: DataFrame, tokenizer: str, cache: str | None = None, limit: int = 4096, shares: int = 1) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit. Without a cache folder a new one is begun. shares: into how many parts the
    table is dealt by its ids; each of them joins what those before it have stored."""
    spark = docs.sparkSession
    cache = cache or fresh_path(spark, "token-counts")
    own = [F.col("doc_id").cast("long"), F.octet_length(text_of()).cast("long").alias("n_bytes"), F.unhex(F.sha2(text_of(), 256)).alias("content")]
    keyed = staged(docs.select(*own), "digests")
    for k in range(shares):
        add_missing(docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(shares)) == k) if shares > 1 else docs, tokenizer, cache)
    known = staged(stored(spark, cache, version(tokenizer)), "counts")  # written, so that Spark can split the join of a hot text
    return keyed.join(known, "content").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))

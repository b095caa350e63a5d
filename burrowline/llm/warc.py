"""Content-addressed web archive: payload bytes once by their SHA-256, exact record headers beside them.

An archive is a folder with two tables. `headers` has a row per page: the exact header block of its WARC record (WARC
fields, then the HTTP header) and the payload's digest. `payloads` has each payload once, by digest. A record is its header,
its payload and a blank line; it comes back through a join by digest.

Of the records with equal payloads of at least `least` bytes the one with the smallest page_id is a response, the others
are revisits that name it and have no payload in the WARC file. Smaller payloads are stored once as well, but each of their
records is a response.

A digest is verified before its payload is stored: each task compares the bytes of equal digests as it reads, sends one
copy of each on, and what meets from several tasks is compared again; different bytes under one digest stop the job. On the
way back each stored payload is hashed anew and held against its key and its records' lengths (`intact`).

What is joined or grouped by digest are rows of fixed size, the groups' first records staged before the join, so that Spark
can split the partition of a page that a third of all hosts serve; of its payload each task moves one copy.

Defined results: html null or empty: payload of 0 bytes; url null: no target field; line breaks within a url are written as
%0D and %0A; page_id null: no page field, after all others in order, and never named as a revisit's page (the record is);
equal page_ids: the record read first; repeated rows: a record each, one of them the response; no rows: an empty archive;
other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from burrowline.llm.common import discard, fresh_path, ready, staged, text_of

#: Names and forms of the WARC format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n"

HEADERS = "digest binary, header string"
PAYLOADS = "digest binary, payload binary"
LEAST = 100
HELD = 32 << 20


def payload_of(html: str = "html") -> Column:
    return text_of(html).cast("binary")


def urn(page_id: Column, rec: Column) -> Column:
    """A record's name: a UUID of version 8 made of the SHA-256 of its page and place."""
    h = F.sha2(F.concat_ws(":", F.coalesce(page_id.cast("string"), F.lit("-")), rec.cast("string")).cast("binary"), 256)
    parts = [F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("8"), F.substring(h, 13, 3)), F.concat(F.lit("8"), F.substring(h, 16, 3)), F.substring(h, 19, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def field(name: str, value: Column) -> Column:
    """A header line; an empty text where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(END)), F.lit(""))


def header_of(date: str) -> Column:
    """The header block of a record (page_id, url, rec, digest, n_bytes, and lead_page, lead_rec for revisits)."""
    revisit = F.col("lead_rec").isNotNull()
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "), F.col("n_bytes").cast("string"), F.lit(END + END))
    target = F.replace(F.replace(F.col("url").cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.concat(
        F.lit(VERSION + END), field("WARC-Type", F.when(revisit, "revisit").otherwise("response")), field("WARC-Record-ID", urn(F.col("page_id"), F.col("rec"))), field("WARC-Date", F.lit(date)),
        field("WARC-Target-URI", target), field("Page-ID", F.col("page_id").cast("string")), field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.lower(F.hex("digest")))),
        field("WARC-Profile", F.when(revisit, REVISIT_PROFILE)), field("WARC-Refers-To", F.when(revisit, urn(F.col("lead_page"), F.col("lead_rec")))), field("Refers-To-Page-ID", F.when(revisit, F.col("lead_page").cast("string"))),
        field("Content-Type", F.lit("application/http; msgtype=response")), field("Content-Length", (F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("n_bytes"))).cast("string")), F.lit(END), http,
    )


def distinct_payloads(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each payload of a task once, compressed; those that are held to compare with take HELD bytes at most."""
    seen: dict[bytes, bytes] = {}
    held = 0
    for b in batches:
        keys, sent = [], []
        for x in b.column(0):
            raw = x.as_py()
            k = hashlib.sha256(raw).digest()
            if k in seen:
                if seen[k] != raw:
                    raise ValueError(f"different payloads under digest {k.hex()}")
                continue
            held += len(raw)
            if held > HELD:
                seen.clear()
                held = len(raw)
            seen[k] = raw
            keys.append(k)
            sent.append(len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True))
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(sent, pa.binary())], names=["digest", "payload"])


def verified_payloads(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by digest: one payload of each, after its bytes were compared with the other tasks' copies."""
    last, stored = None, b""
    for b in batches:
        keys, out = [], []
        for k, z in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            raw = pa.decompress(z[8:], int.from_bytes(z[:8], "little"), "zstd", asbytes=True)
            if k == last:
                if raw != stored:
                    raise ValueError(f"different payloads under digest {k.hex()}")
                continue
            last, stored = k, raw
            keys.append(k)
            out.append(raw)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(out, pa.binary())], names=["digest", "payload"])


def archive(pages: DataFrame, folder: str | None = None, least: int = LEAST, date: str = "1970-01-01T00:00:00Z") -> str:
    """Write an archive of pages (page_id, url, html) and return its folder."""
    spark = pages.sparkSession
    ready(spark)
    folder = folder or fresh_path(spark, "warc")
    facts = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.unhex(F.sha2(payload_of(), 256)).alias("digest"), F.octet_length(payload_of()).cast("long").alias("n_bytes"))
    records = staged(facts.withColumn("rec", F.monotonically_increasing_id()), "warc-records")
    first = F.min(F.struct(F.col("page_id").isNull().alias("no_page"), "page_id", "rec")).alias("first")
    shared = records.filter(F.col("n_bytes") >= least).groupBy("digest").agg(first, F.count("*").alias("n")).filter("n > 1")
    leads = staged(shared.select("digest", F.col("first.page_id").alias("lead_page"), F.col("first.rec").alias("lead_rec")), "warc-leads")
    joined = records.join(leads, "digest", "left")
    named = joined.withColumn("lead_rec", F.when(F.col("lead_rec") != F.col("rec"), F.col("lead_rec")))
    named.select("digest", header_of(date).alias("header")).write.option("compression", "zstd").parquet(f"{folder}/headers")
    sent = pages.select(payload_of().alias("payload")).mapInArrow(distinct_payloads, PAYLOADS)
    stored = sent.repartition("digest").sortWithinPartitions("digest").mapInArrow(verified_payloads, PAYLOADS)
    stored.write.option("compression", "zstd").parquet(f"{folder}/payloads")
    discard(records, leads)
    return folder


def headers(spark: SparkSession, folder: str) -> DataFrame:
    """The records' fields, parsed from their headers: digest, record_type, page_id, refers_to, target, stated (the
    payload's length) and the header itself."""
    line = lambda name: F.regexp_extract("header", rf"\r\n{name}: ([^\r\n]*)\r\n", 1)
    some = lambda c: F.when(c != "", c)
    http = F.substring_index("header", END + END, -2)
    stated = F.regexp_extract(http, r"Content-Length: ([0-9]+)", 1).cast("long")
    return spark.read.schema(HEADERS).parquet(f"{folder}/headers").select(
        "digest", line("WARC-Type").alias("record_type"), some(line("Page-ID")).cast("long").alias("page_id"), some(line("Refers-To-Page-ID")).cast("long").alias("refers_to"),
        some(line("WARC-Target-URI")).alias("target"), stated.alias("stated"), "header",
    )


def payloads(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(PAYLOADS).parquet(f"{folder}/payloads")


def index(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, intact of each record, from the archive. The payload's
    length and digest are taken from its stored bytes; intact says whether they are what header and key state, and is false
    where the payload is missing."""
    found = payloads(spark, folder).select("digest", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest"))
    joined = headers(spark, folder).join(found, "digest", "left")
    intact = F.coalesce((F.col("payload_digest") == F.lower(F.hex("digest"))) & (F.col("payload_bytes") == F.col("stated")), F.lit(False))
    return joined.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", intact.alias("intact"))


def restored(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, target and html of every record, revisits with the payload that they refer to."""
    return headers(spark, folder).join(payloads(spark, folder), "digest").select("page_id", "target", F.col("payload").cast("string").alias("html"))


def records(spark: SparkSession, folder: str) -> DataFrame:
    """page_id and the exact record as a WARC file has it, without the blank line that ends it."""
    body = payloads(spark, folder).select("digest", F.col("payload").cast("string").alias("body"))
    joined = headers(spark, folder).join(body, "digest")
    return joined.select("page_id", F.when(F.col("record_type") == "revisit", F.col("header")).otherwise(F.concat("header", "body")).alias("record"))


def write_files(spark: SparkSession, folder: str, target: str, compression: str = "none") -> None:
    """An archive as WARC files, one for each task. A record ends in a blank line, which is the sink's separator."""
    records(spark, folder).select("record").write.option("compression", compression).text(target, lineSep=END + END)


def op11(pages: DataFrame) -> DataFrame:
    """Write the pages' archive and read its records back."""
    return index(pages.sparkSession, archive(pages))


SQL = """WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages), r AS (SELECT page_id, strlen(h) AS n, sha256(h) AS d, min(page_id) OVER (PARTITION BY h) AS lead FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest, CASE WHEN n >= 100 AND page_id <> lead THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN n >= 100 AND page_id <> lead THEN lead END AS refers_to, true AS intact FROM r"""

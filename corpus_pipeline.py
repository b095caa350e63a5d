"""A training-data pipeline: documents in, packed sequences out."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from burrowline.llm import packing, pii, quality_rules, simhash, suffix_dedup
from burrowline.llm.common import fresh_path

POLICY = "prose-1"


def apart(docs: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """docs with its other columns under numbers, so that no measure of an operator can have the name of one, and what puts
    them back as they were. n_chars, where there is one, follows the text."""
    own = [c for c in docs.columns if c not in ("doc_id", "text")]
    numbered = docs.select("doc_id", "text", *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(own)])

    def back(found: DataFrame) -> DataFrame:
        held = {c: F.col(f"c{i}") for i, c in enumerate(own)} | {c: F.col(c) for c in ("doc_id", "text")}
        if "n_chars" in held:
            held["n_chars"] = F.length("text").cast("long")
        return found.select(*[held[c].alias(c) for c in docs.columns])

    return numbered, back


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that every rule of the policy passes (op 1)."""
    numbered, back = apart(docs)
    return back(quality_rules.apply_policy(quality_rules.ledger(numbered), POLICY).filter("kept"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose 5-word shingles are similar by 0.8 or more (op 6)."""
    return simhash.keep_one(docs, size=5, similarity=0.8)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of 100-byte strings that stood earlier (op 9). All documents stay, some emptied."""
    numbered, back = apart(docs)
    return back(suffix_dedup.dedup(numbered))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind (op 2)."""
    numbered, back = apart(docs)
    return back(pii.redact(numbered))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the texts' ids, placed in sequences of 4096 (op 5)."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_strings", repeated_strings),
    ("personal_data", personal_data),
    ("packing", packed),
]

#: Later stages call a tokenizer and work on bytes, which SQL can't express; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; each one's rows are written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

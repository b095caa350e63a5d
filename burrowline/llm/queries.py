"""The registered queries: each applies one operator, with its production parameters, to the whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from burrowline.llm import fill_in_middle, filter_audit, packing, pii, quality_rules, secrets, sentencepiece_bpe, simhash, suffix_dedup, token_counts, token_files, topk, warc
from burrowline.llm.common import documents


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.op1(documents(spark, sf_dir))


def quality_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of each policy of operator 1 rejects, from the stored ledger."""
    return quality_rules.ablation(quality_rules.stored_ledger(documents(spark, sf_dir)))


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(documents(spark, sf_dir))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets(documents(spark, sf_dir))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_bpe.op4(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In two shares, so that the second one meets stored counts."""
    return token_counts.token_counts(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"), shares=2)


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.op9(documents(spark, sf_dir))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.op10(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.op11(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.op12(documents(spark, sf_dir))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        quality_ablation,
        op2_personal_data,
        op3_secrets,
        op4_sentencepiece,
        op5_best_fit_packing,
        op6_simhash,
        op7_top_k,
        op8_token_counts,
        op9_suffix_dedup,
        op10_token_files,
        op11_warc,
        op12_fill_in_middle,
        op13_filter_audit,
    )
}
#: The others tokenize, hash or iterate in ways that SQL can't state; tests hold them against brute force.
ORACLES: dict[str, str] = {"op1_quality_rules": quality_rules.SQL, "quality_ablation": quality_rules.ABLATION_SQL, "op7_top_k": topk.SQL, "op11_warc": warc.SQL, "op12_fill_in_middle": fill_in_middle.SQL, "op13_filter_audit": filter_audit.SQL}

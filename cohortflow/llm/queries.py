"""The registered queries of this subpackage; their SQL is in sql.py."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cohortflow.llm.decontamination import overlaps
from cohortflow.llm.language_id import identify
from cohortflow.llm.line_dedup import drop_repeated_lines, line_digests
from cohortflow.llm.lm_scoring import score_texts
from cohortflow.llm.merkle_manifest import manifest, verified
from cohortflow.llm.minhash_dedup import near_duplicates
from cohortflow.llm.quality_rules import apply_quality_rules
from cohortflow.llm.source_mixing import mix_sources, words_taken
from cohortflow.llm.substring_dedup import repeated_spans
from cohortflow.llm.token_alignment import align_and_score
from cohortflow.llm.token_counts import count_tokens
from cohortflow.llm.token_ids import read_token_ids, write_token_ids
from cohortflow.llm.warc import page_records, write_warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """A public vocabulary on the driver."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_records(write_warc(table(spark, sf_dir, "pages")))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words_taken(*mix_sources(table(spark, sf_dir, "documents")))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op7_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return read_token_ids(write_token_ids(docs, tokenizer_path("word_bpe_49k.json")))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans(table(spark, sf_dir, "documents"), within=True)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return align_and_score(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verified(manifest(table(spark, sf_dir, "documents")))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_digests(drop_repeated_lines(table(spark, sf_dir, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_dedup": op1_minhash_dedup,
    "op2_warc": op2_warc,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_quality_rules": op4_quality_rules,
    "op5_source_mixing": op5_source_mixing,
    "op6_language_id": op6_language_id,
    "op7_token_ids": op7_token_ids,
    "op8_decontamination": op8_decontamination,
    "op9_token_counts": op9_token_counts,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_token_alignment": op11_token_alignment,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_line_dedup": op13_line_dedup,
}

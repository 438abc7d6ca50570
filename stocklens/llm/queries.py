"""One query per operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stocklens.llm import (
    alignment,
    decontamination,
    language_model,
    main_text,
    merkle,
    oracle,
    pii,
    quality_classifier,
    quality_rules,
    sentencepiece_bpe,
    simhash,
    suffix_dedup,
    toxicity,
    url_filters,
)
from stocklens.llm.common import ship, table


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classified(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_bpe.encoded(table(spark, sf_dir, "documents"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.scores(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicated(table(spark, sf_dir, "documents"), with_kept=False)


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judged_pages(table(spark, sf_dir, "pages"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = quality_rules.ledger(table(spark, sf_dir, "documents"))
    return quality_rules.judged(entries).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "failures",
    )


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.scores(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned_documents(table(spark, sf_dir, "documents"))


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extracted(table(spark, sf_dir, "pages"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_quality_classifier,
        op2_sentencepiece,
        op3_pii,
        op4_toxicity,
        op5_suffix_dedup,
        op6_url_filters,
        op7_decontamination,
        op8_simhash,
        op9_quality_rules,
        op10_lm_scoring,
        op11_merkle_manifest,
        op12_tokenizer_alignment,
        op13_html_extraction,
    )

    def shipped(query: Callable) -> Callable[[SparkSession, str], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return query(spark, sf_dir)

        return run

    return {f.__name__: shipped(f) for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op9_quality_rules": oracle.QUALITY_RULES, "op11_merkle_manifest": oracle.MERKLE_MANIFEST}

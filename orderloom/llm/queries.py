"""The queries of this package, each an operator over its whole table, and their SQL."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orderloom.llm import conversations, decontaminate, embeddings, html, language, packing, pii, quality, simhash, tokens, toxicity, urls, whitening
from orderloom.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_token_counts(spark, sf_dir):
    return tokens.token_counts(table(spark, sf_dir, "documents"))


def op3_language_id(spark, sf_dir):
    return language.languages(table(spark, sf_dir, "documents"))


def op4_decontamination(spark, sf_dir):
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_personal_data(spark, sf_dir):
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op6_main_text(spark, sf_dir):
    return html.main_text(table(spark, sf_dir, "pages"))


def op7_url_filters(spark, sf_dir):
    return urls.verdicts(table(spark, sf_dir, "pages"))


def op8_toxicity(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark, sf_dir):
    return quality.judged(table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark, sf_dir):
    return conversations.structure_repair(table(spark, sf_dir, "conversations"))


def op12_embedding_whitening(spark, sf_dir):
    return whitening.whitening(table(spark, sf_dir, "embeddings"))


def op13_embedding_near_dedup(spark, sf_dir):
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def llm_queries() -> dict[str, Query]:
    every = (
        op1_simhash,
        op2_token_counts,
        op3_language_id,
        op4_decontamination,
        op5_personal_data,
        op6_main_text,
        op7_url_filters,
        op8_toxicity,
        op9_packing,
        op10_quality_rules,
        op11_conversation_repair,
        op12_embedding_whitening,
        op13_embedding_near_dedup,
    )
    return {f.__name__: f for f in every}


def llm_oracles() -> dict[str, str]:
    """What is plain SQL; the others are tested by brute force, round trips or held-out accuracy."""
    return {"op4_decontamination": decontaminate.CONTAMINATION_SQL, "op13_embedding_near_dedup": embeddings.NEAR_DUPLICATES_SQL}

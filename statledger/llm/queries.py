"""Registered queries of this package, each over its whole table, and their SQL twins."""

from __future__ import annotations

import functools

from statledger.llm import (
    decontaminate,
    fingerprints,
    html_text,
    jaccard,
    language,
    mixing,
    negatives,
    pii,
    quality,
    secrets,
    substrings,
    toxicity,
    whitening,
)
from statledger.llm.ship import ship_package


def table(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_mix_sources(spark, sf):
    return mixing.mix_report(table(spark, sf, "documents"))


def op2_html_extraction(spark, sf):
    return html_text.extract_pages(table(spark, sf, "pages"))


def op3_language_id(spark, sf):
    return language.language_report(table(spark, sf, "documents"))


def op4_pii(spark, sf):
    return pii.pii_report(table(spark, sf, "documents"))


def op5_decontamination(spark, sf):
    docs, benchmark = table(spark, sf, "documents"), table(spark, sf, "benchmark")
    return decontaminate.decontamination_report(docs, benchmark)


def op6_substring_dedup(spark, sf):
    return substrings.substring_report(table(spark, sf, "documents"))


def op7_secret_ownership(spark, sf):
    return secrets.secrets_report(table(spark, sf, "documents"))


def op8_jaccard_join(spark, sf):
    return jaccard.jaccard_report(table(spark, sf, "documents"))


def op9_toxicity(spark, sf):
    return toxicity.toxicity_report(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op10_quality_rules(spark, sf):
    return quality.judge_quality(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op11_embedding_whitening(spark, sf):
    return whitening.whitening_report(table(spark, sf, "embeddings"))


def op12_hard_negatives(spark, sf):
    return negatives.negatives_report(table(spark, sf, "embeddings"))


def op13_document_fingerprints(spark, sf):
    return fingerprints.fingerprint_report(table(spark, sf, "documents"))


QUERIES = [
    op1_mix_sources,
    op2_html_extraction,
    op3_language_id,
    op4_pii,
    op5_decontamination,
    op6_substring_dedup,
    op7_secret_ownership,
    op8_jaccard_join,
    op9_toxicity,
    op10_quality_rules,
    op11_embedding_whitening,
    op12_hard_negatives,
    op13_document_fingerprints,
]


def shipped(query):
    """``query`` with this package on the workers."""

    @functools.wraps(query)
    def run(spark, sf):
        ship_package(spark)
        return query(spark, sf)

    return run


def queries() -> dict:
    return {q.__name__: shipped(q) for q in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op5_decontamination": decontaminate.ORACLE, "op12_hard_negatives": negatives.ORACLE}

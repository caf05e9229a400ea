"""The training-text pipeline: stages over the documents table, each written and read again.

Language identification drops documents whose language is not recognised, the Jaccard join keeps one of each
group of near copies, decontamination drops documents that hold benchmark items, personal
data is masked, and the sources that are left are mixed to their target weights.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from statledger.llm import decontaminate, jaccard, language, mixing, pii
from statledger.llm.ship import bound_batches, ship_package
from statledger.session import written


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    bound_batches(spark)
    return language.keep_known_languages(docs)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    bound_batches(spark)
    return jaccard.keep_one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    bound_batches(spark)
    return pii.mask_pii(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


STAGES = [
    ("language", language_stage),
    ("dedup", dedup_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("mixing", mixing_stage),
]

# Trained models, masking by learned patterns and seeded selection have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that come out of all stages, with the words the mix takes of each."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {}

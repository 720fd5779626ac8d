"""The corpus pipeline: language, near-duplicates, benchmark passages, personal data, packing.

Each stage takes (spark, docs, sf_dir) and calls one operator of `orderloom.llm`
on all rows that its predecessor kept. `run` writes the result of each stage
below the shared folder and reads it again, so a lost executor costs one stage.
"""

from pyspark.sql import DataFrame, SparkSession

from orderloom.llm import decontaminate, language, packing, pii, simhash
from orderloom.llm.common import table, written


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts of no language and those the network is unsure of."""
    return language.in_a_language(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of every group of linked fingerprints."""
    return simhash.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which benchmark passages are a twentieth or more."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps all documents, with personal data masked in their text."""
    return pii.redacted(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document in its sequence."""
    return packing.pack(docs)


STAGES = [
    ("language", keep_languages),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", mask_personal_data),
    ("packing", pack_sequences),
]

# A network, fingerprints and a tokenizer are beyond SQL; the tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs

"""A training corpus from documents: language, near-copies, benchmarks, secrets, and the mix of sources.

Each stage takes (spark, docs, sf_dir), ``docs`` being all that the one before kept, and all but the
last return the columns of documents. ``run`` writes each result and reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sensorgrid.llm import decontaminate, language, mixing, secrets, simhash
from sensorgrid.llm.common import staged, table

#: No stage is SQL: language models and 64-bit fingerprints can't be stated in it.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    return language.keep_known(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, with the smallest id, of each group linked by fingerprints within two bits."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no more than a twentieth of benchmark passages."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets masked."""
    return secrets.mask_secrets(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the target weights of their sources, in a shuffled order."""
    return mixing.mix(docs)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("source_mix", source_mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    *first, (_, last) = STAGES
    for name, stage in first:
        docs = staged(stage(spark, docs, sf_dir), name)
    return last(spark, docs, sf_dir)

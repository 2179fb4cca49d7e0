"""What the operators of this package share: tables, staging, and clash-free row handling."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorgrid.session import work_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the copy.

    What follows a staged table never runs the work before it again, also when executors go.
    """
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def packed(df: DataFrame, *columns: str) -> DataFrame:
    """All columns of ``df`` as one struct ``row``, beside copies of the named ones.

    Names of further columns can't clash with those an operator adds; ``row.*`` gives them back.
    """
    return df.select(F.struct("*").alias("row"), *[df[c].alias(c) for c in columns])


def digest_of_spans(spans: Column) -> Column:
    """Lowercase hex SHA-256 of an array of texts, comma-joined."""
    return F.sha2(F.array_join(spans, ",").cast("binary"), 256)


def give_back_memory() -> None:
    """Hands memory that a task has freed back to the machine, so that a worker process kept for later tasks is small."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)

import sys
from collections import Counter
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

DATA = "/root/testdata/sf0.001"
SENTENCE = " ".join(f"word{k % 17}-{k * k % 23}" for k in range(40))

#: Nulls, empty and long texts, ties, repeated rows, and repeated ids with another text.
ODD = [
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, "one"),
    (5, "one two"),
    (6, SENTENCE),
    (6, SENTENCE),
    (6, SENTENCE + " and another end of it"),
    (7, SENTENCE.upper()),
    (8, "before it " + SENTENCE + " after it"),
    (None, SENTENCE),
    (None, None),
    (9, ("é ü " + SENTENCE + "\n") * 60),
    (-3, "x" * 70_000),
    (10, "12345 !!! ---"),
]


@pytest.fixture
def odd(spark):
    """The odd rows beside columns whose names the operators may use themselves."""
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(ODD, "doc_id bigint, text string")
    clashing = "row mark found kept n n_words id spans hits items copy probability lang_pred".split()
    return docs.select(
        "*",
        F.lit("en").alias("lang"),
        F.when(F.col("doc_id") > 5, "a").alias("source"),
        F.length("text").cast("bigint").alias("n_chars"),
        *[F.lit(f"own {c}").alias(c) for c in clashing],
    )


@pytest.fixture
def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture
def counted():
    return lambda df: Counter(tuple(r) for r in df.collect())


@pytest.fixture
def texts_of():
    return lambda df: [tuple(r) for r in df.select("doc_id", "text").collect()]

"""Near-duplicates by 64-bit fingerprints of word shingles, linked at two or fewer differing bits."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorgrid.llm.common import packed, staged
from sensorgrid.llm.components import connected_components
from sensorgrid.session import ship_package

SHINGLE_WORDS = 3
SEED = 42
RADIUS = 2
_CHUNK = 1 << 16


def fingerprint(text: bytes | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Bit i is set if it is set in over half of the shingles' hashes; no words give 0."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    width = min(shingle_words, len(words))
    shingles = map(b" ".join, zip(*(islice(words, k, None) for k in range(width)), strict=False))
    hashes = map(xxhash.xxh64_intdigest, shingles, repeat(SEED))
    total = len(words) - width + 1
    ones = np.zeros(64, np.int64)
    for start in range(0, total, _CHUNK):
        size = min(_CHUNK, total - start)
        part = np.fromiter(islice(hashes, size), np.uint64, size)
        bits = np.unpackbits(part.view(np.uint8), bitorder="little").reshape(size, 64)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.uint64)[0])


def _fingerprint_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        marks = np.fromiter((fingerprint(t.as_py()) for t in texts), np.uint64, len(texts))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("own"), pa.array(marks.view(np.int64))], ["doc_id", "own", "mark"]
        )


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, own, mark) for every row; the 64 bits of ``mark`` are those of a bigint.

    ``own`` is a hash of the text itself and tells rows apart that repeat an id.
    """
    ship_package(docs.sparkSession)
    return docs.select(
        F.col("doc_id").cast("bigint"), F.col("text").cast("string"), F.xxhash64("text").alias("own")
    ).mapInArrow(_fingerprint_batches, "doc_id bigint, own bigint, mark bigint")


def _bit(k: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), k)


def mark_links(marks: DataFrame) -> DataFrame:
    """Links (a, b) between distinct marks that connect all within two differing bits.

    Meet in the middle: a mark goes to the 65 values within one bit of it, and two marks within
    two bits meet at one value at least. A meeting point has at most 65 marks, all within two bits
    of each other, so a star from the smallest of them loses no connection. The marks at a point
    are told by which bits lead to them: one bigint and one flag, combined before the shuffle.
    """
    flips = marks.select("mark", F.explode(F.sequence(F.lit(0), F.lit(64))).alias("k"))
    at = F.when(F.col("k") < 64, F.col("mark").bitwiseXOR(_bit(F.col("k")))).otherwise(F.col("mark"))
    by = F.when(F.col("k") < 64, _bit(F.col("k"))).otherwise(F.lit(0).cast("bigint"))
    points = (
        flips.select(at.alias("at"), by.alias("bits"), (F.col("k") == 64).alias("own"))
        .groupBy("at")
        .agg(F.bit_or("bits").alias("bits"), F.max("own").alias("own"))
        .filter(F.bit_count("bits") + F.col("own").cast("int") > 1)
    )
    bits = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda k: F.col("bits").bitwiseAND(_bit(k)) != 0)
    near = F.transform(bits, lambda k: F.col("at").bitwiseXOR(_bit(k)))
    near = F.when(F.col("own"), F.array_append(near, F.col("at"))).otherwise(near)
    pairs = points.select(F.array_min(near).alias("a"), F.explode(near).alias("b"))
    return pairs.filter(
        (F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS)
    ).distinct()


def _components(docs: DataFrame) -> DataFrame:
    """(doc_id, own, mark, component_id) for every row."""
    rows = staged(fingerprints(docs), "marks")
    firsts = staged(rows.groupBy("mark").agg(F.min("doc_id").alias("first")), "firsts")
    known = firsts.filter("first IS NOT NULL")
    links = mark_links(known.select("mark"))
    links = links.join(known.select(F.col("mark").alias("a"), F.col("first").alias("x")), "a")
    links = links.join(known.select(F.col("mark").alias("b"), F.col("first").alias("y")), "b")
    roots = connected_components(links.select(F.col("x").alias("a"), F.col("y").alias("b")))
    of_mark = staged(
        firsts.join(roots, F.col("first") == F.col("node"), "left").select(
            "mark", F.coalesce("root", "first").alias("component_id")
        ),
        "mark-components",
    )
    return rows.join(of_mark, "mark").select("doc_id", "own", "mark", "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Fingerprint and component of every row: (doc_id, fingerprint, component_id).

    Words are split at ASCII white space after lower-casing A-Z; a text with fewer words than a
    shingle is one shingle; null and empty texts have fingerprint 0 and link like any other.
    ``component_id`` is the smallest doc_id reachable over links of two or fewer bits. Rows with
    a null doc_id get the component of their fingerprint, which is null if no row of it has an
    id. Repeated rows each come back. Equal fingerprints are grouped first, so a large group of
    copies is one node.
    """
    return _components(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("mark"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` without near-copies: one row of each component of ``near_duplicates`` stays.

    It is a row with the smallest id; where that id has several texts in the component, one of them
    stays, and where it has texts in several components, one in each. Rows with a null doc_id stay,
    since nothing tells which of them came first. Rows that repeat a kept row's id and text stay
    only once. Null and empty texts are copies of each other. No rows give none.
    """
    named = _components(docs).filter("doc_id IS NOT NULL")
    first = named.groupBy("component_id").agg(F.min(F.struct("doc_id", "own")).alias("kept"))
    kept = staged(first.select(F.col("kept.doc_id").alias("id"), F.col("kept.own").alias("own")), "kept")
    rows = packed(docs, "doc_id", "text").select("row", F.col("doc_id").alias("id"), F.xxhash64("text").alias("own"))
    once = rows.join(kept, ["id", "own"]).dropDuplicates(["id", "own"])
    return once.select("row.*").union(rows.filter("id IS NULL").select("row.*"))

"""Removal of lines that many documents share, by the hash of each normalised line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorgrid.llm.common import LOWER, UPPER, staged

MIN_CHARS = 1
MIN_DOCS = 10
#: Common lines, and lists of dropped places, are broadcast up to so many bytes, and shuffled beyond.
BROADCAST_BYTES = 32 << 20
_LINE_BYTES = 32

_WHITE_SPACE = " \t\n\x0b\f\r"


def line_key(line: Column) -> Column:
    """The line without ASCII white space at both ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(_WHITE_SPACE)), UPPER, LOWER)


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def hashed_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, mark, pos, a, b): the lines whose key is long enough; a and b are its two hashes."""
    placed = docs.select(
        "doc_id", F.xxhash64("text").alias("mark"), F.posexplode(_lines(F.col("text"))).alias("pos", "line")
    )
    keyed = placed.select("doc_id", "mark", "pos", line_key(F.col("line")).alias("key"))
    return keyed.filter(F.length("key") >= min_chars).select(
        "doc_id", "mark", "pos", F.xxhash64("key").alias("a"), F.xxhash64(F.lit(1), F.col("key")).alias("b")
    )


def common_lines(lines: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(a, b) of the lines that at least ``min_docs`` different documents hold.

    The distinct count first keeps a row for each line and document of a task, then counts, so a
    line that every document holds is a row for each task, not a row for each document, at its end.
    """
    return lines.groupBy("a", "b").agg(F.count_distinct("doc_id").alias("n")).filter(F.col("n") >= min_docs).drop("n")


def drop_common_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Every row without the lines that many documents share: (doc_id, n_lines, n_dropped, kept).

    Texts are split at \\n; null and empty texts are one empty line. Keys are told by two 64-bit
    hashes of different seeds. A key of at least ``min_chars`` code points in at least ``min_docs``
    documents loses its lines everywhere, also in documents that repeat it. Rows that repeat an id
    are one document; rows without an id count as none, but lose lines like any other. What stays
    is joined by \\n in its order; if nothing stays, ``kept`` is empty. Repeated rows each come back.

    Lines are shuffled as hashes, texts only where the lists of dropped places are too long to be
    broadcast. The common lines are a table of their own before they are joined, so that a join
    which shuffles has an exchange on both sides and a line that every document holds is split.
    Places are looked up by position, so the work of a text grows with its lines alone.
    """
    docs = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    lines = hashed_lines(docs, min_chars)
    common = staged(common_lines(lines, min_docs), "common-lines")
    if common.count() * _LINE_BYTES <= BROADCAST_BYTES:
        common = F.broadcast(common)
    dropped = lines.join(common, ["a", "b"], "left_semi")
    dropped = staged(
        dropped.groupBy("doc_id", "mark").agg(F.collect_set("pos").alias("gone")), "dropped-lines"
    )
    size = dropped.agg(F.sum(24 + 4 * F.size("gone"))).head()[0] or 0
    dropped = dropped.withColumnsRenamed({"doc_id": "gone_id", "mark": "gone_mark"})
    if size <= BROADCAST_BYTES:
        dropped = F.broadcast(dropped)
    same = F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.xxhash64("text") == F.col("gone_mark"))
    # exploding an array of one list makes the list a column that no later step computes again
    listed = docs.join(dropped, same, "left").select(
        "doc_id", "text", "gone", F.explode(F.array(_lines(F.col("text")))).alias("lines")
    )
    stays = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    return listed.select(
        "doc_id",
        F.size("lines").cast("bigint").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_dropped"),
        F.when(F.col("gone").isNull(), F.coalesce("text", F.lit("")))
        .otherwise(F.array_join(F.transform(stays, lambda i: F.col("lines")[i]), "\n"))
        .alias("kept"),
    )


def digest(kept: DataFrame) -> DataFrame:
    return kept.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


SQL = f"""WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
  placed AS (SELECT doc_id, i, lines[i] AS line,
      translate(trim(lines[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key
    FROM split, unnest(range(1, len(lines) + 1)) AS r(i)),
  common AS (SELECT key FROM placed WHERE length(key) >= {MIN_CHARS}
    GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCS})
  SELECT doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE c.key IS NULL), '')) AS kept_sha256
  FROM placed p LEFT JOIN common c ON p.key = c.key GROUP BY doc_id"""

"""Product codes of vectors: codebooks refined in rounds, with Orchard's search for the nearest entry."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorgrid.llm.common import staged
from sensorgrid.session import ship_package

PARTS, ENTRIES, ROUNDS = 8, 16, 6
SCALE = 4096
#: Components stay within this, so that squared distances of whole vectors stay within 64 bits.
LIMIT = 1 << 25
_ROWS = 1 << 14


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, v): vectors whose components are all finite, as integers floor(4096 x).

    Vectors that are null, empty, or hold a null or a value that is not finite are dropped.
    Integers are held within ``LIMIT``, which components beyond 8192 reach.
    """
    value = F.col("embedding").cast("array<double>")
    fine = F.forall(value, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    whole = F.transform(
        value,
        lambda x: F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), F.floor(x * SCALE))).cast("int"),
    )
    kept = vectors.filter(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & fine)
    return kept.select(F.col("vec_id").cast("bigint"), F.col("label"), whole.alias("v"))


def first_entries(vectors: DataFrame, entries: int = ENTRIES, parts: int = PARTS) -> np.ndarray | None:
    """(part, entry, place): the parts of the vectors with the smallest ids; None without vectors.

    Ids are not null; of equal ids the smaller vector comes first. The first vector that can be cut
    into equal parts sets the length; vectors of another length have no codes.
    """
    fit = vectors.filter(F.col("vec_id").isNotNull() & (F.size("v") % parts == 0))
    first = fit.orderBy("vec_id", "v").select(F.size("v").alias("size")).head()
    if first is None:
        return None
    same = fit.filter(F.size("v") == first["size"]).orderBy("vec_id", "v").limit(entries)
    taken = np.array([r["v"] for r in same.select("v").collect()], np.int64)
    return taken.reshape(len(taken), parts, -1).transpose(1, 0, 2)


class Orchard:
    """Nearest entries of one codebook, for many points side by side.

    For every entry the others stand in a list by their distance from it. A point goes down the
    list of the nearest entry so far, passing over those it has visited; when an entry is nearer,
    it goes on from the top of that entry's list. Beyond twice the distance of the nearest entry
    the list holds nothing as near, and the search stops. Equal distances go to the lower index.
    """

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        gaps = entries[:, None, :] - entries[None, :, :]
        apart = (gaps * gaps).sum(axis=2)
        self.lists = np.argsort(apart, axis=1, kind="stable")
        self.apart = np.take_along_axis(apart, self.lists, axis=1)

    def nearest(self, points: np.ndarray, start: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry of each point."""
        n, count = len(points), len(self.entries)
        best = np.zeros(n, np.int64) if start is None else start.astype(np.int64)
        off = points - self.entries[best]
        near = (off * off).sum(axis=1)
        visited = np.zeros((n, count), bool)
        visited[np.arange(n), best] = True
        place = np.zeros(n, np.int64)
        live = np.arange(n)
        while len(live):
            at, now = place[live], best[live]
            # distances, not squares, are compared with twice the distance
            on = (at < count) & (self.apart[now, np.minimum(at, count - 1)] <= 4 * near[live])
            live, at, now = live[on], at[on], now[on]
            other = self.lists[now, at]
            place[live] += 1
            new = ~visited[live, other]
            who, other = live[new], other[new]
            visited[who, other] = True
            off = points[who] - self.entries[other]
            far = (off * off).sum(axis=1)
            nearer = (far < near[who]) | ((far == near[who]) & (other < best[who]))
            who = who[nearer]
            best[who], near[who], place[who] = other[nearer], far[nearer], 0
        return best, near


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy().astype(np.int64).reshape(-1, size)


def _assigned(codebooks: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of every part of every vector."""
    cut = vectors.reshape(len(vectors), len(codebooks), -1)
    found = [Orchard(entries).nearest(cut[:, p]) for p, entries in enumerate(codebooks)]
    return np.stack([x for x, _ in found], axis=1), np.stack([d for _, d in found], axis=1)


def _sums(codebooks: np.ndarray):
    """Sums and counts of the parts that go to each entry, one row an entry and task."""
    parts, entries, width = codebooks.shape

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts, entries, width), np.int64)
        counts = np.zeros((parts, entries), np.int64)
        for batch in batches:
            for start in range(0, len(batch), _ROWS):
                vectors = _matrix(batch.column("v").slice(start, _ROWS), parts * width)
                chosen, _ = _assigned(codebooks, vectors)
                cut = vectors.reshape(len(vectors), parts, width)
                for p in range(parts):
                    np.add.at(sums[p], chosen[:, p], cut[:, p])
                    counts[p] += np.bincount(chosen[:, p], minlength=entries)
        p, e = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(p.astype(np.int32)),
                pa.array(e.astype(np.int32)),
                pa.array(counts[p, e]),
                pa.array(list(sums[p, e]), pa.list_(pa.int64())),
            ],
            ["part", "entry", "n", "total"],
        )

    return run


def refined(vectors: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """One round: every entry becomes the floor of the mean of the parts nearest to it.

    Tasks add up their own vectors; what comes to the driver is one number for each component of
    the codebooks, however many vectors there are.
    """
    sums = vectors.select("v").mapInArrow(_sums(codebooks), "part int, entry int, n bigint, total array<bigint>")
    total = (
        sums.select("part", "entry", "n", F.posexplode("total").alias("place", "value"))
        .groupBy("part", "entry", "place")
        .agg(F.sum("n").alias("n"), F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    )
    out = codebooks.copy()
    for r in total.collect():
        out[r["part"], r["entry"], r["place"]] = int(r["value"]) // r["n"]
    return out


def learn_codebooks(vectors: DataFrame, rounds: int = ROUNDS, entries: int = ENTRIES, parts: int = PARTS) -> np.ndarray | None:
    """Codebooks (part, entry, place) after ``rounds`` over all vectors; ``vectors`` has vec_id and v."""
    codebooks = first_entries(vectors, entries, parts)
    if codebooks is None:
        return None
    same = vectors.filter(F.size("v") == codebooks.shape[0] * codebooks.shape[2])
    for _ in range(rounds):
        codebooks = refined(same, codebooks)
    return codebooks


def _encoder(codebooks: np.ndarray):
    size = codebooks.shape[0] * codebooks.shape[2]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), _ROWS):
                part = batch.slice(start, _ROWS)
                chosen, near = _assigned(codebooks, _matrix(part.column("v"), size))
                codes = [row.tobytes().hex() for row in chosen.astype(np.uint8)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), part.column("label"), pa.array(codes), pa.array(near.sum(axis=1))],
                    ["vec_id", "label", "code", "error"],
                )

    return run


def encode(vectors: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error) of the vectors that have the codebooks' length."""
    label = vectors.schema["label"].dataType.simpleString()
    same = vectors.filter(F.size("v") == codebooks.shape[0] * codebooks.shape[2])
    return same.select("vec_id", "label", "v").mapInArrow(
        _encoder(codebooks), f"vec_id bigint, label {label}, code string, error bigint"
    )


def decode(codes: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """``codes`` with ``v``, the entries that each code names, one after the other."""
    books = F.array(*[F.array(*[F.array(*map(F.lit, e.tolist())) for e in part]) for part in codebooks])
    place = F.sequence(F.lit(0), F.lit(len(codebooks) - 1))

    def entry(p):
        return F.conv(F.substring("code", 2 * p + 1, F.lit(2)), 16, 10).cast("int")

    return codes.withColumn("v", F.flatten(F.transform(place, lambda p: books[p][entry(p)])))


def codebooks_digest(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def compress_vectors(vectors: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Code and error of every vector: (vec_id, code, error, label_error, codebooks_sha256).

    ``vectors`` has vec_id, embedding and label. Rows whose vector is null, empty or holds a null
    or not finite component are dropped, and so are those whose length is not that of the first
    vector that can be cut into eight equal parts; no vectors left give an empty table. Rows with
    a null id get codes but never start a codebook. Fewer than 16 vectors give fewer entries.
    ``label_error`` adds the errors of equal labels, nulls together; repeated rows each count.
    """
    spark: SparkSession = vectors.sparkSession
    ship_package(spark)
    whole = staged(whole_vectors(vectors), "vectors")
    codebooks = learn_codebooks(whole, rounds)
    if codebooks is None:
        return spark.createDataFrame(
            [], "vec_id bigint, code string, error bigint, label_error bigint, codebooks_sha256 string"
        )
    codes = staged(encode(whole, codebooks), "codes")
    by_label = codes.groupBy("label").agg(F.sum("error").alias("label_error"))
    by_label = by_label.withColumnRenamed("label", "of")
    return codes.join(by_label, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(codebooks_digest(codebooks)).alias("codebooks_sha256")
    )


def _sql() -> str:
    def near(k):
        return f"""near{k} AS MATERIALIZED (SELECT id, p, arg_min(e, d * {ENTRIES} + e) AS e, min(d) AS d
          FROM (SELECT x.id, x.p, b.e, sum((x.v - b.v) * (x.v - b.v)) AS d
            FROM cut x JOIN book{k} b ON x.p = b.p AND x.j = b.j GROUP BY x.id, x.p, b.e) GROUP BY id, p)"""

    def book(k):
        return f"""book{k} AS MATERIALIZED (SELECT b.p, b.e, b.j,
            coalesce((s.t - ((s.t % s.n) + s.n) % s.n) // s.n, b.v) AS v
          FROM book{k - 1} b LEFT JOIN (SELECT x.p, a.e, x.j, CAST(sum(x.v) AS BIGINT) AS t, count(*) AS n
            FROM cut x JOIN near{k - 1} a ON x.id = a.id AND x.p = a.p GROUP BY x.p, a.e, x.j) s
          ON b.p = s.p AND b.e = s.e AND b.j = s.j)"""

    rounds = ", ".join(f"{near(k)}, {book(k + 1)}" for k in range(ROUNDS))
    return f"""WITH kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) AS id, vec_id, label, embedding AS v,
        len(embedding) // {PARTS} AS width FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
      cut AS MATERIALIZED (SELECT id, (i - 1) // width AS p, (i - 1) % width AS j,
        CAST(floor({SCALE} * CAST(v[i] AS DOUBLE)) AS BIGINT) AS v FROM kept, unnest(range(1, len(v) + 1)) AS r(i)),
      book0 AS (SELECT p, id - 1 AS e, j, v FROM cut WHERE id <= {ENTRIES}),
      {rounds}, {near(ROUNDS)},
      codes AS (SELECT id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
        FROM near{ROUNDS} GROUP BY id)
      SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
        (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY p, e, j)) FROM book{ROUNDS}) AS codebooks_sha256
      FROM codes JOIN kept USING (id)"""


SQL = _sql()

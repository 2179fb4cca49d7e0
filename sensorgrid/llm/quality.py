"""Quality of texts: counted rules, and a calibrated regression on hashed n-grams."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorgrid.llm.common import packed
from sensorgrid.llm.windows import WordRuns, text_groups
from sensorgrid.session import ship_package

#: Labelled rows that the regression is fitted on at most; about so many are drawn by a hash.
LABELLED_ROWS = 2000
#: Fixed limits of the counted rules and of the probability.
LEAST_WORDS, MOST_REPEATED_PERCENT = 50, 50
LEAST_PROBABILITY = 0.5
_BITS = 16
_CHAR_GRAMS, _WORD_GRAMS = (2, 3), (1, 2)
_GROUPS = len(_CHAR_GRAMS) + len(_WORD_GRAMS)
_SCALE = 16.0
_STEPS, _RATE, _PENALTY = 150, 0.1, 1e-4
_SEED = 11

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


@dataclass
class Group:
    """Some texts at once: their bytes and words in one row, and the n-grams of both."""

    texts: list[bytes]

    def __post_init__(self):
        self.runs = WordRuns(self.texts)
        self.bytes = np.frombuffer(b"".join(self.texts), np.uint8)
        sizes = np.fromiter(map(len, self.texts), np.int64, len(self.texts))
        self.ends = np.cumsum(sizes)
        self.begins = self.ends - sizes

    def grams(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each kind of n-gram: buckets by place, and the places of each text, [begin, end)."""
        for n in _CHAR_GRAMS:
            size = max(0, len(self.bytes) - n + 1)
            code = np.zeros(size, np.uint32)
            for k in range(n):
                code = (code << np.uint32(8)) | self.bytes[k : k + size]
            code = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - _BITS)
            yield code, self.begins, np.maximum(self.begins, self.ends - n + 1)
        for n in _WORD_GRAMS:
            code = self.runs.hashes(n) >> np.uint64(64 - _BITS)
            begins, ends = self.runs.starts[:-1], self.runs.starts[1:]
            yield code, begins, np.maximum(begins, ends - n + 1)

    def counts(self) -> dict[str, np.ndarray]:
        def by_text(flags: np.ndarray) -> np.ndarray:
            sums = np.concatenate([[0], np.cumsum(flags)])
            return sums[self.ends] - sums[self.begins]

        n_words = np.diff(self.runs.starts)
        chars = ((self.bytes & 0xC0) != 0x80) & ~_SPACE[self.bytes]
        lines = [[x for x in t.split(b"\n") if x.strip()] for t in self.texts]
        return {
            "n_words": n_words,
            "word_chars": by_text(chars),
            "n_symbols": by_text(_SYMBOL[self.bytes]),
            "n_dup_lines": np.array([len(x) - len(set(x)) for x in lines], np.int64),
            "n_repeat_words": self._repeated(3),
        }

    def _repeated(self, width: int) -> np.ndarray:
        """Words inside runs of ``width`` words that the text has twice or more."""
        begins = self.runs.windows(width)
        own = self.runs.of[begins].astype(np.uint64) * np.uint64(0xD1342543DE82EF95)
        key = self.runs.hashes(width)[begins] ^ own
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(key), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        edges = np.zeros(len(self.runs.values) + 1, np.int64)
        np.add.at(edges, begins[twice], 1)
        np.add.at(edges, begins[twice] + width, -1)
        covered = np.concatenate([[0], np.cumsum(np.cumsum(edges)[:-1] > 0)])
        return covered[self.runs.starts[1:]] - covered[self.runs.starts[:-1]]


@dataclass(frozen=True, eq=False)
class QualityModel:
    """Weights by kind of n-gram and bucket, the intercept, and the calibration of the logit."""

    weights: np.ndarray
    intercept: float
    slope: float = 1.0
    shift: float = 0.0

    def probabilities(self, group: Group) -> np.ndarray:
        logit = np.full(len(group.texts), self.intercept)
        for kind, (code, begins, ends) in enumerate(group.grams()):
            sums = np.concatenate([[0.0], np.cumsum(self.weights[kind].take(code))])
            logit += _SCALE * (sums[ends] - sums[begins]) / np.maximum(1, ends - begins)
        return _sigmoid(self.slope * logit + self.shift)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def _feature_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sparse features: buckets and their shares of the text's n-grams of their kind."""
    for batch in batches:
        for k, text in enumerate(batch.column("text").cast(pa.binary())):
            group, places, shares = Group([text.as_py() or b""]), [], []
            for kind, (code, begins, ends) in enumerate(group.grams()):
                found, n = np.unique(code[begins[0] : ends[0]], return_counts=True)
                places.append(found.astype(np.int32) + (kind << _BITS))
                shares.append(_SCALE * n / max(1, ends[0] - begins[0]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("good").slice(k, 1),
                    batch.column("mark").slice(k, 1),
                    pa.array([np.concatenate(places).astype("<i4").tobytes()], pa.binary()),
                    pa.array([np.concatenate(shares).astype("<f4").tobytes()], pa.binary()),
                ],
                ["good", "mark", "places", "shares"],
            )


def fit(docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> QualityModel:
    """Fit on ``quality`` 0 or 1 of labelled documents, a quarter of them for the calibration.

    About ``rows`` labelled rows are drawn, by a hash of the id; this bound holds at every size.
    Without labels of both kinds there is nothing to tell apart, and every text gets 1.
    """
    spark = docs.sparkSession
    ship_package(spark)
    labels = labels.filter("quality IN (0, 1) AND doc_id IS NOT NULL").select(
        "doc_id", (F.col("quality") == 1).alias("good"), F.xxhash64("doc_id", F.lit(_SEED)).alias("mark")
    )
    share = min(1.0, rows / max(1, labels.count()))
    drawn = labels.filter(F.pmod("mark", F.lit(1 << 30)) < share * (1 << 30))
    found = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(drawn), "doc_id")
    features = found.select("good", "mark", "text").mapInArrow(
        _feature_batches, "good boolean, mark bigint, places binary, shares binary"
    )
    sample = sorted(features.toLocalIterator(), key=lambda r: (r["mark"], r["good"], bytes(r["places"])))
    fitted = [r for k, r in enumerate(sample) if k % 4]
    held = [r for k, r in enumerate(sample) if k % 4 == 0]
    if len({r["good"] for r in fitted}) < 2:
        return QualityModel(np.zeros((_GROUPS, 1 << _BITS), np.float32), 50.0)
    weights, intercept = _regression(fitted)
    logit = [
        intercept + float(weights[np.frombuffer(r["places"], "<i4")] @ np.frombuffer(r["shares"], "<f4"))
        for r in held
    ]
    slope, shift = _calibration(np.array(logit), np.array([r["good"] for r in held]))
    return QualityModel(weights.reshape(_GROUPS, -1).astype(np.float32), intercept, slope, shift)


def _regression(rows: list) -> tuple[np.ndarray, float]:
    """Logistic regression with a ridge penalty, both classes with half the weight, by Adam."""
    sizes = [len(r["places"]) // 4 for r in rows]
    places = np.concatenate([np.frombuffer(r["places"], "<i4") for r in rows])
    shares = np.concatenate([np.frombuffer(r["shares"], "<f4") for r in rows])
    used, column = np.unique(places, return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    good = np.array([r["good"] for r in rows], float)
    importance = np.where(good > 0, 0.5 / max(1, good.sum()), 0.5 / max(1, (1 - good).sum()))
    w, b = np.zeros(len(used)), 0.0
    mean, square, mean_b, square_b = np.zeros(len(used)), np.zeros(len(used)), 0.0, 0.0
    for step in range(1, _STEPS + 1):
        logit = np.add.reduceat(shares * w[column], starts) + b
        wrong = (_sigmoid(logit) - good) * importance
        slope = np.bincount(column, np.repeat(wrong, sizes) * shares, len(used)) + _PENALTY * w
        slope_b = wrong.sum()
        mean, square = 0.9 * mean + 0.1 * slope, 0.999 * square + 0.001 * slope**2
        mean_b, square_b = 0.9 * mean_b + 0.1 * slope_b, 0.999 * square_b + 0.001 * slope_b**2
        scale = _RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        w -= scale * mean / (np.sqrt(square) + 1e-8)
        b -= scale * mean_b / (np.sqrt(square_b) + 1e-8)
    weights = np.zeros(_GROUPS << _BITS)
    weights[used] = w
    return weights, float(b)


def _calibration(logit: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and shift that make logits probabilities, with targets drawn in by the class counts."""
    n_good, n_bad = good.sum(), (~good).sum()
    if not n_good or not n_bad:
        return 1.0, 0.0
    target = np.where(good, (n_good + 1) / (n_good + 2), 1 / (n_bad + 2))
    x, at = np.stack([logit, np.ones(len(logit))]), np.array([1.0, 0.0])
    for _ in range(50):
        p = _sigmoid(at @ x)
        curve = (x * (p * (1 - p))) @ x.T + 1e-6 * np.eye(2)
        step = np.linalg.solve(curve, x @ (p - target) + 1e-6 * (at - [1.0, 0.0]))
        at = at - step / max(1.0, np.abs(step).max())
    return float(at[0]), float(at[1])


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _scored(shared):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            for start, end in text_groups(texts):
                group = Group(texts[start:end])
                counts = group.counts()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row").slice(start, end - start),
                        *(pa.array(counts[name], pa.int64()) for name in _COUNTS),
                        pa.array(model.probabilities(group), pa.float64()),
                    ],
                    ["row", *_COUNTS, "probability"],
                )

    return run


def score(rows: DataFrame, model: QualityModel) -> DataFrame:
    """(row, counts, probability, base_failed, kept) for rows of (row, text), from whole texts.

    Null and empty texts have no words and fail the counted rules.
    """
    spark = rows.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)
    schema = T.StructType([rows.schema["row"]])
    for name in _COUNTS:
        schema.add(name, "long")
    rows = rows.select("row", F.col("text").cast("string").alias("text"))
    scored = rows.mapInArrow(_scored(shared), schema.add("probability", "double"))
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )
    scored = scored.withColumn("base_failed", failed)
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("probability") >= LEAST_PROBABILITY))


def quality_report(docs: DataFrame, labels: DataFrame, model: QualityModel | None = None) -> DataFrame:
    """The counts and both verdicts of every document; rows that repeat come back each."""
    scored = score(packed(docs.select("doc_id", "text"), "text"), model or fit(docs, labels))
    return scored.select(F.col("row.doc_id").alias("doc_id"), *_COUNTS, "base_failed", "kept", "probability")

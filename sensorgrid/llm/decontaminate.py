"""Benchmark passages in documents: found, measured, and removed."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorgrid.llm.common import digest_of_spans, packed, staged
from sensorgrid.llm.windows import WordRuns, text_groups
from sensorgrid.session import ship_package

WINDOW = 13
#: A document is contaminated if at least one word in so many is hit.
ONE_WORD_IN = 20
#: Benchmark text is broadcast in slices of at most so many bytes.
SLICE_BYTES = 16 << 20
_REMEMBERED = 100_000

_WORD = re.compile(rb"[^ ]+")

# A-Z become a-z; digits, a-z and everything beyond ASCII make words, the rest parts them.
_TABLE = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_TABLE).split() if text else []


class Windows:
    """Test windows by width: a bit filter, sorted hashes, and where each window stands.

    A window takes sixteen bytes beside the text of its item; its words are compared in place.
    """

    def __init__(self, items: list[tuple[str, bytes]], width: int):
        self.items = [item for item, _ in items]
        self.runs = WordRuns([text for _, text in items], _TABLE)
        self.known: dict[tuple[bytes, ...], frozenset[str]] = {}
        sizes = np.minimum(np.diff(self.runs.starts), width)
        self.by_size = {}
        for size in np.unique(sizes[sizes > 0]).tolist():
            begins = self.runs.windows(size)
            begins = begins[sizes[self.runs.of[begins]] == size]  # a short item is one window
            hashes = self.runs.hashes(size)[begins]
            order = np.argsort(hashes, kind="stable")
            bits = max(12, int(np.ceil(np.log2(len(hashes) * 16))))
            filtered = np.zeros(1 << bits, bool)
            filtered[(hashes >> np.uint64(64 - bits)).astype(np.int64)] = True
            self.by_size[size] = (bits, filtered, hashes[order], begins[order])

    def hits(self, size: int, runs: WordRuns) -> Iterator[tuple[int, frozenset[str]]]:
        """Places of test windows in texts, with the items that have them."""
        bits, filtered, hashes, _ = self.by_size[size]
        begins = runs.windows(size)
        own = runs.hashes(size)[begins]
        some = filtered[(own >> np.uint64(64 - bits)).astype(np.int64)]
        begins, own = begins[some], own[some]
        at = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
        same = hashes[at] == own
        for begin, value in zip(begins[same].tolist(), own[same], strict=True):
            owners = self.owners(runs.words(begin, size), value)
            if owners:  # the words are the same, not only the hash
                yield begin, owners

    def owners(self, words: tuple[bytes, ...], value: np.uint64) -> frozenset[str]:
        if words not in self.known:
            if len(self.known) >= _REMEMBERED:
                self.known.clear()
            _, _, hashes, begins = self.by_size[len(words)]
            low, high = np.searchsorted(hashes, value), np.searchsorted(hashes, value, "right")
            self.known[words] = frozenset(
                self.items[self.runs.of[k]]
                for k in begins[low:high].tolist()
                if self.runs.words(k, len(words)) == words
            )
        return self.known[words]


_built: dict[tuple[int, int], Windows] = {}


def _scan(shared: Broadcast, width: int, last: bool):
    key = (shared._jbroadcast.id(), width)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _built:
            _built.clear()
            _built[key] = Windows(shared.value, width)
        windows = _built[key]
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for start, end in text_groups(texts):
                part = batch.slice(start, end - start)
                runs = WordRuns(texts[start:end], _TABLE)
                edges = np.zeros(len(runs.values) + 1, np.int64)
                items = [set(x or ()) for x in part.column("items").to_pylist()]
                for size in windows.by_size:
                    for at, owners in windows.hits(size, runs):
                        items[int(runs.of[at])] |= owners
                        edges[at] += 1
                        edges[at + size] -= 1
                hit = np.cumsum(edges)[:-1] > 0
                marks = []
                before = part.column("hits").to_pylist()
                for a, b, had in zip(runs.starts[:-1], runs.starts[1:], before, strict=True):
                    if hit[a:b].any():
                        bits = np.packbits(hit[a:b])
                        had = (bits | np.frombuffer(had, np.uint8) if had else bits).tobytes()
                    marks.append(had)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("row"),
                        pa.nulls(end - start, pa.string()) if last else part.column("text"),
                        pa.array(np.diff(runs.starts)),
                        pa.array(marks, pa.binary()),
                        pa.array([sorted(x - {None}) for x in items], pa.list_(pa.string())),
                    ],
                    ["row", "text", "n_words", "hits", "items"],
                )

    return run


def _slices(benchmark: DataFrame, slice_bytes: int) -> Iterator[list[tuple[str, bytes]]]:
    """The benchmark's texts in slices of bounded size, one after the other."""
    part, size = [], 0
    for row in benchmark.toLocalIterator():
        if part and size + len(row["text"]) > slice_bytes:
            yield part
            part, size = [], 0
        part.append((row["item"], bytes(row["text"])))
        size += len(row["text"])
    yield part


def find_overlaps(
    rows: DataFrame, benchmark: DataFrame, width: int = WINDOW, slice_bytes: int = SLICE_BYTES
) -> DataFrame:
    """Words of each row inside a benchmark window: (row, n_words, hits, items).

    ``rows`` has ``text`` and ``row``, which is carried along. ``hits`` has a bit for each word,
    most significant first, and is null if no word is hit; ``items`` are the sorted ids of items
    with a window in the text, as strings. A-Z become a-z; words are runs of digits, a-z and
    characters beyond ASCII. A window is ``width`` words of an item, or all its words if it has
    fewer. Null and empty texts have no words and no hits; items without words have no windows;
    windows of items without an id are hits, but such items are in no list; repeated items count
    once. Every row comes back, as often as it stands there.

    The windows' words are broadcast, in slices of at most ``slice_bytes`` bytes of benchmark
    text (one item may be larger). A slice takes one pass without a shuffle. If there are
    several, the passes follow each other over a staged copy, and each adds its hits.
    """
    spark = rows.sparkSession
    ship_package(spark)
    items = benchmark.filter("text IS NOT NULL").select(
        F.col("item_id").cast("string").alias("item"), F.col("text").cast("binary").alias("text")
    )
    found = rows.select(
        "row",
        F.col("text").cast("string").alias("text"),
        F.lit(0).cast("bigint").alias("n_words"),
        F.lit(None).cast("binary").alias("hits"),
        F.lit(None).cast("array<string>").alias("items"),
    )
    schema, parts = found.schema, _slices(items, slice_bytes)
    part, last = next(parts), False
    while not last:
        following = next(parts, None)
        last = following is None
        found = found.mapInArrow(_scan(spark.sparkContext.broadcast(part), width, last), schema)
        if not last:
            found = staged(found, "overlaps")
        part = following
    return found.drop("text")


def summary(found: DataFrame) -> DataFrame:
    """Counts and the verdict for each row of ``find_overlaps``."""
    n_hit = F.when(F.col("hits").isNull(), 0).otherwise(
        F.aggregate(
            F.sequence(F.lit(1), F.octet_length("hits")),
            F.lit(0),
            lambda n, k: n + F.bit_count(F.conv(F.hex(F.substring("hits", k, F.lit(1))), 16, 10).cast("int")),
        )
    )
    found = found.select("row", "n_words", n_hit.cast("bigint").alias("n_hit"), "items", "hits")
    return found.withColumn(
        "contaminated", (F.col("n_hit") > 0) & (ONE_WORD_IN * F.col("n_hit") >= F.col("n_words"))
    )


def overlap_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of every document."""
    found = summary(find_overlaps(packed(docs.select("doc_id", "text"), "text"), benchmark))
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        digest_of_spans(F.col("items")).alias("items_sha256"),
        "contaminated",
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without contaminated rows; all others stay as they are, also null and empty texts and repeated rows."""
    found = summary(find_overlaps(packed(docs, "text"), benchmark))
    return found.filter(~F.col("contaminated")).select("row.*")


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = []
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        for text, hits in zip(texts, batch.column("hits").to_pylist(), strict=True):
            if hits:
                flags = np.unpackbits(np.frombuffer(hits, np.uint8)).tolist()
                spans = [m.span() for m in _WORD.finditer(text.translate(_TABLE))]
                parts, at, gap = [], 0, False
                for (a, b), hit in zip(spans, flags, strict=False):
                    if hit:
                        parts += [] if gap else [text[at:a]]
                        at = b
                    gap = bool(hit)
                text = b"".join([*parts, text[at:]])
            kept.append(text)
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(kept, pa.binary()).cast(pa.string())], ["row", "cleaned"]
        )


def cut_spans(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(row, cleaned): each text without its hit words and what stands between two of them.

    Texts without hits, null and empty ones stay as they are; repeated rows each come back.
    """
    rows = packed(docs, "text")
    found = find_overlaps(rows, benchmark).select("row", "hits", F.col("row.text").alias("text"))
    fields = {f.name: f.dataType for f in rows.schema}
    schema = T.StructType().add("row", fields["row"]).add("cleaned", "string")
    return found.mapInArrow(_cut, schema)

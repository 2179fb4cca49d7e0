"""Removal of word runs that an earlier document has, found through a count-min prefilter."""

from __future__ import annotations

import math
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorgrid.llm.common import give_back_memory, staged
from sensorgrid.llm.windows import MULTIPLIERS, WordRuns, column_groups, words_of
from sensorgrid.session import ship_package

WINDOW = 13
#: Rows of the sketch, and counters of a row at most. A merged row takes a bit for each counter, so
#: what is broadcast stays under 128 MiB. A fuller sketch passes more windows to the exact grouping.
SKETCH_ROWS = 2
MAX_SLOTS = 1 << 29
#: Counters for each byte of text: about five for each window of the corpus.
_SLOTS_PER_BYTE = 0.7
_BLOCK = 1 << 20
#: Windows that a task sketches at once, and flagged ones among which it looks for the same window.
_SKETCHED, _COMPARED = 1 << 20, 1 << 17
#: Lists of removed words are broadcast up to so many bytes, and shuffled beyond.
BROADCAST_BYTES = 32 << 20

_FLAGGED = "hi bigint, lo int, doc_id bigint, mark bigint, pos int, gone binary"
_SEED = 42


def _slots(hashes: np.ndarray, row: int, slots: int) -> np.ndarray:
    mixed = hashes if row == 0 else hashes * np.uint64(MULTIPLIERS[1])
    return ((mixed >> np.uint64(32)) * np.uint64(slots) >> np.uint64(32)).astype(np.int64)


def _sketches(slots: int):
    """Sketches of parts of a partition, as (block, counters reached, counters passed one).

    A document counts once for a counter, however many of its windows reach it.
    """
    blocks = slots // _BLOCK

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _held_bitmaps.clear()  # a worker process that is used again may hold an earlier sketch
        held: list[list[np.ndarray]] = [[] for _ in range(SKETCH_ROWS)]
        size = seen = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for row, parts in enumerate(held):
                each = np.sort(np.concatenate(parts))
                parts.clear()
                slot = each[np.r_[True, each[1:] != each[:-1]]] >> 32
                first = np.r_[True, slot[1:] != slot[:-1]]
                more = np.unique(slot[~first])
                once = slot[first]
                cuts = [np.searchsorted(x, np.arange(blocks + 1) * _BLOCK) for x in (once, more)]
                some = np.flatnonzero(np.diff(cuts[0]))
                del each, slot, first
                columns = [
                    [_coded(x[cut[k] : cut[k + 1]] - k * _BLOCK) for k in some.tolist()]
                    for x, cut in zip((once, more), cuts, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array((some + row * blocks).astype(np.int32)), *(pa.array(c, pa.binary()) for c in columns)],
                    ["block", "once", "more"],
                )
            give_back_memory()

        for batch in batches:
            for start, end, texts in column_groups(batch.column("text").cast(pa.binary())):
                runs = WordRuns(texts)
                begins = runs.windows(WINDOW)
                hashes, text = runs.hashes(WINDOW)[begins], runs.of[begins] + seen
                seen += end - start
                for row in range(SKETCH_ROWS):
                    held[row].append((_slots(hashes, row, slots) << 32) | (text & 0xFFFFFFFF))
                size += len(begins)
                if size > _SKETCHED:
                    yield from flush()
                    size = 0
        if size:
            yield from flush()

    return run


def _coded(places: np.ndarray) -> bytes:
    """Places of bits in a block, as compressed gaps, or as the bits if that is shorter."""
    if len(places) > _BLOCK >> 3:
        flags = np.zeros(_BLOCK, np.uint8)
        flags[places] = 1
        return b"b" + zlib.compress(np.packbits(flags, bitorder="little").tobytes(), 1)
    gaps = np.diff(places, prepend=0).astype("<u4").view(np.uint8).reshape(-1, 4)
    coder = zlib.compressobj(1, strategy=zlib.Z_HUFFMAN_ONLY)
    high = zlib.compress(np.ascontiguousarray(gaps[:, 1:].T).tobytes(), 1)
    low = coder.compress(np.ascontiguousarray(gaps[:, 0]).tobytes()) + coder.flush()
    return b"g" + len(high).to_bytes(4, "little") + high + low


def _restored(data: bytes) -> np.ndarray:
    if data[:1] == b"b":
        return np.frombuffer(zlib.decompress(data[1:]), np.uint8)
    cut = 5 + int.from_bytes(data[1:5], "little")
    low = np.frombuffer(zlib.decompress(data[cut:]), np.uint8)
    gaps = np.zeros((len(low), 4), np.uint8)
    gaps[:, 0] = low
    gaps[:, 1:] = np.frombuffer(zlib.decompress(data[5:cut]), np.uint8).reshape(3, -1).T
    flags = np.zeros(_BLOCK, np.uint8)
    flags[np.cumsum(gaps.view("<u4").ravel())] = 1
    return np.packbits(flags, bitorder="little")


def _merged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the sketches of a block and keeps which counters passed one.

    A task holds its own blocks only, 256 KiB each, however many parts sent one.
    """
    _held_bitmaps.clear()
    blocks: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for k in range(len(batch)):
            block, *parts = (column[k].as_py() for column in batch.columns)
            once, more = map(_restored, parts)
            if block in blocks:
                had = blocks[block]
                blocks[block] = [had[0] | once, had[1] | more | (had[0] & once)]
            else:
                blocks[block] = [once, more]
    for block, (_, more) in blocks.items():
        if more.any():
            places = np.flatnonzero(np.unpackbits(more, bitorder="little"))
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int32()), pa.array([_coded(places)], pa.binary())], ["block", "more"]
            )
    blocks.clear()
    give_back_memory()


def repeated_slots(docs: DataFrame, max_slots: int = MAX_SLOTS) -> tuple[int, list[tuple[int, bytes]]]:
    """The merged sketch: its width, and by block which counters more than one document reached."""
    size = docs.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    slots = math.ceil(min(size * _SLOTS_PER_BYTE, max_slots) / _BLOCK) * _BLOCK
    slots = max(_BLOCK, slots)
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    merged = (
        docs.select("text")
        .mapInArrow(_sketches(slots), "block int, once binary, more binary")
        .repartition(min(tasks, SKETCH_ROWS * (slots // _BLOCK)), "block")
        .mapInArrow(_merged, "block int, more binary")
    )
    return slots, [(r["block"], bytes(r["more"])) for r in merged.collect()]


def _bitmaps(slots: int, merged: list[tuple[int, bytes]]) -> np.ndarray:
    """The merged sketch as bits."""
    bits = np.zeros((SKETCH_ROWS, slots >> 3), np.uint8)
    step = _BLOCK >> 3
    for block, more in merged:
        row, k = divmod(block, slots // _BLOCK)
        bits[row, k * step : (k + 1) * step] = _restored(more)
    return bits


#: The bitmaps of the last sketch a worker process has seen: its tasks, one after the other, share them.
_held_bitmaps: dict[str, np.ndarray] = {}


def _worker_bitmaps(name: str, slots: int, shared: Broadcast) -> np.ndarray:
    if name not in _held_bitmaps:
        _held_bitmaps.clear()
        _held_bitmaps[name] = _bitmaps(slots, shared.value)
    return _held_bitmaps[name]


def _pack(positions: np.ndarray) -> bytes:
    return positions.astype("<i4").tobytes()


def _flagged(name: str, slots: int, shared: Broadcast):
    """Windows whose counters all passed one.

    Of the windows that a task compares, one document for each goes on: the one with the smallest id.
    In documents with larger ids the window is known to be repeated already; these positions are
    put out as ``gone``.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        passed = _worker_bitmaps(name, slots, shared)

        def flush() -> Iterator[pa.RecordBatch]:
            hi, lo, ids, marks, pos = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            order = np.lexsort((ids, lo, hi))
            hi, lo, ids, marks, pos = (x[order] for x in (hi, lo, ids, marks, pos))
            first = np.ones(len(hi), bool)
            first[1:] = (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])
            smallest = ids[first][np.cumsum(first) - 1] if len(ids) else ids
            stays = ids == smallest
            gone = np.flatnonzero(~stays)
            gone = gone[np.lexsort((pos[gone], marks[gone], ids[gone]))]
            kept = np.flatnonzero(stays)
            kept = kept[np.lexsort((pos[kept], marks[kept], ids[kept]))]
            if len(kept):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(hi[kept].view(np.int64)),
                        pa.array(lo[kept].view(np.int32)),
                        pa.array(ids[kept]),
                        pa.array(marks[kept]),
                        pa.array(pos[kept].astype(np.int32)),
                        pa.nulls(len(kept), pa.binary()),
                    ],
                    names,
                )
            if len(gone):
                cut = np.flatnonzero(
                    np.r_[True, (ids[gone][1:] != ids[gone][:-1]) | (marks[gone][1:] != marks[gone][:-1])]
                )
                packs = [_pack(x) for x in np.split(pos[gone], cut[1:])]
                heads = gone[cut]
                yield pa.RecordBatch.from_arrays(
                    [
                        # any value that spreads: these rows stand for themselves
                        pa.array(marks[heads] ^ ids[heads]),
                        pa.nulls(len(heads), pa.int32()),
                        pa.array(ids[heads]),
                        pa.array(marks[heads]),
                        pa.nulls(len(heads), pa.int32()),
                        pa.array(packs, pa.binary()),
                    ],
                    names,
                )
            del hi, lo, ids, marks, pos
            give_back_memory()

        names = [part.split()[0] for part in _FLAGGED.split(", ")]
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            for start, end, group in column_groups(batch.column("text").cast(pa.binary())):
                runs = WordRuns(group)
                begins = runs.windows(WINDOW)
                hashes = runs.hashes(WINDOW)[begins]
                keep = np.ones(len(begins), bool)
                for row in range(SKETCH_ROWS):
                    slot = _slots(hashes, row, slots)
                    keep &= passed[row, slot >> 3] >> (slot & 7).astype(np.uint8) & 1 > 0
                begins = begins[keep]
                if not len(begins):
                    continue
                of = runs.of[begins]
                marks = np.fromiter(
                    (xxhash.xxh64_intdigest(t or b"", _SEED) for t in group), np.uint64, len(group)
                )
                held.append(
                    (
                        hashes[keep],
                        (runs.hashes(WINDOW, MULTIPLIERS[1])[begins] >> np.uint64(32)).astype(np.uint32),
                        ids[start:end][of],
                        marks.view(np.int64)[of],
                        begins - runs.starts[of],
                    )
                )
                size += len(begins)
                if size > _COMPARED:
                    yield from flush()
                    size = 0
        if held:
            yield from flush()

    return run


def repeated_windows(docs: DataFrame, max_slots: int = MAX_SLOTS) -> DataFrame:
    """Windows to remove: (doc_id, mark, spans), with spans of words packed in order.

    ``docs`` has doc_id and text. ``mark`` is the text's XXH64 and tells rows apart that repeat
    an id with another text.
    """
    spark = docs.sparkSession
    docs = docs.filter("doc_id IS NOT NULL AND text IS NOT NULL")
    slots, blocks = repeated_slots(docs, max_slots)
    shared = spark.sparkContext.broadcast(blocks)
    flagged = docs.mapInArrow(_flagged(uuid.uuid4().hex, slots, shared), _FLAGGED)
    first = F.min("doc_id").over(Window.partitionBy("hi", "lo"))
    late = flagged.withColumn("first", first).filter("gone IS NOT NULL OR first < doc_id")
    places = late.groupBy("doc_id", "mark").agg(
        F.collect_list("pos").alias("single"), F.collect_list("gone").alias("many")
    )
    return places.mapInArrow(_spans, "doc_id bigint, mark bigint, spans binary")


def _spans(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Window places of a document as spans of words, [start, end) in turn."""
    _held_bitmaps.clear()
    give_back_memory()
    for batch in batches:
        spans = []
        columns = (batch.column(k).to_pylist() for k in ("single", "many"))
        for single, many in zip(*columns, strict=True):
            at = np.unique(np.concatenate([np.asarray(single, "<i4"), *(np.frombuffer(x, "<i4") for x in many)]))
            cut = np.flatnonzero(np.diff(at) > WINDOW)
            both = np.stack([at[np.r_[0, cut + 1]], at[np.r_[cut, len(at) - 1]] + WINDOW], axis=1)
            spans.append(both.astype("<i4").tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("mark"), pa.array(spans, pa.binary())],
            ["doc_id", "mark", "spans"],
        )


def _without(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words kept of each text: their count before, the count removed, and the text that stays."""
    _held_bitmaps.clear()
    give_back_memory()
    for batch in batches:
        n_words, n_removed, kept = [], [], []
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        for text, packed_spans in zip(texts, batch.column("spans").to_pylist(), strict=True):
            words = words_of(text)
            n_words.append(len(words))
            if packed_spans:
                parts, at = [], 0
                for start, end in np.frombuffer(packed_spans, "<i4").reshape(-1, 2).tolist():
                    parts += words[at:start]
                    at = end
                words = parts + words[at:]
            n_removed.append(n_words[-1] - len(words))
            kept.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(n_words, pa.int64()),
                pa.array(n_removed, pa.int64()),
                pa.array(kept, pa.binary()).cast(pa.string()),
            ],
            ["doc_id", "n_words", "n_removed", "kept"],
        )
    give_back_memory()


def remove_repeats(docs: DataFrame, max_slots: int = MAX_SLOTS) -> DataFrame:
    """Every row without the words that an earlier document has: (doc_id, n_words, n_removed, kept).

    A window is 13 consecutive words between ASCII white space. A word goes if a window that covers
    it also begins in a document with a smaller doc_id; the first document keeps its words. Windows
    are told by 96 bits of two hashes with different multipliers over the same 64-bit word values, so
    that two windows are taken for one if their words' values agree: about n² / 2^65 pairs of n words. Null and empty texts have no words. A null
    doc_id is neither smaller nor larger than any other, so such rows stay whole. Rows that repeat
    an id never remove words of each other.

    First pass: partition sketches count, for hash slots, the documents that reach them; merged,
    they overestimate how many documents a window is in, so no repeated window is lost. Second
    pass: only windows estimated repeated are grouped, after each task has reduced its own to one
    document each; a window in very many documents is then one row from each task.
    """
    ship_package(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    late = staged(repeated_windows(docs, max_slots), "repeats")
    size = late.agg(F.sum(24 + F.octet_length("spans"))).head()[0]
    late = late.withColumnRenamed("doc_id", "late_id")
    if (size or 0) <= BROADCAST_BYTES:
        late = F.broadcast(late)
    found = docs.join(
        late, (F.col("doc_id") == F.col("late_id")) & (F.xxhash64("text") == F.col("mark")), "left"
    )
    return found.select("doc_id", "text", "spans").mapInArrow(
        _without, "doc_id bigint, n_words bigint, n_removed bigint, kept string"
    )


def digest(kept: DataFrame) -> DataFrame:
    return kept.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )

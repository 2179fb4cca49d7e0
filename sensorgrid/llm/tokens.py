"""Exact token counts of whole texts, huge ones by overlapping chunks."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorgrid.session import ship_package

#: Texts of more characters than this are encoded in chunks of this size.
CHUNK_CHARS = 1 << 16
OVERLAP_CHARS = 1 << 9
TOKEN_LIMIT = 2048
_REMEMBERED = 400_000
_SPACE = re.compile(r"[\t-\r ]")

Encode = Callable[[str], tuple[np.ndarray, np.ndarray]]


def spliced_count(
    text: str, encode: Encode, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS
) -> int:
    """Tokens of ``text``, encoded in chunks that overlap.

    ``encode`` gives the ids and the starts of the tokens of a text. It must split at ASCII white
    space before anything else, so that what follows white space is encoded alike whatever stands
    before it. Two neighbours are spliced right after white space in their overlap, where both
    have a token that begins there and agree on all tokens from there to the last white space of
    the overlap. Where there is no such place the overlap is doubled, and then the chunk, so that
    the characters encoded stay in proportion to the text, with white space or without.
    """
    total, begin, n = 0, 0, len(text)
    ids, starts = encode(text[:chunk])
    end = min(chunk, n)
    while end < n:
        width = overlap
        while True:
            lo = max(begin, end - width)
            if _two_gaps(text, lo, end):
                nxt_end = min(n, lo + max(chunk, 2 * width))
                nxt_ids, nxt_starts = encode(text[lo:nxt_end])
                nxt_starts = nxt_starts + lo
                at = _common(text, lo, end, (ids, starts), (nxt_ids, nxt_starts))
                if at is not None:
                    break
            if lo == begin:  # nothing in the chunk can be told apart: take it anew, and twice as long
                at, nxt_end = begin, min(n, end + max(chunk, end - begin))
                nxt_ids, nxt_starts = encode(text[begin:nxt_end])
                nxt_starts = nxt_starts + begin
                break
            width *= 2
        total += int(np.searchsorted(starts, at) - np.searchsorted(starts, begin))
        ids, starts, begin, end = nxt_ids, nxt_starts, at, nxt_end
    return total + int(len(starts) - np.searchsorted(starts, begin))


def _two_gaps(text: str, lo: int, end: int) -> bool:
    first = _SPACE.search(text, lo, end)
    return first is not None and _SPACE.search(text, first.end(), end) is not None


def _common(text, lo, end, left, right) -> int | None:
    """The first place between ``lo`` and ``end`` where both encodings may be spliced."""
    gaps = [m.end() for m in _SPACE.finditer(text, lo, end)]
    if len(gaps) < 2:
        return None
    stop = gaps[-1]
    for at in gaps[:-1]:
        parts = []
        for ids, starts in (left, right):
            a, b = np.searchsorted(starts, [at, stop])
            parts.append((ids[a:b], starts[a:b]))
        (ids_l, starts_l), (ids_r, starts_r) = parts
        if len(ids_l) and len(ids_l) == len(ids_r) and starts_l[0] == starts_r[0] == at:
            same = (ids_l == ids_r).all() and (starts_l == starts_r).all()
            return at if same else None
    return None


class Counter:
    """Counts tokens; words between ASCII white space are remembered, up to a bound.

    The tokenizer parts words at white space before it looks at anything else, and no step before
    (composing characters, lower case, special strings) reaches over ASCII white space.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[bytes, int] = {}

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        found = self.tokenizer.encode(text, add_special_tokens=False)
        starts = np.fromiter((a for a, _ in found.offsets), np.int64, len(found.ids))
        return np.asarray(found.ids, np.int64), starts

    def learn(self, words: list[bytes]) -> None:
        texts = [w.decode("utf-8", "replace") for w in words]
        bounds = np.cumsum([0] + [len(t) + 1 for t in texts])
        _, starts = self.encode(" ".join(texts))
        counts = np.bincount(np.searchsorted(bounds, starts, "right") - 1, minlength=len(texts))
        self.known.update(zip(words, counts.tolist(), strict=True))

    def count(self, text: bytes) -> int:
        if len(text) > CHUNK_CHARS:
            whole = text.decode("utf-8", "replace")
            if len(whole) > CHUNK_CHARS:
                return spliced_count(whole, self.encode)
        words = text.split()
        if len(self.known) > _REMEMBERED:
            self.known.clear()
        new = list(set(words).difference(self.known))
        if new:
            self.learn(new)
        return sum(map(self.known.__getitem__, words)) if words else 0


_counters: dict[str, Counter] = {}


def _count_with(path: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _counters:
            _counters[path] = Counter(path)
        count = _counters[path].count
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            sizes, counts = [], []
            for value in texts:
                text = value.as_py() or b""
                sizes.append(len(text))
                counts.append(count(text))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    return run


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = TOKEN_LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row.

    ``tokenizer_path`` names a ``tokenizers`` file that every machine has, whose first split is at
    white space. No special tokens are added, nothing is cut or padded, and special strings in
    texts are taken as the library does. Null and empty texts have 0 bytes and tokens. Rows that
    repeat come back each.
    """
    ship_package(docs.sparkSession)
    counted = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        _count_with(tokenizer_path), "doc_id bigint, n_bytes bigint, n_tokens bigint"
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)

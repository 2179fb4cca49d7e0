"""Words of texts as numbers, and hashes of runs of words, for whole groups of texts at once."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Odd multipliers of independent polynomial hashes; fixed values.
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_BYTE_MULTIPLIER = np.uint64(0xD6E8FEB86659FD93)
#: Texts are handled together up to so many bytes; a longer one is handled alone.
GROUP_BYTES = 1 << 20
#: Bytes whose words are hashed in one step.
_STEP_BYTES = 1 << 20


def text_groups(texts: Sequence[bytes | None]) -> Iterator[tuple[int, int]]:
    """Ranges [start, end) of texts of about ``GROUP_BYTES`` together."""
    return size_groups([len(t) if t else 0 for t in texts])


def size_groups(sizes: Sequence[int]) -> Iterator[tuple[int, int]]:
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > GROUP_BYTES:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def column_groups(column: pa.Array) -> Iterator[tuple[int, int, list]]:
    """Texts of a column in such groups, each made only when it is its turn."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    for start, end in size_groups(sizes):
        yield start, end, column.slice(start, end - start).to_pylist()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


#: A random number for each byte.
_OF_BYTE = _mixed((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(MULTIPLIERS[0]))

#: ASCII white space parts words: space, and tab to carriage return. Other bytes stand for themselves.
WHITE_SPACE = bytes(0x20 if c == 0x20 or 0x09 <= c <= 0x0D else c for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """Words between ASCII white space."""
    return text.split() if text else []


class WordRuns:
    """The words of some texts in one row, with where each text begins.

    ``table`` maps the 256 bytes, to a space those that part words. ``values`` has a hash of each
    word's bytes, ``starts`` the position of the first word of each text and, at its end, the number
    of words; ``of`` is the text of each word.
    """

    def __init__(self, texts: Sequence[bytes | None], table: bytes = WHITE_SPACE):
        self.data = b" ".join([t or b"" for t in texts]).translate(table)
        raw = np.frombuffer(self.data, np.uint8)
        inside = np.zeros(len(raw) + 2, bool)
        inside[1:-1] = raw != 0x20
        turns = np.flatnonzero(inside[1:] != inside[:-1])
        self.begins, self.ends = turns[::2], turns[1::2]
        sizes = np.fromiter((len(t) + 1 if t else 1 for t in texts), np.int64, len(texts))
        after = np.concatenate([[0], np.cumsum(sizes)])
        self.starts = np.searchsorted(self.begins, after)
        self.of = np.repeat(np.arange(len(texts)), np.diff(self.starts))
        self.values = np.zeros(len(self.begins), np.uint64)
        first = 0
        while first < len(self.begins):
            last = int(np.searchsorted(self.begins, self.begins[first] + _STEP_BYTES))
            self._hash(raw, first, last)
            first = last

    def _hash(self, raw: np.ndarray, first: int, last: int) -> None:
        begins, sizes = self.begins[first:last], (self.ends - self.begins)[first:last]
        low, high = int(begins[0]), int(self.ends[last - 1])
        part = raw[low:high]
        powers = np.full(int(sizes.max()), _BYTE_MULTIPLIER)
        powers[0] = 1
        powers = np.multiply.accumulate(powers)
        # the place of each byte in its word; what parts words has no part in the sums
        where = np.arange(high - low) - np.repeat(begins - low, np.diff(np.append(begins, high)))
        sums = _OF_BYTE[part] * powers[np.minimum(where, len(powers) - 1)]
        sums[part == 0x20] = 0
        self.values[first:last] = _mixed(np.add.reduceat(sums, begins - low) + sizes.astype(np.uint64))

    def words(self, at: int, count: int) -> tuple[bytes, ...]:
        return tuple(self.data[self.begins[k] : self.ends[k]] for k in range(at, at + count))

    def windows(self, width: int) -> np.ndarray:
        """Where runs of ``width`` words begin that end in the same text."""
        last = np.repeat(self.starts[1:], np.diff(self.starts)) - width
        return np.flatnonzero(np.arange(len(self.values)) <= last)

    def hashes(self, width: int, multiplier: int = MULTIPLIERS[0]) -> np.ndarray:
        """A hash of the ``width`` words from each position on; only those of windows mean anything."""
        n, m = len(self.values), np.uint64(multiplier)
        out = np.zeros(n, np.uint64)
        if n < width:
            return out
        with np.errstate(over="ignore"):
            # Runs of doubling length, put together along the binary digits of the width.
            run, factor, done, rest, size = self.values, m, 0, width, 1
            while rest:
                if rest & 1:
                    here = run[done:]
                    out = out[: len(here)] * factor + here[: len(out)]
                    done += size
                rest >>= 1
                if rest:
                    run = run[: len(run) - size] * factor + run[size:]
                    factor, size = factor * factor, size * 2
            out = _mixed(out)
        return np.concatenate([out, np.zeros(n - len(out), np.uint64)])

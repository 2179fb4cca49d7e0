"""Words within one error of each other, by suffix ranks of a delimited vocabulary."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

_DELIMITER = 0
#: Searches that run side by side, and interval rows listed rather than tried symbol by symbol.
_SEARCHES, _LISTED = 1 << 11, 64
_SYMBOL = np.int64(32)


class SuffixRanks:
    """An FM-index over words of one-byte symbols, each followed by a delimiter.

    The words are stored backwards, so that a step of the usual backward search takes the next
    symbol of a pattern in reading order and ``[lo, hi)`` are the words that begin with what was
    read so far. ``steps`` holds every (symbol, row) of the transform in order: the place of
    (c, row) in it is at once the count of smaller symbols plus the rank of c before the row.
    """

    def __init__(self, words: Sequence[bytes]):
        self.size = len(words)
        text = np.frombuffer(b"".join(w[::-1] + b"\0" for w in words), np.uint8)
        ends = np.flatnonzero(text == _DELIMITER)
        suffixes = _sorted_suffixes(text, ends)
        before = text[suffixes - 1]  # what precedes the first word is the last delimiter
        self.before = before
        self.symbols = np.setdiff1d(before, [_DELIMITER])
        self.steps = np.sort((before.astype(np.int64) << _SYMBOL) | np.arange(len(text)))
        whole = suffixes[before == _DELIMITER]
        self.whole = np.searchsorted(ends, whole)

    def extend(self, symbols: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.steps, (symbols.astype(np.int64) << _SYMBOL) | rows)

    def words_at(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """The word that each interval spells in full, or -1."""
        first = np.searchsorted(self.steps[: self.size], lo)
        there = first < np.searchsorted(self.steps[: self.size], hi)
        return np.where(there, self.whole[np.minimum(first, self.size - 1)], -1)


def _sorted_suffixes(text: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Suffixes in order; delimiters are smaller than symbols, and differ by their place.

    Ranks by the first eight symbols, then by doubling. A suffix ends at its delimiter, so the
    rounds grow with the logarithm of the longest word.
    """
    n = len(text)
    end = ends[np.searchsorted(ends, np.arange(n))]
    key = np.zeros(n, np.uint64)
    for k in range(8):
        symbol = np.where(np.arange(n) + k <= end, text[np.minimum(np.arange(n) + k, n - 1)], 0)
        key = (key << np.uint64(8)) | symbol.astype(np.uint64)
    rank = np.unique(key, return_inverse=True)[1].astype(np.int64) + len(ends)
    rank[ends] = np.arange(len(ends))
    width = 8
    while True:
        after = rank[np.minimum(np.arange(n) + width, end)]
        key = rank * np.int64(n + len(ends)) + after
        order = np.argsort(key, kind="stable")
        new = np.r_[True, key[order][1:] != key[order][:-1]]
        if new.all():
            return order
        fresh = np.empty(n, np.int64)
        fresh[order] = np.cumsum(new) - 1
        # delimiters come first and keep their places
        rank, width = fresh, width * 2


def one_error(
    words: Sequence[bytes], asked: Sequence[bytes], exact: Sequence[int]
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (place in ``asked``, place in ``words``) of words that differ by one error.

    The first ``exact`` symbols of an asked word must be those of the word found; the rest may have
    one symbol inserted, deleted or replaced. ``words`` are distinct. No pair comes twice.
    """
    if not words:
        return
    index = SuffixRanks(words)
    for start in range(0, len(asked), _SEARCHES):
        part = slice(start, start + _SEARCHES)
        who, found = _search(index, asked[part], np.asarray(exact[part], np.int64))
        yield who + start, found


def _search(index: SuffixRanks, asked: Sequence[bytes], exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, asked), np.int64, len(asked))
    starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    flat = np.frombuffer(b"".join(asked) + b"\0", np.uint8)

    def exactly(who, at, lo, hi, until):
        """Read on without errors; returns those that come to ``until``."""
        done = []
        while True:
            ready = at == until[who]
            done.append((who[ready], at[ready], lo[ready], hi[ready]))
            who, at, lo, hi = (x[~ready] for x in (who, at, lo, hi))
            if not len(who):
                return [np.concatenate(x) for x in zip(*done, strict=True)]
            symbols = flat[starts[who] + at]
            lo, hi = index.extend(symbols, lo), index.extend(symbols, hi)
            some = lo < hi
            who, at, lo, hi = who[some], at[some] + 1, lo[some], hi[some]

    who = np.arange(len(asked))
    who, at, lo, hi = exactly(who, np.zeros_like(who), np.zeros_like(who), np.full_like(who, index.size), exact)
    wrong = []
    while len(who):
        inside = at < sizes[who]
        due = flat[starts[who] + np.where(inside, at, 0)]
        # a symbol of the asked word left out
        wrong.append((who[inside], at[inside] + 1, lo[inside], hi[inside]))
        # a symbol more, or another one
        of, symbol = _next_symbols(index, lo, hi)
        low, high = index.extend(symbol, lo[of]), index.extend(symbol, hi[of])
        some = low < high
        of, symbol, low, high = of[some], symbol[some], low[some], high[some]
        wrong.append((who[of], at[of], low, high))
        other = inside[of] & (symbol != due[of])
        wrong.append((who[of][other], at[of][other] + 1, low[other], high[other]))
        # the next symbol as it should be
        who, at, lo, hi, due = (x[inside] for x in (who, at, lo, hi, due))
        lo, hi = index.extend(due, lo), index.extend(due, hi)
        some = lo < hi
        who, at, lo, hi = who[some], at[some] + 1, lo[some], hi[some]
    if not wrong:
        return who, who
    who, _, lo, hi = exactly(*(np.concatenate(x) for x in zip(*wrong, strict=True)), sizes)
    word = index.words_at(lo, hi)
    pairs = np.unique(who[word >= 0] * np.int64(index.size) + word[word >= 0])
    return np.divmod(pairs, np.int64(index.size))


def _next_symbols(index: SuffixRanks, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(interval, symbol) for the symbols that may follow each interval: no more than the alphabet."""
    short = np.flatnonzero(hi - lo <= _LISTED)
    count = (hi - lo)[short]
    of = np.repeat(short, count)
    rows = np.repeat(lo[short] - np.concatenate([[0], np.cumsum(count)])[:-1], count) + np.arange(count.sum())
    both = np.unique((of << 8) | index.before[rows])
    of, symbol = both >> 8, both & 0xFF
    wide = np.flatnonzero(hi - lo > _LISTED)
    of = np.concatenate([of, np.repeat(wide, len(index.symbols))])
    symbol = np.concatenate([symbol, np.tile(index.symbols, len(wide))])
    return of[symbol != _DELIMITER], symbol[symbol != _DELIMITER]

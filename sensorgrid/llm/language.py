"""Language of texts by cross-parsing: how few phrases of a language's labelled text make a text up."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorgrid.llm.common import packed
from sensorgrid.llm.windows import column_groups
from sensorgrid.session import ship_package

#: Labelled symbols that a language's automaton is built from, and labelled rows they come from.
SYMBOLS = 40_000
ROWS = 400
#: States of all automata together at most; with more languages each gets fewer symbols.
ALL_SYMBOLS = 640_000
ALPHABET = 64
#: Symbols for letters that have none of their own, where labelled text has more letters than the
#: alphabet: eight by the part of Unicode that a letter is in, times four by the letter.
CLASSES = 32
#: Texts are parsed in segments of so many symbols; a phrase ends with its segment.
SEGMENT = 1024
UNKNOWN = "und"


def is_held_out(doc_id: str = "doc_id"):
    """Rows kept for tests: a remainder of 2 of the CRC-32 of the id's text by 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


@dataclass(frozen=True)
class LanguageModel:
    """Labelled text of each language as symbols, and which letter is which symbol.

    Symbol 0 is a gap (anything but letters); the next ``classes`` symbols are letters that are not
    in ``letters``, and the rest ``letters``.
    """

    letters: str
    samples: tuple[tuple[str, bytes], ...]
    classes: int = 1

    @property
    def alphabet(self) -> int:
        return 1 + self.classes + len(self.letters)

    def lookup(self) -> np.ndarray:
        table = np.zeros(0x110000, np.uint8)
        known = {c: k + 1 + self.classes for k, c in enumerate(self.letters)}
        for code in range(0x110000):
            c = chr(code)
            if c.isalpha():
                small = c.lower()[0]
                part, own = ord(small) >> 7, ord(small) * 0x9E3779B1 >> 16
                table[code] = known.get(small, 1 + (part % 8 * 4 + own % 4) % self.classes)
        return table


def fit(docs: DataFrame, rows: int = ROWS, symbols: int = SYMBOLS) -> LanguageModel:
    """Learn from ``text`` and non-null ``lang`` of rows that are not held out.

    Of a language with many rows, about ``rows`` are taken, by a hash of the id; a piece of each,
    from a place that the hash names, gives ``symbols`` symbols in all. Both bounds hold at every
    size, and the pieces are all that reaches the driver.
    """
    labelled = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    labelled = labelled.filter(~is_held_out()).filter("lang IS NOT NULL AND text IS NOT NULL")
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not counts:
        return LanguageModel("", ())
    symbols = min(symbols, ALL_SYMBOLS // len(counts))
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, rows / n))])
    piece = F.create_map(
        *[F.lit(x) for k, n in counts.items() for x in (k, math.ceil(4 * symbols / min(rows, n)))]
    )
    mark = F.xxhash64("doc_id", "lang")
    chosen = labelled.select(
        "lang", "doc_id", "text", mark.alias("mark"), share[F.col("lang")].alias("share"), piece[F.col("lang")].alias("size")
    ).filter(F.pmod("mark", F.lit(1 << 30)) < F.col("share") * (1 << 30))
    spare = F.greatest(F.lit(1), F.length("text") - F.col("size"))
    pieces = chosen.select(
        "lang", "mark", F.substring("text", F.pmod(F.shiftright("mark", 30), spare).cast("int") + 1, F.col("size")).alias("text")
    )
    texts: dict[str, list[tuple[int, str]]] = {}
    for r in pieces.toLocalIterator():
        texts.setdefault(r["lang"], []).append((r["mark"], r["text"]))
    letters: Counter = Counter()
    for found in texts.values():
        for _, text in found:
            letters.update(c for c in text.lower() if c.isalpha())
    classes = 1 if len(letters) <= ALPHABET - 2 else CLASSES
    own = sorted(letters.items(), key=lambda x: (-x[1], x[0]))[: ALPHABET - 1 - classes]
    model = LanguageModel("".join(c for c, _ in own), (), classes)
    table, samples = model.lookup(), []
    for lang, found in sorted(texts.items()):
        codes = [_gapped(table[_codes(text)]) for _, text in sorted(found)]
        # short pieces of many rows rather than long ones of few
        size = max(1, math.ceil(symbols / len(codes)))
        parts, k = [], 0
        while sum(map(len, parts)) < symbols and any(len(c) > k * size for c in codes):
            parts += [c[k * size : (k + 1) * size] for c in codes]
            k += 1
        text = np.concatenate(parts)[:symbols]
        if (text > 0).any():
            samples.append((lang, text.tobytes()))
    return LanguageModel(model.letters, tuple(samples), classes)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _gapped(symbols: np.ndarray) -> np.ndarray:
    """Runs of gaps as one."""
    keep = np.ones(len(symbols), bool)
    keep[1:] = (symbols[1:] != 0) | (symbols[:-1] != 0)
    return symbols[keep]


def automaton(text: bytes, alphabet: int) -> np.ndarray:
    """Transitions of the suffix automaton of ``text``: a row a state, -1 where there is none."""
    steps = np.full((2 * len(text) + 2, alphabet), -1, np.int32)
    link, length = [-1], [0]
    last = 0
    for symbol in text:
        new = len(link)
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and steps[p, symbol] < 0:
            steps[p, symbol] = new
            p = link[p]
        if p >= 0:
            q = int(steps[p, symbol])
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(link)
                link.append(link[q])
                length.append(length[p] + 1)
                steps[copy] = steps[q]
                while p >= 0 and steps[p, symbol] == q:
                    steps[p, symbol] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return steps[: len(link)]


class CrossParser:
    """All languages' automata in one table: from a state and a symbol to the next state.

    An entry is four times the place of the next state's row, plus the phrases that end by it.
    """

    def __init__(self, model: LanguageModel):
        self.lookup = model.lookup()
        self.langs = [lang for lang, _ in model.samples]
        width, tables, self.roots, at = model.alphabet, [], [], 0
        for _, text in model.samples:
            steps = automaton(text, width)
            root, states = steps[0], np.arange(len(steps))
            fall = np.where(root >= 0, root, 0)
            ends = np.where(root >= 0, 1, 2) - (states[:, None] == 0) * 1
            ends = np.where(steps >= 0, 0, np.maximum(ends, 0) + 0 * steps)
            nxt = np.where(steps >= 0, steps, fall)
            tables.append(((nxt.astype(np.int64) + at) * width * 4 + ends).astype(np.int32))
            self.roots.append(at * width)
            at += len(steps)
        self.table = np.concatenate(tables).ravel() if tables else np.zeros(0, np.int32)
        self.logs = np.array([math.log2(max(2, len(text))) for _, text in model.samples])
        self.roots = np.array(self.roots, np.int32)

    def phrases(self, symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Phrases by language and segment."""
        sizes = ends - starts
        order = np.argsort(-sizes, kind="stable")
        sizes, starts = sizes[order], starts[order]
        longest = int(sizes[0]) if len(sizes) else 0
        grid = np.zeros((longest, len(sizes)), np.int32)
        steps = np.arange(longest)
        for lane, (start, size) in enumerate(zip(starts, sizes, strict=True)):
            grid[:size, lane] = symbols[start : start + size]
        active = np.searchsorted(-sizes, -steps, side="left")
        state = np.repeat(self.roots[:, None], len(sizes), axis=1)
        count = np.zeros(state.shape, np.int32)
        for k in range(longest):
            n = active[k]
            entry = self.table.take(state[:, :n] + grid[k, :n])
            count[:, :n] += entry & 3
            state[:, :n] = entry >> 2
        count += state != self.roots[:, None]
        out = np.empty_like(count)
        out[:, order] = count
        return out

    def languages(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        joined = [t or "" for t in texts]
        codes = self.lookup[_codes("\0".join(joined))] if joined else np.zeros(0, np.uint8)
        sizes = np.fromiter(map(len, joined), np.int64, len(joined))
        begins = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]) if joined else sizes
        keep = np.ones(len(codes), bool)
        keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
        before = np.concatenate([[0], np.cumsum(keep)])
        symbols = codes[keep]
        a, b = before[begins], before[begins + sizes]
        letters = np.concatenate([[0], np.cumsum(codes > 0)])
        has = letters[begins + sizes] > letters[begins]
        starts, of = [], []
        for k in np.flatnonzero(has):
            cut = np.arange(a[k], b[k], SEGMENT)
            starts.append(cut)
            of.append(np.full(len(cut), k))
        langs, scores = [UNKNOWN] * len(joined), [0.0] * len(joined)
        if not starts or not self.langs:
            return langs, scores
        starts, of = np.concatenate(starts), np.concatenate(of)
        found = self.phrases(symbols, starts, np.minimum(starts + SEGMENT, b[of]))
        cost = np.zeros((len(self.langs), len(joined)))
        for k in range(len(self.langs)):
            cost[k] = np.bincount(of, found[k], len(joined)) * self.logs[k]
        best = cost.argmin(axis=0)
        ranked = np.sort(cost, axis=0)
        for k in np.flatnonzero(has):
            langs[k] = self.langs[best[k]]
            scores[k] = float(1 - ranked[0, k] / ranked[1, k]) if len(ranked) > 1 else 1.0
        return langs, scores


_parsers: dict[LanguageModel, CrossParser] = {}


def _identify(model: LanguageModel):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if model not in _parsers:
            _parsers.clear()
            _parsers[model] = CrossParser(model)
        for batch in batches:
            for start, end, texts in column_groups(batch.column("text")):
                langs, scores = _parsers[model].languages(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(start, end - start), pa.array(langs), pa.array(scores, pa.float64())],
                    ["row", "lang_pred", "score"],
                )

    return run


def identify(rows: DataFrame, model: LanguageModel) -> DataFrame:
    """(row, lang_pred, score) for rows of (row, text), from the text alone.

    Letters are lower-cased, anything else between them is one gap. A language's automaton gives,
    from each place on, the longest match with its labelled text; the matches in turn are the
    phrases. Their number times the binary logarithm of the labelled text's length is a language's
    cost. The smallest wins, the first by name if equal. ``score`` is one minus the quotient of the
    smallest and the second cost: 0 for a tie, and 1 if only one language is known. A null text
    and one without letters is ``und`` with score 0, and so is every text if nothing was learned.
    """
    ship_package(rows.sparkSession)
    schema = T.StructType([rows.schema["row"]]).add("lang_pred", "string").add("score", "double")
    rows = rows.select("row", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_identify(model), schema)


def language_report(docs: DataFrame, model: LanguageModel | None = None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row."""
    model = model or fit(docs)
    found = identify(packed(docs.select("doc_id", "text"), "text"), model)
    found = found.select(F.col("row.doc_id").alias("doc_id"), "lang_pred", "score")
    return found.select("doc_id", is_held_out().alias("held_out"), "lang_pred", "score")


def keep_known(docs: DataFrame, model: LanguageModel | None = None) -> DataFrame:
    """``docs`` without rows whose language can't be told."""
    found = identify(packed(docs, "text"), model or fit(docs))
    return found.filter(F.col("lang_pred") != UNKNOWN).select("row.*")

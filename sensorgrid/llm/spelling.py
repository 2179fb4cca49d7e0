"""Spelling variants: words one error apart, and the common form that each leads to."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorgrid.llm.common import LOWER, UPPER, staged
from sensorgrid.llm.fm_index import one_error
from sensorgrid.session import remove_path, ship_package, work_path

LETTERS = r"A-Za-zÀ-ÿ"
MIN_CHARS, MIN_COUNT = 5, 3
#: A form is at least so many times as frequent as its variant.
TIMES = 2
#: One in so many runs loses a code point, by a hash of its document and itself.
DAMAGED = 97
#: Entries of a cell, on either side. Larger groups of words with the same half are cut into cells.
CELL = 1 << 13


def word_counts(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the runs of letters, A-Z lower-cased and some damaged, that are long and frequent enough.

    A run is damaged if its crc32 behind that of its document's id tells so; rows without an id
    damage nothing. Counts combine before the shuffle.
    """
    lowered = F.translate(F.col("text").cast("string"), UPPER, LOWER)
    runs = docs.select(
        F.col("doc_id").cast("bigint").cast("string").alias("id"),
        F.explode(F.regexp_extract_all(lowered, F.lit(f"[{LETTERS}]{{{min_chars},}}"), F.lit(0))).alias("run"),
    )
    hashed = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    left = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = hashed.select(F.when(F.col("h") % DAMAGED == 0, left).otherwise(F.col("run")).alias("word"))
    counted = words.filter(F.length("word") >= min_chars).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= min_count)


def _entry(side: int, half: Column, own: Column) -> Column:
    return F.struct(F.lit(side).alias("side"), half.alias("half"), own.alias("own"))


def _halves(words: DataFrame) -> DataFrame:
    """(word, n, side, half, own): what a word may share with a word one error away.

    One error leaves the left half of a word as it is, floor(L / 2) symbols, or the right half,
    the other symbols. The other word is one longer or shorter at most, so it is entered by the two
    lengths that halves of such words can have; ``own`` marks the half the word asks by itself.
    """
    size = F.length("word")
    entries = []
    for side, of in ((0, F.floor), (1, F.ceil)):
        for longer in (False, True):
            # the two different halves of the lengths L - 1, L, L + 1
            least = of((size - 1) / 2).cast("int")
            half = least + 1 if longer else least
            text = F.left(F.col("word"), half) if side == 0 else F.right(F.col("word"), half)
            entries.append(_entry(side, text, half == of(size / 2).cast("int")))
    return words.select("word", "n", F.inline(F.array(*entries)))


def _cells(words: DataFrame, total: int) -> DataFrame:
    """(cell, tile, word, n, side, size, listed, asks): words dealt so that those that share a half meet.

    Cells are hashes of halves, about ``CELL`` entries each. A half with more words than that is cut
    into parts, and each pair of parts is a cell: its words are listed in one and asked in the other.
    """
    halves = _halves(words)
    large = halves.groupBy("side", "half").agg(F.count("*").alias("held")).filter(F.col("held") > CELL)
    large = large.select("side", "half", F.ceil(F.col("held") / CELL).cast("int").alias("parts"))
    # at most four entries a word, so no more large halves than words / (CELL / 4)
    dealt = halves.join(F.broadcast(large), ["side", "half"], "left")
    parts = F.coalesce("parts", F.lit(1))
    part = F.pmod(F.xxhash64("word"), parts).cast("int")
    spread = dealt.select(
        "word", "n", "side", "half", "own", part.alias("part"), parts.alias("parts"),
        F.explode(F.sequence(F.lit(0), parts - 1)).alias("other"),
    )
    same, own = F.col("part") == F.col("other"), F.col("own")

    def place(row: Column, column: Column, listed: Column | bool, asks: Column | bool) -> Column:
        values = {"i": row, "j": column, "listed": F.lit(listed), "asks": F.lit(asks)}
        return F.struct(*[v.alias(k) for k, v in values.items()])

    lists = place(F.col("part"), F.col("other"), True, False)
    asked = place(F.col("other"), F.col("part"), False, True)
    places = (
        F.when(same, F.array(place(F.col("part"), F.col("part"), True, own)))
        .when(own, F.array(lists, asked))
        .otherwise(F.array(lists))
    )
    placed = spread.select("word", "n", "side", "half", "parts", F.inline(places))
    cells = max(1, -(-4 * total // CELL))
    return placed.select(
        F.pmod(F.xxhash64("side", "half", "i", "j"), F.lit(cells)).alias("cell"),
        # parts of one half never share a cell, or pairs would be found twice
        F.when(F.col("parts") > 1, F.concat_ws(" ", "side", "i", "j", "half")).otherwise("").alias("tile"),
        "word", "n", "side", F.length("half").alias("size"), "listed", "asks",
    )


_NEAR = "word string, near bigint, best_n bigint, best string"


def _near(cell: pa.Table) -> pa.Table:
    """For each word that asks here: how many words are near it, and the most frequent of them."""
    names = [w.encode("latin-1") for w in cell.column("word").to_pylist()]
    counts = cell.column("n").to_numpy()
    sides, sizes = cell.column("side").to_numpy(), cell.column("size").to_numpy()
    listed = cell.column("listed").to_numpy()
    asks = cell.column("asks").to_numpy()
    out: list[tuple[str, int, int, str]] = []
    for side in (0, 1):
        turn = -1 if side else 1
        # a word may be entered by two halves that fall into one cell, or in several parts of it
        shown = {names[i]: counts[i] for i in np.flatnonzero(listed & (sides == side))}
        words = sorted(shown)
        held = np.fromiter((shown[w] for w in words), np.int64, len(words))
        asked = dict.fromkeys((names[i], int(sizes[i])) for i in np.flatnonzero(asks & (sides == side)))
        own = [w for w, _ in asked]
        best: dict[int, tuple[int, int, int]] = {}
        found = one_error([w[::turn] for w in words], [w[::turn] for w in own], [k for _, k in asked])
        for who, word in found:
            if side:  # pairs that share the left half as well were found by it
                new = [not words[v].startswith(own[w][: len(own[w]) // 2]) for w, v in zip(who, word, strict=True)]
                who, word = who[new], word[new]
            # words are in code-point order, so of equal counts the first is the smallest
            order = np.lexsort((word, -held[word], who))
            who, word = who[order], word[order]
            first = np.flatnonzero(np.r_[True, who[1:] != who[:-1]]) if len(who) else who
            total = np.diff(np.r_[first, len(who)])
            for w, v, many in zip(who[first], word[first], total, strict=True):
                best[w] = (many, held[v], v)
        out += [
            (own[w].decode("latin-1"), many, n, words[v].decode("latin-1")) for w, (many, n, v) in best.items()
        ]
    columns = list(zip(*out, strict=True)) or [()] * 4
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
    return pa.Table.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["word", "near", "best_n", "best"]
    )


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, best_n, best): words one error from another, their number, and the most frequent.

    ``words`` has distinct words of code points up to 255 and their counts n; ties go to the
    smallest word. Every half is searched in one place only, so no pair counts twice; pairs
    themselves never leave a task.
    """
    ship_package(words.sparkSession)
    parts = _cells(words, words.count()).groupBy("cell", "tile").applyInArrow(_near, _NEAR)
    first = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best"))).alias("first")
    return (
        parts.groupBy("word")
        .agg(F.sum("near").alias("near"), first)
        .select("word", "near", (-F.col("first.n")).alias("best_n"), F.col("first.best").alias("best"))
    )


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form. Counts at least double along forms, so paths are short
    and each round halves them; a round is a written table."""
    spark, path = forms.sparkSession, None
    current = forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved"))
    while True:
        written = work_path(spark, "roots")
        current.write.parquet(written)
        if path:
            remove_path(spark, path)
        path, table = written, spark.read.schema(current.schema).parquet(written)
        if table.filter("moved").isEmpty():
            return table.select("word", "root")
        up = table.select(F.col("word").alias("root"), F.col("root").alias("next"))
        current = table.select("word", "root").join(up, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        )


def spelling_variants(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """The words of all texts with their spelling: (word, form, root, n, n_near, form_n).

    Words are runs of letters, counted over all rows (``word_counts``); null and empty texts have
    none, and repeated rows count as often as they come. ``n_near`` counts the words one inserted,
    deleted or replaced code point away; ``form`` is the most frequent of them if it is at least
    twice as frequent, and ``root`` the last form. No words give an empty table.
    """
    words = staged(word_counts(docs, min_chars, min_count), "words")
    near = near_words(words)
    frequent = F.col("best_n") >= TIMES * F.col("n")
    known = staged(
        words.join(near, "word", "left").select(
            "word",
            F.when(frequent, F.col("best")).alias("form"),
            "n",
            F.coalesce("near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(frequent, F.col("best_n")).alias("form_n"),
        ),
        "variants",
    )
    roots = _roots(known.filter("form IS NOT NULL"))
    return known.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


_CRC_TABLE = "[list_reduce([CAST(k AS BIGINT)] || range(8), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) FOR k IN range(256)]"
_BYTES = "flatten([CASE WHEN c < 128 THEN [c] ELSE [192 + (c >> 6), 128 + (c & 63)] END FOR c IN [unicode(x) FOR x IN string_split(t, '')]])"

SQL = f"""WITH RECURSIVE
  low AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
      '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+') AS runs FROM documents),
  each AS (SELECT CAST(doc_id AS VARCHAR) AS id, run, count(*) AS many FROM low, unnest(runs) AS r(run)
    WHERE length(run) >= {MIN_CHARS} GROUP BY ALL),
  coded AS (SELECT run, many, {_BYTES} AS bytes FROM (SELECT run, many, id || ':' || run AS t FROM each)),
  steps AS (SELECT {_CRC_TABLE} AS steps),
  hashed AS (SELECT run, many, xor(4294967295, list_reduce([4294967295] || [CAST(b AS BIGINT) FOR b IN bytes],
      lambda c, b: xor(c >> 8, steps[1 + (xor(c, b) & 255)]))) AS h FROM coded, steps),
  words AS (SELECT word, CAST(sum(many) AS BIGINT) AS n FROM (SELECT many, CASE WHEN h % {DAMAGED} = 0
      THEN left(run, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2)
      ELSE run END AS word FROM hashed) WHERE length(word) >= {MIN_CHARS}
    GROUP BY word HAVING sum(many) >= {MIN_COUNT}),
  less AS (SELECT word, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM words,
      unnest(range(1, length(word) + 1)) AS r(i)),
  pairs AS (SELECT a.word, b.word AS other FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i
      WHERE a.word <> b.word
    UNION SELECT a.word, w.word FROM less a JOIN words w ON a.rest = w.word
    UNION SELECT w.word, a.word FROM less a JOIN words w ON a.rest = w.word),
  ranked AS (SELECT p.word, p.other, w.n AS other_n, count(*) OVER (PARTITION BY p.word) AS n_near,
      row_number() OVER (PARTITION BY p.word ORDER BY w.n DESC, p.other) AS k FROM pairs p JOIN words w ON w.word = p.other),
  forms AS (SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near,
      CASE WHEN r.other_n >= {TIMES} * w.n THEN r.other END AS form,
      CASE WHEN r.other_n >= {TIMES} * w.n THEN r.other_n END AS form_n
    FROM words w LEFT JOIN (SELECT * FROM ranked WHERE k = 1) r ON r.word = w.word),
  paths AS (SELECT word, word AS reach, 0 AS depth FROM forms
    UNION ALL SELECT p.word, f.form, p.depth + 1 FROM paths p JOIN forms f ON f.word = p.reach WHERE f.form IS NOT NULL),
  roots AS (SELECT word, arg_max(reach, depth) AS root FROM paths GROUP BY word)
  SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)"""

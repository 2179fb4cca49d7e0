"""Secrets in texts: candidates from a trigram index, then exact spans, all in DataFrame functions."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorgrid.llm.common import digest_of_spans, packed, staged
from sensorgrid.llm.trigrams import ANYTHING, trigram_query


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: Fixed patterns. A run of at least so many characters is the same as a run of any length, then
#: judged by its length: runs don't overlap, and no shorter one begins later in the same run.
BASE_RULES = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE_RULES + MORE_RULES

#: Candidate lists of so many rows at most (17 bytes each) are broadcast, longer ones shuffled.
BROADCAST_ROWS = 1_000_000
_BITS = 60
_PREFIX_BLOCK = 256


class TrigramIndex:
    """Postings of the trigrams that some rules ask for.

    A posting list is the rows of one trigram. They are kept as (doc_id, mark, gram), written to
    the shared folder; ``mark`` is the text's XXH64, so that rows with a repeated or null id and
    another text are told apart.
    """

    def __init__(self, docs: DataFrame, rules: tuple[Rule, ...] = RULES):
        self.queries = {r.kind: trigram_query(r.pattern) for r in rules}
        self.queries = {k: q for k, q in self.queries.items() if q != ANYTHING}
        self.grams = sorted({g for q in self.queries.values() for clause in q for g in clause})
        low = docs.select("doc_id", F.xxhash64("text").alias("mark"), F.lower("text").alias("low"))
        has = [F.when(F.contains(F.col("low"), F.lit(g)), F.lit(k)) for k, g in enumerate(self.grams)]
        found = F.array_compact(F.array(*has)) if has else F.array().cast("array<int>")
        self.postings = staged(low.select("doc_id", "mark", F.explode(found).alias("gram")), "postings")

    def candidates(self) -> DataFrame:
        """(doc_id, mark, kinds): texts whose postings meet the query of one of the rules.

        Posting lists are intersected as bits of a text, which combine before the shuffle.
        """
        words = range(0, max(1, len(self.grams)), _BITS)
        one = F.lit(1).cast("bigint")
        bits = [
            F.bit_or(
                F.when(
                    (F.col("gram") >= w) & (F.col("gram") < w + _BITS),
                    F.call_function("shiftleft", one, F.col("gram") - w),
                ).otherwise(0)
            ).alias(f"bits{w}")
            for w in words
        ]
        masks = self.postings.groupBy("doc_id", "mark").agg(*bits)

        def met(clause: frozenset[str]) -> Column:
            parts = []
            for w in words:
                want = sum(1 << (self.grams.index(g) - w) for g in clause if w <= self.grams.index(g) < w + _BITS)
                if want:
                    parts.append(F.col(f"bits{w}").bitwiseAND(F.lit(want).cast("bigint")) == want)
            return reduce(Column.__and__, parts)

        kinds = [
            F.when(reduce(Column.__or__, [met(c) for c in sorted(query, key=sorted)]), F.lit(kind))
            for kind, query in self.queries.items()
        ]
        found = F.array_compact(F.array(*kinds)) if kinds else F.array().cast("array<string>")
        return masks.select("doc_id", "mark", found.alias("kinds")).filter(F.size("kinds") > 0)


def _running(sizes: Column) -> Column:
    """The sum of all before, for each element; in blocks, so that long arrays take linear time."""
    nothing = F.array().cast("array<bigint>")

    def sums(values: Column, start: Column) -> Column:
        steps = F.aggregate(
            values,
            F.struct(start.alias("at"), nothing.alias("out")),
            lambda s, n: F.struct((s["at"] + n).alias("at"), F.array_append(s["out"], s["at"]).alias("out")),
        )
        return steps["out"]

    zero = F.lit(0).cast("bigint")
    last = F.floor((F.size(sizes) - 1) / _PREFIX_BLOCK).cast("int")
    blocks = F.transform(
        F.sequence(F.lit(0), last), lambda b: F.slice(sizes, b * _PREFIX_BLOCK + 1, F.lit(_PREFIX_BLOCK))
    )
    totals = F.transform(blocks, lambda b: F.aggregate(b, zero, lambda s, n: s + n))
    starts = sums(totals, zero)
    inner = F.zip_with(blocks, starts, lambda b, at: sums(b, at))
    return F.flatten(inner)


def _rule_spans(text: Column, rule: Rule, order: int) -> Column:
    """Kept matches of one rule as an array of (start, order, end, from_byte, to_byte).

    What stands between matches and the matches themselves take turns; their lengths give places.
    """
    pattern = F.lit(rule.pattern)
    between = F.split(text, rule.pattern, -1)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    judged = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else matches
    wide = lambda unit, values: F.transform(values, lambda x: unit(x).cast("bigint"))
    parts = F.arrays_zip(
        matches.alias("m"),
        judged.alias("g"),
        _starts(wide(F.length, between), wide(F.length, matches)).alias("start"),
        _starts(wide(F.octet_length, between), wide(F.octet_length, matches)).alias("byte"),
    )
    kept = F.filter(parts, lambda x: F.length(x["g"]) >= rule.least)
    return F.transform(
        kept,
        lambda x: F.struct(
            x["start"].alias("start"),
            F.lit(order).alias("order"),
            (x["start"] + F.length(x["m"])).alias("end"),
            x["byte"].alias("from_byte"),
            (x["byte"] + F.octet_length(x["m"])).alias("to_byte"),
        ),
    )


def _starts(between: Column, matches: Column) -> Column:
    """Where each match begins: what stands before it, and the matches and gaps before that."""
    gaps = F.slice(between, F.lit(1), F.size(matches))
    steps = F.zip_with(gaps, matches, lambda a, b: a + b)
    return F.zip_with(_running(steps), gaps, lambda at, gap: at + gap)


_SPANS = "array<struct<start:bigint,order:int,end:bigint,from_byte:bigint,to_byte:bigint>>"


def find_secrets(rows: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(row, text, found) for rows of (row, doc_id, text): all kept matches, by start, then rule.

    Matches of a rule are leftmost and don't overlap; those whose group is too short are dropped.
    Null and empty texts have none. Rows come back as often as they stand there, also with a
    null id. Rules with mandatory trigrams are tried on the index's candidates, others on all texts.
    """
    rows = rows.select("row", "doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    index = TrigramIndex(rows, rules)
    chosen = staged(index.candidates(), "candidates")
    if chosen.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        chosen = F.broadcast(chosen)
    chosen = chosen.select(F.col("doc_id").alias("of_id"), F.col("mark").alias("of_mark"), "kinds")
    same = F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.xxhash64("text") == F.col("of_mark"))
    found, none = rows.join(chosen, same, "left"), F.array().cast(_SPANS)
    spans = []
    for order, rule in enumerate(rules):
        tried = F.rlike("text", F.lit(rule.pattern))
        if rule.kind in index.queries:
            tried = F.array_contains(F.coalesce("kinds", F.array().cast("array<string>")), rule.kind) & tried
        spans.append(F.when(tried, _rule_spans(F.col("text"), rule, order).cast(_SPANS)).otherwise(none))
    return found.select("row", "text", F.array_sort(F.concat(*spans)).alias("found"))


def _named(spans: Column, rules: tuple[Rule, ...]) -> Column:
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.transform(spans, lambda s: F.concat_ws(":", kinds[s["order"]], s["start"], s["end"]))


def secret_report(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of every document."""
    rows = packed(docs.select("doc_id", "text"), "doc_id", "text")
    found = find_secrets(rows, rules).select("row", "found")
    base = F.filter("found", lambda s: s["order"] < len(BASE_RULES))
    count = lambda k: F.size(F.filter("found", lambda s: s["order"] == k)).cast("bigint")
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        *[count(k).alias(f"n_{r.kind}") for k, r in enumerate(BASE_RULES)],
        digest_of_spans(_named(base, rules)).alias("base_sha256"),
        F.array_join(_named(F.col("found"), rules), ",").alias("spans"),
    )


def masked(text: Column, spans: Column, mask: str = "[secret]") -> Column:
    """``text`` with each run of overlapping spans, given by start, replaced by ``mask``."""
    runs = F.aggregate(
        spans,
        F.array().cast("array<struct<a:bigint,b:bigint>>"),
        lambda out, s: F.when(
            (F.size(out) > 0) & (s["from_byte"] < F.element_at(out, -1)["b"]),
            F.array_append(
                F.slice(out, F.lit(1), F.size(out) - 1),
                F.struct(
                    F.element_at(out, -1)["a"].alias("a"),
                    F.greatest(F.element_at(out, -1)["b"], s["to_byte"]).alias("b"),
                ),
            ),
        ).otherwise(F.array_append(out, F.struct(s["from_byte"].alias("a"), s["to_byte"].alias("b")))),
    )
    raw = text.cast("binary")
    ends = F.concat(F.array(F.lit(0).cast("bigint")), F.transform(runs, lambda r: r["b"]))
    begins = F.concat(F.transform(runs, lambda r: r["a"]), F.array(F.octet_length(text).cast("bigint")))
    parts = F.zip_with(
        ends, begins, lambda a, b: F.substring(raw, (a + 1).cast("int"), (b - a).cast("int")).cast("string")
    )
    return F.array_join(parts, mask)


def mask_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with secrets masked and, where it is a column, ``n_chars`` counted anew.

    Texts without secrets, null ones among them, stay as they are.
    """
    found = find_secrets(packed(docs, "doc_id", "text"), rules)
    some = F.size("found") > 0
    text = F.when(some, masked(F.col("text"), F.col("found"))).otherwise(F.col("row.text"))
    row = found.select("row", text.alias("masked"), some.alias("some"))
    columns = []
    for name in docs.columns:
        if name == "text":
            columns.append(F.col("masked").alias(name))
        elif name == "n_chars":
            kind = docs.schema[name].dataType
            columns.append(
                F.when(F.col("some"), F.length("masked").cast(kind)).otherwise(F.col("row.n_chars")).alias(name)
            )
        else:
            columns.append(F.col("row")[name].alias(name))
    return row.select(*columns)

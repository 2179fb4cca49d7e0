"""Line removal, spelling variants and vector codes against plain versions and on odd rows."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from sensorgrid.llm import lines, spelling, vector_codes
from sensorgrid.llm.fm_index import one_error

_SPACE = " \t\n\x0b\f\r"


def _ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plain_lines(rows, min_docs):
    keys = [[_ascii_lower(x.strip(_SPACE)) for x in (t or "").split("\n")] for _, t in rows]
    holders = defaultdict(set)
    for (doc_id, _), own in zip(rows, keys, strict=True):
        for key in own:
            if doc_id is not None:
                holders[key].add(doc_id)
    out = []
    for (doc_id, text), own in zip(rows, keys, strict=True):
        kept = [x for x, k in zip((text or "").split("\n"), own, strict=True) if not k or len(holders[k]) < min_docs]
        out.append((doc_id, len(own), len(own) - len(kept), "\n".join(kept)))
    return Counter(out)


def one_apart(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_variants(counts):
    out = {}
    for word, n in counts.items():
        near = sorted((-counts[v], v) for v in counts if one_apart(word, v))
        form = near[0][1] if near and -near[0][0] >= 2 * n else None
        out[word] = (form, n, len(near), counts[form] if form else None)

    def root(word):
        return root(out[word][0]) if out[word][0] else word

    return {(w, f, root(w), n, k, m) for w, (f, n, k, m) in out.items()}


def test_lines_against_plain(spark, odd, texts_of):
    shared = ["A shared line ", "\tA SHARED LINE", "É own", "é own", ""]
    rows = [(k, "\n".join(shared[k % 3 : k % 3 + 2] + [f"line {k}", "twice", "twice"])) for k in range(12)]
    docs = odd.select("doc_id", "text").union(spark.createDataFrame(rows, "doc_id bigint, text string"))
    for min_docs in (2, 4, 10):
        got = lines.drop_common_lines(docs, min_docs=min_docs).collect()
        assert Counter(map(tuple, got)) == plain_lines(texts_of(docs), min_docs)


def test_lines_without_broadcast_and_when_long(spark, odd, texts_of, monkeypatch):
    monkeypatch.setattr(lines, "BROADCAST_BYTES", 0)
    long = [(k, "\n".join(["common"] * 20_000 + [f"own {i} of {k}" for i in range(3_000)])) for k in range(3)]
    docs = odd.select("doc_id", "text").union(spark.createDataFrame(long, "doc_id bigint, text string"))
    got = Counter(map(tuple, lines.drop_common_lines(docs, min_docs=3).collect()))
    assert got == plain_lines(texts_of(docs), 3)


def test_lines_keep_clashing_names_out_and_take_no_rows(odd):
    assert lines.digest(lines.drop_common_lines(odd)).columns == ["doc_id", "n_lines", "n_dropped", "kept_sha256"]
    assert lines.drop_common_lines(odd.limit(0)).count() == 0


def test_one_error_against_plain():
    rng = random.Random(5)
    for _ in range(12):
        words = sorted({bytes(rng.choice(b"ab\xe9") for _ in range(rng.randint(3, 8))) for _ in range(120)})
        got = []
        for who, found in one_error(words, words, [len(w) // 2 for w in words]):
            got += zip(who.tolist(), found.tolist(), strict=True)
        wanted = {
            (i, j)
            for i, a in enumerate(words)
            for j, b in enumerate(words)
            if one_apart(a, b) and b.startswith(a[: len(a) // 2])
        }
        assert len(got) == len(set(got)) and set(got) == wanted
    assert list(one_error([], [], [])) == []


@pytest.mark.parametrize("cell", [1 << 13, 40])
def test_variants_of_a_crowded_vocabulary(spark, monkeypatch, cell):
    """With tiny cells most halves are cut into parts, and pairs still count once."""
    monkeypatch.setattr(spelling, "CELL", cell)
    rng = random.Random(9)
    counts = Counter()
    for _ in range(700):
        counts["".join(rng.choice("abé") for _ in range(rng.randint(5, 7)))] += rng.randint(3, 40)
    words = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    near = {r["word"]: (r["near"], r["best_n"], r["best"]) for r in spelling.near_words(words).collect()}
    for word in counts:
        wanted = sorted((-counts[v], v) for v in counts if one_apart(word, v))
        assert near.get(word) == ((len(wanted), -wanted[0][0], wanted[0][1]) if wanted else None)


def test_variants_with_chains_ties_and_odd_rows(spark, odd, monkeypatch):
    monkeypatch.setattr(spelling, "DAMAGED", 1 << 40)  # only the crc 0 is damaged
    said = {"abcdefg": 40, "abcdefx": 20, "abcdexx": 10, "abcdxxx": 5, "zzzzz": 3, "zzzzy": 3, "naïve": 4, "naive": 9}
    text = " ".join(" ".join([w] * n) for w, n in said.items())
    docs = odd.union(odd.limit(1).withColumns({"doc_id": F.lit(99).cast("bigint"), "text": F.lit(text)}))
    got = {tuple(r) for r in spelling.spelling_variants(docs).collect()}
    counts = Counter()
    for r in docs.collect():
        run = ""
        for c in _ascii_lower(r["text"] or "") + " ":
            if c.isascii() and c.isalpha() or "À" <= c <= "ÿ":
                run += c
            else:
                counts.update([run] if len(run) >= 5 else [])
                run = ""
    assert got == plain_variants({w: n for w, n in counts.items() if n >= 3})
    assert ("abcdxxx", "abcdexx", "abcdefg", 5, 1, 10) in got and ("zzzzy", None, "zzzzy", 3, 1, None) in got
    assert spelling.spelling_variants(odd.limit(0)).count() == 0


def test_long_words_are_searched():
    word = b"x" * 5_000
    (pair,) = one_error([word, word[1:], b"y" + word], [word], [2_500])
    assert [x.tolist() for x in pair] == [[0], [1]]


def test_orchard_finds_the_nearest_with_ties():
    rng = np.random.default_rng(3)
    for count in (1, 2, 16, 40):
        entries = rng.integers(-6, 7, (count, 3))
        points = rng.integers(-8, 9, (3_000, 3))
        apart = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
        for start in (None, rng.integers(0, count, len(points))):
            best, near = vector_codes.Orchard(entries).nearest(points, start)
            assert (best == apart.argmin(axis=1)).all() and (near == apart.min(axis=1)).all()


def _vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")


def test_codes_of_odd_vectors(spark):
    rng = random.Random(1)
    good = [(k, [rng.uniform(-2, 2) for _ in range(16)], k % 3 or None) for k in range(40)]
    bad = [
        (-1, None, 1), (-2, [], 1), (-3, [0.0] * 15 + [None], 1), (-4, [float("nan")] * 16, 1),
        (-5, [float("inf")] * 16, 1), (50, [1.0] * 15, 1), (51, [1.0] * 24, 1),
    ]
    more = [(None, good[0][1], None), good[7], (60, [3e38] * 16, 2)]
    frame = _vectors(spark, good + bad + more).withColumns({c: F.lit("own") for c in ("code", "v", "of", "error")})
    got = vector_codes.compress_vectors(frame).collect()
    assert Counter(r["vec_id"] for r in got) == Counter([*range(40), None, 7, 60])
    errors = Counter()
    labels = {k: label for k, _, label in good + more}
    for r in got:
        errors[labels[r["vec_id"]]] += r["error"]
    assert all(r["label_error"] == errors[labels[r["vec_id"]]] for r in got)
    assert vector_codes.compress_vectors(_vectors(spark, bad[:5])).count() == 0
    few = vector_codes.compress_vectors(_vectors(spark, good[:3])).collect()
    assert {r["error"] for r in few} == {0} and len({r["code"] for r in few}) == 3


def test_codes_against_plain_rounds_and_decoded(spark):
    rng = random.Random(2)
    rows = [(k, [rng.gauss(0, 0.3) for _ in range(16)], 0) for k in range(300)]
    frame = _vectors(spark, rows)
    cut = np.floor(4096 * np.array([v for _, v, _ in rows], np.float32).astype(float)).astype(int).reshape(300, 8, 2)
    books = cut[:16].transpose(1, 0, 2).copy()
    for _ in range(6):
        for p in range(8):
            nearest = ((cut[:, p, None] - books[p][None]) ** 2).sum(axis=2).argmin(axis=1)
            for e in set(nearest.tolist()):
                books[p, e] = cut[nearest == e, p].sum(axis=0) // (nearest == e).sum()
    whole = vector_codes.whole_vectors(frame)
    learnt = vector_codes.learn_codebooks(whole)
    assert (learnt == books).all()
    codes = vector_codes.encode(whole, learnt)
    for r in vector_codes.decode(codes, learnt).collect():
        own = cut[r["vec_id"]].ravel()
        assert r["error"] == ((own - np.array(r["v"])) ** 2).sum()

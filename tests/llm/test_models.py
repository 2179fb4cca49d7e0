"""Fitted operators, archives, tokens, the mix, and the pipeline."""

import gzip
import math
import os
from collections import Counter

import duckdb
import numpy as np
import plain
import public_tokenizers
import pytest
from conftest import DATA
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from sensorgrid.llm import extraction, html_tree, language, mixing, quality, tokens, warc
from sensorgrid.llm.common import packed
from sensorgrid.llm.queries import QUERIES, SQL
from sensorgrid.session import work_path

PATH = str(public_tokenizers.path("word_bpe_49k.json"))


# language


def test_held_out_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language.language_report(docs).join(docs.select("doc_id", "lang"), "doc_id")
    held = found.filter("held_out").collect()
    assert len(held) > 200
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in held)


def greedy(text, learned):
    at = n = 0
    while at < len(text):
        end = at + 1
        while end <= len(text) and text[at:end] in learned:
            end += 1
        at, n = max(at + 1, end - 1), n + 1
    return n


def test_phrases_are_longest_matches():
    rng = np.random.default_rng(3)
    samples = [bytes(rng.integers(0, 5, 400).tolist()), bytes(rng.integers(1, 4, 300).tolist())]
    model = language.LanguageModel("abcd", (("x", samples[0]), ("y", samples[1])))
    parser = language.CrossParser(model)
    texts = [rng.integers(0, 6, n) for n in (1, 2, 50, 700)]
    ends = np.cumsum([len(t) for t in texts])
    starts = ends - [len(t) for t in texts]
    found = parser.phrases(np.concatenate(texts).astype(np.uint8), starts, ends)
    assert found.tolist() == [[greedy(bytes(t.tolist()), s) for t in texts] for s in samples]


def test_languages_of_odd_texts(spark, odd):
    model = language.LanguageModel("abc", (("x", b"\2\3\2\3"), ("y", b"\4\4\4")))
    docs = spark.createDataFrame(
        [(1, None), (2, ""), (3, "12 --"), (4, "ABAB" * 4000), (5, "ccc"), (5, "ccc"), (None, "ab"), (6, "π")],
        "doc_id bigint, text string",
    )
    rows = language.language_report(docs, model).collect()
    got = Counter((r.doc_id, r.lang_pred) for r in rows)
    want = [(1, "und"), (2, "und"), (3, "und"), (4, "x"), (5, "y"), (5, "y"), (None, "x"), (6, "y")]
    assert got == Counter(want)  # a letter that no language has: the shorter labelled text wins
    kept = language.keep_known(odd, model)
    assert kept.columns == odd.columns and kept.filter("doc_id IN (1, 2, 3, 10)").isEmpty()
    none = docs.limit(0).withColumn("lang", F.lit("x"))
    assert language.language_report(none).isEmpty()
    unlearned = language.language_report(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in unlearned.collect()} == {"und"}


# quality


def test_quality(spark, odd, documents):
    docs = documents.select("doc_id", "text").union(odd.select("doc_id", "text"))
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    rows = quality.quality_report(docs, labels).collect()
    got = Counter((r.doc_id, *r[1:6], r.base_failed) for r in rows)
    assert got == Counter((r.doc_id, *plain.quality(r.text)) for r in docs.collect())
    assert not any(r.kept for r in rows if r.base_failed)
    known = {r.doc_id: r.quality for r in labels.collect()}
    judged = [(r.kept, known[r.doc_id]) for r in rows if r.doc_id in known and not r.base_failed]
    assert sum(a == bool(b) for a, b in judged) / len(judged) > 0.95


def test_quality_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality.fit(docs.filter("doc_id % 2 = 0"), labels)
    rows = quality.quality_report(docs.filter("doc_id % 2 = 1"), labels, model).join(labels, "doc_id").collect()
    right = [(r.kept == bool(r.quality)) or (r.base_failed and r.quality) for r in rows]
    assert sum(right) / len(right) > 0.97


def test_quality_without_labels(spark, odd):
    labels = spark.createDataFrame([(1, None), (None, 1), (6, 1)], "doc_id bigint, quality int")
    rows = quality.quality_report(odd, labels).collect()
    assert all(r.kept != r.base_failed for r in rows)
    assert quality.quality_report(odd.limit(0), labels).isEmpty()


# pages


def test_pages_of_the_tables(spark):
    import html
    import re

    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    found = {r.page_id: r.text for r in extraction.main_texts(pages).collect()}
    for r in pages.collect():
        inside = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = re.sub(r"<[^>]+>", "", re.sub(r"</?(p|h1|br)[^>]*>", "\x01", inside)).split("\x01")
        texts = [" ".join(html.unescape(x).split()) for x in parts]
        assert found[r.page_id] == " ".join(x for x in texts if x)


WITHOUT_ARTICLE = """<body class="no-sidebar"><div class="topnav"><a href=x>Home</a> <a>About</a></div>
<div id="content"><h1>A title</h1><p>First <a href=y>linked</a> paragraph, with words
 enough to be a text.<ul><li>Item one of a list, long enough<li>Item two</ul><div class="ad">Buy now! Great deals.</div>
<p>Second&nbsp;paragraph &amp; more. It goes on.</div><div class="sidebar"><p>A long side paragraph, that has stops.</div>
<section class="comments"><div><p>Great post! I liked it a lot, really. Thank you, friend.</div></section>
<div class="cookie-notice"><p>We use cookies, as you know. Accept?</div><div hidden><p>A hidden text, that is long.</div>
<script>if (a < b) { x("</p>") }</script><footer><p>All rights reserved, by someone.</footer>"""


def test_pages_without_an_article(spark):
    model = extraction.fit(spark.read.parquet(f"{DATA}/pages.parquet"))
    want = (
        "A title First linked paragraph, with words enough to be a text. Item one of a list, long enough"
        " Item two Second paragraph & more. It goes on."
    )
    assert model.text(WITHOUT_ARTICLE) == want
    assert model.text(None) == model.text("") == model.text("<a b='<p>") == ""


def test_odd_pages(spark):
    pages = [(1, "u", None), (2, None, ""), (3, "u", "<p>" * 3000 + "deep, but well."), (3, "u", "<b>x<!-- y"), (None, "u", "<p>a, b.")]
    rows = extraction.main_texts(spark.createDataFrame(pages, "page_id bigint, url string, html string")).collect()
    assert len(rows) == 5 and all(r.n_chars == len(r.text) for r in rows)
    assert {r.text for r in rows if r.page_id in (1, 2)} == {""}
    assert extraction.main_texts(spark.createDataFrame([], "page_id bigint, url string, html string")).isEmpty()


def test_marginals_are_exact():
    """Against the sum over all labellings of a small tree."""
    from itertools import product

    model = extraction.TreeModel.of(Counter())
    page = html_tree.parse("<div><nav><p>Some text, here.</p></nav><p>Other text, there. More of it.</p><ul><li>x</ul></div>")
    values = [extraction.features(n) for n in page.nodes]
    marked, n = extraction.marks(page, values), len(page.nodes)
    sums = np.zeros((n, 2))
    for labels in product((0, 1), repeat=n):
        weight = math.prod(model.nodes[f][y] for found, y in zip(values, labels, strict=True) for f in found)
        for k in range(1, n):
            weight *= model.edges[marked[k], bool(labels[page.nodes[k].parent])][labels[k]]
        for k, y in enumerate(labels):
            sums[k, y] += weight
    assert np.allclose(model.marginals(page), sums[:, 1] / sums.sum(axis=1))


# archives

PAGES = [
    (3, "u\nx", ""),
    (2, None, None),
    (1, "a", "é\r\n\r\nx"),
    (1, "a", "é\r\n\r\nx"),
    (9, "b", "é\r\n\r\nx"),
    (None, "z", "q"),
    (4, "z", "q" * 300_000),
]


@pytest.mark.parametrize("size", [100, 1 << 30])
def test_archives(spark, size, counted):
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string, html string")
    written = warc.write_archives(pages, work_path(spark, "streams"), archive_bytes=size)
    new = warc.normalise(written, warc.revisits(written), work_path(spark, "members"))
    assert counted(warc.read_archives(new)) == plain.archived(PAGES)
    large = warc.revisits(written, least_bytes=1)
    assert large.count() == 2
    for row in new.collect():
        store, path = warc._open(row.archive)
        with open(path, "rb") as file:
            data = file.read()
        with open(f"{path}.idx") as index:
            assert len(gzip.decompress(data).split(b"WARC/1.1\r\n")) - 1 == len(index.readlines())


def test_round_trip(spark, counted):
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    rows = [tuple(r) for r in pages.select("page_id", "url", "html").collect()]
    assert counted(warc.round_trip(pages)) == plain.archived(rows)
    assert warc.round_trip(pages.limit(0)).isEmpty()


# tokens


def test_token_counts(odd, documents):
    whole = Tokenizer.from_file(PATH)
    docs = odd.select("doc_id", "text").union(documents.select("doc_id", "text"))
    got = Counter(tuple(r) for r in tokens.token_counts(docs, PATH).collect())
    want = Counter()
    for r in docs.collect():
        n = len(whole.encode(r.text or "", add_special_tokens=False).ids)
        want[r.doc_id, len((r.text or "").encode()), n, n > 2048] += 1
    assert got == want


@pytest.mark.parametrize("chunk, overlap", [(300, 10), (50, 3), (5, 1)])
def test_spliced_counts(chunk, overlap):
    counter, whole = tokens.Counter(PATH), Tokenizer.from_file(PATH)
    for text in (
        "",
        "   ",
        "a" * 900,
        "a" * 400 + " b" * 300,
        "x<|endoftext|>y " * 60,
        "é " * 200,
        " ́" * 150,
        "don't we'll 12 " * 50,
        "\n\t" * 90 + "é" * 50,
    ):
        n = len(whole.encode(text, add_special_tokens=False).ids)
        assert tokens.spliced_count(text, counter.encode, chunk, overlap) == n
        assert counter.count(text.encode()) == n


# the mix


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_match_sql(spark, name):
    db = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "embeddings"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    want = db.sql(SQL[name])
    got = QUERIES[name](spark, DATA)
    assert Counter(tuple(r) for r in got.select(*want.columns).collect()) == Counter(want.fetchall())
    assert set(got.columns) == set(want.columns)


def test_mix_to_weights(spark, odd):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") < 40, "a").when(F.col("id") < 3000, "b").alias("source")
    )
    mixed = mixing.mix(docs, weights={"a": 1, "b": 1, "c": 5})
    counts = {r.source: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert set(counts) == {"a", "b"}  # a weight for a source that isn't there is spread over the others
    ids = [r.shuffle_key for r in mixed.collect()]
    assert ids == sorted(ids)
    assert abs(counts["a"] - counts["b"]) < 0.2 * counts["a"]
    same = mixing.mix(docs.repartition(7), weights={"a": 1, "b": 1, "c": 5})
    assert sorted(map(tuple, same.collect())) == sorted(map(tuple, mixed.collect()))
    again = mixing.mix(odd)
    assert again.columns == [c for c in odd.columns if c != "copy"] + ["copy", "shuffle_key"]
    assert mixing.mix(odd.limit(0)).isEmpty()


# the pipeline


def test_pipeline(spark, documents):
    docs = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, DATA)
        assert kept.columns == documents.columns, name
        assert 0.8 * docs.count() < kept.count() <= docs.count()
        docs = kept
    mixed = corpus_pipeline.run(spark, DATA)
    assert {r.doc_id for r in mixed.select("doc_id").collect()} <= {r.doc_id for r in docs.select("doc_id").collect()}


def test_pipeline_of_odd_rows(spark, odd):
    docs = odd
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, DATA)
        docs.collect()
    docs = odd.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, DATA)
    assert docs.isEmpty()


def test_every_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 11))
    assert set(SQL) <= set(QUERIES)
    assert os.path.isdir(DATA)


def test_rows_keep_their_columns(odd):
    assert packed(odd, "doc_id").select("row.*").columns == odd.columns


def test_texts_without_white_space_take_work_in_proportion():
    """Single characters as tokens of a text that can be spliced nowhere."""
    from sensorgrid.llm.tokens import spliced_count

    done = 0

    def encode(text):
        nonlocal done
        done += len(text)
        return np.fromiter(map(ord, text), np.int64, len(text)), np.arange(len(text))

    chunk = 1 << 10
    for times in (10, 160):
        text = "漢字" * (chunk * times // 2)
        done = 0
        assert spliced_count(text, encode, chunk, 1 << 4) == len(text)
        assert done < 8 * len(text)
    text = ("漢" * 5_000 + " word ") * 20
    assert spliced_count(text, encode, chunk, 1 << 4) == len(text)


def test_two_scripts_with_more_letters_than_symbols(spark):
    """Six hundred letters each, of two parts of Unicode, and two mixed ones of the same letters."""
    rng = np.random.default_rng(11)

    def words(first, seed):
        own = np.random.default_rng(seed)
        return ["".join(chr(first + int(k)) for k in own.integers(0, 600, 4)) for _ in range(60)]

    kinds = {"a": words(0x4E00, 1), "b": words(0xAC00, 2), "c": words(0x4E00, 3)}
    rows = []
    for lang, own in kinds.items():
        for _ in range(40):
            rows.append((len(rows), " ".join(own[int(k)] for k in rng.integers(0, 60, 80)), lang))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language.fit(docs)
    assert model.classes == language.CLASSES and model.alphabet <= language.ALPHABET
    got = language.language_report(docs).filter("held_out").collect()
    langs = {i: lang for i, _, lang in rows}
    assert len(got) > 10 and all(r["lang_pred"] == langs[r["doc_id"]] for r in got)

"""Main text of pages by a graphical model on their trees."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorgrid.llm.html_tree import Node, Page, is_hidden, parse
from sensorgrid.session import ship_package

#: Pages that the potentials are counted on at most; about so many are drawn by a hash of the id.
LABELLED_PAGES = 2000
#: Weight of the assumed shares, as so many labelled nodes: what is counted soon outweighs them.
_ASSUMED = 1000.0

# What elements and words in class, id and role names say.
CONTENT_TAGS = frozenset(["article", "main"])
PROSE_TAGS = frozenset("p blockquote pre figcaption".split())
HEADING_TAGS = frozenset("h1 h2 h3 h4 h5 h6".split())
OTHER_TAGS = frozenset(
    "nav header footer aside form button select option menu dialog noscript head title fieldset textarea legend"
    " datalist frameset svg object canvas audio video template annotation annotation-xml".split()
)
OTHER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist"
    " complementary consent contentinfo cookie cookies copyright disclaimer disqus dropdown footer form gdpr header"
    " login masthead menu menubar modal nav navbar navigation newsletter notice notices notification overlay pager"
    " pagination paywall popup promo promoted promotion recommended related replies reply respond search share"
    " sharing sidebar signup skip social sponsor sponsored subscribe subscription tagcloud teaser toc toolbar"
    " topbar widget widgets".split()
)
CONTENT_WORDS = frozenset(
    "article articlebody body content entry main maincontent post postcontent story storybody text".split()
)
#: Shares of values among other and content nodes, assumed before pages are seen.
ASSUMED = {
    ("tag", "content"): (0.01, 0.1),
    ("tag", "prose"): (0.15, 0.4),
    ("tag", "heading"): (0.05, 0.1),
    ("tag", "other"): (0.25, 0.01),
    ("tag", "neutral"): (0.54, 0.39),
    ("names", "none"): (0.6, 0.8),
    ("names", "content"): (0.02, 0.17),
    ("names", "other"): (0.37, 0.02),
    ("names", "both"): (0.01, 0.01),
    ("text", "word"): (0.5, 0.1),
    ("text", "line"): (0.2, 0.15),
    ("text", "long"): (0.05, 0.1),
    ("text", "short sentence"): (0.1, 0.1),
    ("text", "sentence"): (0.1, 0.25),
    ("text", "sentences"): (0.05, 0.3),
    ("links", "none"): (0.4, 0.7),
    ("links", "few"): (0.1, 0.2),
    ("links", "many"): (0.1, 0.07),
    ("links", "most"): (0.4, 0.03),
}
#: Shares of content nodes below other and content parents: in a marked part of the page, and elsewhere.
ASSUMED_EDGES = {True: (0.005, 0.01), False: (0.12, 0.99)}

_NAME = re.compile(r"[a-z]+")
#: An element with at least this part of a page's sentences is no part beside them, whatever its name.
_MOST = 0.8


def _names(node: Node) -> str:
    words = set(_NAME.findall(" ".join(node.attributes.get(k, "") for k in ("class", "id", "role", "itemprop"))))
    other, content = bool(words & OTHER_WORDS), bool(words & CONTENT_WORDS)
    return "both" if other and content else "other" if other else "content" if content else "none"


def _tag(node: Node) -> str:
    if node.tag in CONTENT_TAGS:
        return "content"
    if node.tag in PROSE_TAGS:
        return "prose"
    if node.tag in HEADING_TAGS:
        return "heading"
    return "other" if node.tag in OTHER_TAGS else "neutral"


def features(node: Node) -> list[tuple[str, str]]:
    """What a node says for itself; a block without text of its own says nothing about text."""
    found = [("tag", _tag(node)), ("names", "none" if node.tag in ("html", "body") else _names(node))]
    if node.chars:
        part = node.link_chars / node.chars
        found.append(("links", "none" if not part else "few" if part < 0.3 else "many" if part < 0.7 else "most"))
        if node.tag not in HEADING_TAGS:
            k = (node.chars >= 20) + (node.chars >= 80)
            kinds = ("short sentence", "sentence", "sentences") if node.stops else ("word", "line", "long")
            found.append(("text", kinds[k]))
    return found


def marks(page: Page, values: list[list[tuple[str, str]]]) -> list[bool]:
    """Whether a node is in a part whose element or names say that it isn't the main text.

    An element around an article, or around most of the page's sentences outside links, says
    nothing about what it holds, unless it is hidden.
    """
    holds = [node.tag in CONTENT_TAGS for node in page.nodes]
    said = [node.chars - node.link_chars if node.stops else 0 for node in page.nodes]
    for k in range(len(holds) - 1, 0, -1):
        holds[page.nodes[k].parent] |= holds[k]
        said[page.nodes[k].parent] += said[k]
    marked = []
    for k, node in enumerate(page.nodes):
        (_, tag), (_, names), *_ = values[k]
        around = holds[k] or (said[k] > 0 and said[k] >= _MOST * said[0])
        own = is_hidden(node.attributes) or ((tag == "other" or names == "other") and not around)
        marked.append(own or (node.parent >= 0 and marked[node.parent]))
    return marked


def labels(page: Page, marked: list[bool]) -> list[bool] | None:
    """Labels that pages give themselves by their article or main element; None without one."""
    inside: list[bool] = []
    for node in page.nodes:
        inside.append(node.tag in CONTENT_TAGS or (node.parent >= 0 and inside[node.parent]))
    return [a and not b for a, b in zip(inside, marked, strict=True)] if any(inside) else None


@dataclass(frozen=True)
class TreeModel:
    """Potentials: of a value of a node's feature, and of a child's label given its parent's."""

    nodes: dict
    edges: dict

    @staticmethod
    def of(counts: Counter) -> TreeModel:
        """From counts of ("node", feature, value, label), ("edge", marked, parent, child) and ("any", feature, label)."""
        nodes, edges = {}, {}
        for (name, value), shares in ASSUMED.items():
            pair = []
            for label in (False, True):
                seen, every = counts["node", name, value, label], counts["any", name, label]
                pair.append((seen + _ASSUMED * shares[label]) / (every + _ASSUMED))
            nodes[name, value] = tuple(pair)
        for marked, shares in ASSUMED_EDGES.items():
            for parent in (False, True):
                seen = [counts["edge", marked, parent, child] for child in (False, True)]
                share = (seen[1] + _ASSUMED * shares[parent]) / (sum(seen) + _ASSUMED)
                edges[marked, parent] = (1 - share, share)
        return TreeModel(nodes, edges)

    def marginals(self, page: Page) -> list[float]:
        """The probability of each node to be content, by messages up the tree and down again."""
        values = [features(node) for node in page.nodes]
        marked = marks(page, values)
        n = len(page.nodes)
        own = []
        for found in values:
            a = b = 1.0
            for name, value in found:
                p, q = self.nodes[name, value]
                a, b = a * p, b * q
            own.append((a / (a + b), b / (a + b)))
        # up: what the part of the tree below a node says about its parent
        below, up = list(own), [(1.0, 1.0)] * n
        for k in range(n - 1, 0, -1):
            a, b = below[k]
            other, content = self.edges[marked[k], False], self.edges[marked[k], True]
            m0, m1 = other[0] * a + other[1] * b, content[0] * a + content[1] * b
            up[k] = m0, m1
            p = page.nodes[k].parent
            x, y = below[p][0] * m0, below[p][1] * m1
            below[p] = x / (x + y), y / (x + y)
        # down: what all the rest of the tree says about a node
        total = list(below)
        for k in range(1, n):
            p = page.nodes[k].parent
            x, y = total[p][0] / up[k][0], total[p][1] / up[k][1]
            x, y = x / (x + y), y / (x + y)
            other, content = self.edges[marked[k], False], self.edges[marked[k], True]
            a = below[k][0] * (x * other[0] + y * content[0])
            b = below[k][1] * (x * other[1] + y * content[1])
            total[k] = a / (a + b), b / (a + b)
        return [b for _, b in total]

    def text(self, page: str | None) -> str:
        tree = parse(page or "")
        content = self.marginals(tree)
        return " ".join(text for k, text in tree.runs if content[k] >= 0.5)


def _count_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    for batch in batches:
        for page in batch.column("html").to_pylist():
            tree = parse(page or "")
            values = [features(node) for node in tree.nodes]
            marked = marks(tree, values)
            given = labels(tree, marked)
            if given is None:
                continue
            for k, node in enumerate(tree.nodes):
                counts.update(("any", name, given[k]) for name, _ in values[k])
                counts.update(("node", name, value, given[k]) for name, value in values[k])
                if k:
                    counts["edge", marked[k], given[node.parent], given[k]] += 1
    if counts:
        keys = [repr(k) for k in counts]
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys), pa.array(list(counts.values()), pa.int64())], ["key", "n"]
        )


def fit(pages: DataFrame, sample: int = LABELLED_PAGES) -> TreeModel:
    """Count potentials on pages that label themselves by an article or main element.

    About ``sample`` pages are drawn by a hash of the id; this bound holds at every size. Assumed
    shares stand beside the counts, and alone where no page is labelled.
    """
    ship_package(pages.sparkSession)
    share = min(1.0, sample / max(1, pages.count()))
    drawn = pages.filter(F.pmod(F.xxhash64("page_id"), F.lit(1 << 30)) < share * (1 << 30))
    found = drawn.select(F.col("html").cast("string").alias("html")).mapInArrow(_count_batches, "key string, n bigint")
    rows = found.groupBy("key").agg(F.sum("n").alias("n")).collect()
    kinds = {repr(k): k for k in _keys()}
    return TreeModel.of(Counter({kinds[r["key"]]: r["n"] for r in rows}))


def _keys() -> Iterator[tuple]:
    for label in (False, True):
        for name, value in ASSUMED:
            yield "any", name, label
            yield "node", name, value, label
        for marked in (False, True):
            for parent in (False, True):
                yield "edge", marked, parent, label


def _extract(model: TreeModel):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [model.text(page) for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
                ["page_id", "url", "text"],
            )

    return run


def main_texts(pages: DataFrame, model: TreeModel | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of every page.

    The tree's nodes are block elements; inline ones belong to their block. A block's text runs
    are kept if its node is content with a probability of a half or more. Character references
    are decoded, white space inside a run is one space, and runs are joined by one space in page
    order. Null and empty pages have no text; pages that repeat come back each.
    """
    ship_package(pages.sparkSession)
    model = model or fit(pages)
    pages = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.col("html").cast("string"))
    found = pages.mapInArrow(_extract(model), "page_id bigint, url string, text string")
    return found.withColumn("n_chars", F.length("text").cast("bigint"))

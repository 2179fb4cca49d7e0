"""Main texts of pages of several templates without article elements, and what may not cost text."""

import time
from collections import Counter

import pytest
from sensorgrid.llm import extraction
from sensorgrid.llm.html_tree import parse

MODEL = extraction.TreeModel.of(Counter())
TEXT = (
    "A title of the page This is the first sentence of the article, and it says a lot, really. It has more."
    " Another paragraph follows it, which is long enough to be a sentence. And one more sentence here."
)
BODY = (
    "<h1>A title of the page</h1><p>This is the first sentence of the article, and it says a lot, really. It has"
    " more.</p><p>Another paragraph follows it, which is long enough to be a sentence. And one more sentence here.</p>"
)
SIDE = '<div class="sidebar">Side text, only here.</div>'
COMMENTS = (
    '<div class="comments"><p>Great post, thanks a lot for all of it.</p>'
    "<p>I do not agree, since it is wrong. It is.</p></div>"
)


def page(inner):
    return (
        "<html><head><title>t</title></head><body><nav><a href=/>Home</a><a href=/b>More</a></nav>"
        f"{inner}<footer>Copyright 2020 by us. All rights reserved.</footer></body></html>"
    )


@pytest.mark.parametrize(
    "inner",
    [
        f"<div>{BODY}</div>",
        f"<form id=aspnetForm>{BODY}</form>",
        f'<div class="wrapper with-sidebar">{BODY}{SIDE}</div>',
        f'<div class="page has-header"><div class="header">Site name</div>{BODY}</div>',
        f"<div><!-->{BODY}<!---><!-- x --!></div>",
        f"<div>{BODY}</div>{COMMENTS}",
        f"<div><div>{BODY}</div>{SIDE}{COMMENTS}</div>",
        f"<table><tr><td>{BODY}</td></tr></table>",
        f'<div>{BODY}<span hidden>not seen, this.</span><span class="ad">Buy it, now.</span></div>',
    ],
)
def test_templates_without_article(inner):
    assert MODEL.text(page(inner)) == TEXT


def test_inline_asides_end_where_they_end():
    line = '<p>Before it <span class="ad">Buy <span>this</span>, please.</span> and <b>after</b> it, a sentence.</p>'
    assert MODEL.text(page(f"<div>{BODY}{line}</div>")) == f"{TEXT} Before it and after it, a sentence."
    unclosed = '<p>One <span style="display: none">lost</p><p>Two, which is a whole sentence.</p>'
    assert MODEL.text(page(f"<div>{BODY}{unclosed}</div>")).endswith("One Two, which is a whole sentence.")


def test_counts_outweigh_what_is_assumed():
    seen = {("any", "tag", label): 10_000 for label in (False, True)}
    seen |= {("node", "tag", "prose", label): 10_000 for label in (False, True)}
    seen["edge", False, True, False] = 10_000
    model = extraction.TreeModel.of(Counter(seen))
    assert all(p > 0.9 for p in model.nodes["tag", "prose"]) and model.nodes["tag", "neutral"][0] < 0.1
    assert model.edges[False, True][1] < 0.1


def test_stray_end_tags_in_depth_take_linear_time():
    def seconds(n):
        start = time.process_time()
        tree = parse("<div>" * n + "</p></section>" * n + "x")
        assert len(tree.nodes) == n + 1
        return time.process_time() - start

    assert seconds(40_000) < 8 * seconds(10_000) + 0.5

"""Elements that once took the rest of a page with them."""

import pytest

from sensorgrid.llm import extraction, html_tree


@pytest.mark.parametrize(
    "before",
    [
        "<video-js class=x></video-js>", "<math-field>a</math-field>", "<style-guide></style-guide>", "<svg/>",
        '<svg width="1" />', "<math/>", "<video src=x>", "<audio src=x>", "<canvas>", "<object data=x>",
        "<script>if (a < b) {}</script >", "<style>a > b {}</style>",
    ],
)
def test_text_goes_on(before):
    page = html_tree.parse(f"<article><p>One.</p>{before}<p>Two.</p></article>")
    texts = [text for _, text in page.runs]
    assert texts[0] == "One." and texts[-1] == "Two."
    assert not any("{" in text for text in texts)
    marked = extraction.marks(page, [extraction.features(n) for n in page.nodes])
    assert not marked[page.runs[-1][0]]


def test_formulas_stay_in_their_line():
    page = html_tree.parse("<p>So <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds.</p>")
    assert [text for _, text in page.runs] == ["So x=1 holds."]


def test_players_are_other_parts():
    page = html_tree.parse("<article><p>One.</p><svg><title>icon</title></svg><p>Two.</p></article>")
    marked = extraction.marks(page, [extraction.features(n) for n in page.nodes])
    assert [text for k, text in page.runs if not marked[k]] == ["One.", "Two."]

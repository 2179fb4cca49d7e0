"""Pages as trees of block elements, with the text runs that stand in them."""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

# Elements that stand inside lines of text, that have no content, whose content is no
# text, and that end an open paragraph or item.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q s samp small span"
    " strike strong sub sup time tt u var wbr"
    # formulas are part of their line
    " math maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot"
    " mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split()
)
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr basefont frame keygen".split()
)
#: Words in names of inline adverts.
ADVERT_WORDS = frozenset("ad ads advert adverts advertisement advertising promo promoted sponsor sponsored".split())
RAW = "script|style|iframe|noembed|noframes|xmp"
#: Without an end tag further on these have no content, so that a page goes on after them.
PLAYERS = frozenset("svg object canvas audio video template".split())
PARAGRAPH_ENDS = frozenset(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table tbody td tfoot th"
    " thead tr ul".split()
)
#: An element ends an open one of these, unless one of the second set stands between.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
    "body": ({"head"}, set()),
}

_TAG = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    rf"|<(?P<raw>{RAW})(?=[\s/>])[^>]*+>.*?(?:</(?P=raw)(?=[\s/>])[^>]*+>|\Z)"
    r"""|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"|</?[a-zA-Z][^>]*+(?:>|\Z)|<![^>]*+(?:>|\Z)|<\?[^>]*+(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(
    r"""\b(class|id|role|style|hidden|aria-hidden|itemprop)\s*+(?:=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?""",
    re.IGNORECASE,
)
_NAME = re.compile(r"[a-z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


@dataclass
class Node:
    tag: str
    parent: int
    attributes: dict[str, str] = field(default_factory=dict)
    #: Characters of text directly in the block, and those of them inside links.
    chars: int = 0
    link_chars: int = 0
    stops: int = 0


@dataclass
class Page:
    """Nodes in page order, so parents come before children; runs of text by node, in page order."""

    nodes: list[Node]
    runs: list[tuple[int, str]]


def attributes(text: str) -> dict[str, str]:
    """What a tag says of class, id, role, style and hiding."""
    if "=" not in text and "hidden" not in text:
        return {}
    return {k.lower(): v.strip("\"'").lower() for k, v in _ATTRIBUTE.findall(text)}


def is_hidden(found: dict[str, str]) -> bool:
    return "hidden" in found or found.get("aria-hidden") == "true" or bool(_HIDDEN.search(found.get("style", "")))


def is_aside(found: dict[str, str]) -> bool:
    """Whether an inline element is no part of its line: hidden, or named as an advert."""
    names = _NAME.findall(" ".join(found.get(k, "") for k in ("class", "id", "role")))
    return is_hidden(found) or not ADVERT_WORDS.isdisjoint(names)


def parse(text: str) -> Page:
    """The tree of a page. Broken markup is taken as it comes: every tag is used, none is an error."""
    nodes, runs, stack = [Node("#root", -1)], [], [0]
    open_tags: Counter[str] = Counter()
    #: Inline elements that are nodes: where they stand in the stack, and open ones of their name inside.
    asides: list[list[int]] = []
    parts: list[str] = []
    links = 0
    last_ends: dict[str, int] = {}

    def end_run() -> None:
        if parts:
            words = " ".join("".join(parts).split())
            if words:
                runs.append((stack[-1], words))
            parts.clear()

    def close(tags: frozenset[str] | set[str], stops: set[str] | frozenset[str]) -> None:
        if not any(open_tags[tag] for tag in tags):
            return
        for k in range(len(stack) - 1, 0, -1):
            tag = nodes[stack[k]].tag
            if tag in tags:
                end_run()
                open_tags.subtract(nodes[i].tag for i in stack[k:])
                del stack[k:]
                while asides and asides[-1][0] >= k:
                    asides.pop()
                return
            if tag in stops:
                return

    def add(piece: str) -> None:
        if "&" in piece:
            piece = html.unescape(piece)
        parts.append(piece)
        size = len(piece.strip())
        if size:
            node = nodes[stack[-1]]
            node.chars += size
            node.stops += sum(map(piece.count, ".,;!?"))
            if links:
                node.link_chars += size

    at = 0
    for m in _TAG.finditer(text):
        if m.start() > at:
            add(text[at : m.start()])
        at = m.end()
        name = m["name"]
        if not name:
            continue
        name = name.lower()
        if m["end"]:
            if name == "a":
                links = max(0, links - 1)
            elif name not in INLINE:
                close({name}, frozenset())
            elif asides and nodes[stack[asides[-1][0]]].tag == name:
                if asides[-1][1]:
                    asides[-1][1] -= 1
                else:
                    close({name}, frozenset())
            continue
        attrs = m["attrs"]
        if name in INLINE:
            if asides and nodes[stack[asides[-1][0]]].tag == name:
                asides[-1][1] += 1
            elif name not in VOID and ("=" in attrs or "hidden" in attrs) and is_aside(found := attributes(attrs)):
                end_run()
                nodes.append(Node(name, stack[-1], found))
                stack.append(len(nodes) - 1)
                open_tags[name] += 1
                asides.append([len(stack) - 1, 0])
                continue
            if name == "a":
                links += 1
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name in VOID and name != "hr":
            continue
        if name in PARAGRAPH_ENDS:
            close({"p"}, {"table", "button"})
        if name in SIBLINGS:
            close(*SIBLINGS[name])
        end_run()
        links = 0
        if name == "hr":
            continue
        nodes.append(Node(name, stack[-1], attributes(attrs)))
        if name in PLAYERS:
            if name not in last_ends:
                last_ends[name] = max((e.start() for e in re.finditer(rf"</{name}(?=[\s/>])", text, re.IGNORECASE)), default=-1)
            if last_ends[name] < at:
                continue
        if not attrs.endswith("/"):
            stack.append(len(nodes) - 1)
            open_tags[name] += 1
    if at < len(text):
        add(text[at:])
    end_run()
    return Page(nodes, runs)

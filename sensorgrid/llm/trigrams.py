"""Boolean trigram queries that any text with a match of a pattern must meet."""

from __future__ import annotations

from itertools import product
from re import IGNORECASE, _constants as c, _parser

#: An ``or`` of ``and``s: one of the sets must be in the text whole.
Query = frozenset[frozenset[str]]
ANYTHING: Query = frozenset([frozenset()])
_MOST = 64


def _either(left: Query, right: Query) -> Query:
    found = left | right
    return frozenset(x for x in found if not any(y < x for y in found))


def _both(left: Query, right: Query) -> Query:
    if len(left) * len(right) > _MOST:  # too long: either alone is still true
        return min(left, right, key=len) if ANYTHING not in (left, right) else max(left, right, key=len)
    return _either(frozenset(x | y for x, y in product(left, right)), frozenset())


def _of_strings(strings: frozenset[str]) -> Query:
    query: Query = frozenset()
    for s in strings:
        query = _either(query, frozenset([frozenset(s[k : k + 3] for k in range(len(s) - 2))]))
    return query


def _walk(nodes) -> tuple[frozenset[str] | None, Query]:
    """The strings that the nodes match, if they are few, and the query of all their matches."""
    before: frozenset[str] = frozenset([""])
    query, known = ANYTHING, True
    for op, value in nodes:
        strings, need = _node(op, value)
        if strings is not None and len(before) * len(strings) <= _MOST:
            before = frozenset(a + b for a, b in product(before, strings))
            continue
        known = False
        query = _both(query, _of_strings(before))
        if strings is None:
            query, before = _both(query, need), frozenset([""])
        else:
            before = strings
    query = _both(query, _of_strings(before))
    return (before if known else None), query


def _node(op, value) -> tuple[frozenset[str] | None, Query]:
    if op is c.LITERAL:
        return frozenset([chr(value).lower()]), ANYTHING
    if op is c.SUBPATTERN:
        return _walk(value[-1])
    if op is c.BRANCH:
        parts = [_walk(x) for x in value[1]]
        query: Query = frozenset()
        for _, need in parts:
            query = _either(query, need)
        strings = [x for x, _ in parts]
        if None in strings or sum(map(len, strings)) > _MOST:
            return None, query
        return frozenset().union(*strings), query
    if op is c.IN and all(kind is c.LITERAL for kind, _ in value) and len(value) <= 8:
        return frozenset(chr(x).lower() for _, x in value), ANYTHING
    if op in (c.MAX_REPEAT, c.MIN_REPEAT, c.POSSESSIVE_REPEAT):
        least, most, inner = value
        strings, need = _walk(inner)
        if least == 0:
            if most == 1 and strings is not None:
                return strings | {""}, ANYTHING
            return None, ANYTHING
        if strings is not None and least == most and len(strings) == 1:
            return frozenset(s * least for s in strings), ANYTHING
        return None, need
    if op is c.AT:
        return frozenset([""]), ANYTHING
    return None, ANYTHING


def trigram_query(pattern: str) -> Query:
    """The query of a pattern over lower-cased texts; ``ANYTHING`` if no trigram is mandatory."""
    query = _walk(_parser.parse(pattern, IGNORECASE))[1]
    return ANYTHING if frozenset() in query else query

"""Boolean trigram queries derived from regular expressions.

A query is None (anything may match), a trigram, or a tuple ("and" | "or", query, ...). Every text
that the expression matches satisfies its query, once ASCII letters are lower-cased in both.
"""

from __future__ import annotations

from itertools import product

# The standard library's own reader of regular expressions.
from re import _constants as codes
from re import _parser as reader

# Literal alternatives kept apart before they are turned into a query.
MOST = 32


def _grams(text: str):
    found = sorted({text[i : i + 3] for i in range(len(text) - 2)})
    return _join("and", found)


def _join(kind: str, parts):
    """`parts` under one connective; "or" with an open part is open, "and" drops open parts."""
    parts = list(dict.fromkeys(parts))
    if kind == "or" and (not parts or None in parts):
        return None
    parts = [p for p in parts if p is not None]
    if kind == "or":
        # A part that asks for all another one asks for, and more, adds nothing.
        asked = [frozenset(p[1:]) if p[0] == "and" else frozenset([p]) for p in parts]
        parts = [p for p, own in zip(parts, asked, strict=True) if not any(other < own for other in asked)]
    return (kind, *parts) if len(parts) > 1 else parts[0] if parts else None


def _strings(node) -> list[str] | None:
    """The few strings a node can match, if they are known."""
    kind, value = node
    if kind is codes.LITERAL:
        return [chr(value).lower() if value < 128 else chr(value)]
    if kind is codes.IN and all(k is codes.LITERAL for k, _ in value):
        return sorted({chr(v).lower() for _, v in value})
    if kind in (codes.MAX_REPEAT, codes.MIN_REPEAT) and value[:2] == (0, 1):
        inner = _sequence_strings(value[2])
        return None if inner is None else ["", *inner]
    if kind is codes.SUBPATTERN:
        return _sequence_strings(value[3])
    if kind is codes.BRANCH:
        inner = [_sequence_strings(x) for x in value[1]]
        return None if None in inner else sorted({s for part in inner for s in part})
    return None


def _sequence_strings(nodes) -> list[str] | None:
    known = [""]
    for node in nodes:
        found = _strings(node)
        if found is None or len(known) * len(found) > MOST:
            return None
        known = [a + b for a, b in product(known, found)]
    return known


def _query(nodes):
    parts, run = [], [""]

    def close():
        parts.append(_join("or", [_grams(s) for s in run]))

    for node in nodes:
        found = _strings(node)
        if found is not None and len(run) * len(found) <= MOST:
            run = [a + b for a, b in product(run, found)]
            continue
        close()
        run = found if found is not None else [""]
        kind, value = node
        if found is not None:
            continue
        if kind is codes.SUBPATTERN:
            parts.append(_query(value[3]))
        elif kind is codes.BRANCH:
            parts.append(_join("or", [_query(x) for x in value[1]]))
        elif kind in (codes.MAX_REPEAT, codes.MIN_REPEAT) and value[0] > 0:
            parts.append(_query(list(value[2]) * min(value[0], 3)))
    close()
    return _join("and", parts)


def trigram_query(expression: str):
    """The query every match of `expression` satisfies; None when it has no mandatory trigram."""
    return _query(list(reader.parse(expression)))


def trigrams(query) -> set[str]:
    """The trigrams a query mentions."""
    if query is None:
        return set()
    return {query} if isinstance(query, str) else set().union(*(trigrams(q) for q in query[1:]))

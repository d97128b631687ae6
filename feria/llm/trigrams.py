"""Boolean trigram queries of regular expressions.

A query is a list of clauses, all of which hold for any matching text; a clause
is a set of alternatives, one of which holds; an alternative is a set of
trigrams (lower case) that the text contains. No clause: nothing is mandatory.
"""

from __future__ import annotations

import re

#: Exact strings kept side by side, and characters of a class that is spelled out.
MOST_STRINGS, MOST_CHARACTERS = 64, 8

Clause = frozenset[frozenset[str]]


def _characters(items) -> set[str] | None:
    out: set[str] = set()
    for kind, value in items:
        if str(kind) == "LITERAL":
            out.add(chr(value))
        elif str(kind) == "RANGE" and value[1] - value[0] < MOST_CHARACTERS:
            out |= {chr(c) for c in range(value[0], value[1] + 1)}
        else:
            return None
    return out if len(out) <= MOST_CHARACTERS else None


def _clause(strings: set[str]) -> Clause | None:
    """That one of the strings occurs; None if that says nothing."""
    sets = {frozenset(s[i: i + 3] for i in range(len(s) - 2)) for s in strings}
    if not all(sets):
        return None
    return frozenset(s for s in sets if not any(t < s for t in sets))


def _exact(node) -> set[str] | None:
    """The strings that the node can match, if they are few."""
    kind, value = str(node[0]), node[1]
    if kind == "LITERAL":
        return {chr(value).lower()}
    if kind == "IN":
        found = _characters(value)
        return found and {c.lower() for c in found}
    if kind == "BRANCH":
        return _union([_sequence(list(v)) for v in value[1]])
    if kind == "SUBPATTERN":
        return _sequence(list(value[3]))
    if kind in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT") and value[1] <= 4:
        inner = _sequence(list(value[2]))
        return inner and _union([_product([inner] * n) for n in range(value[0], value[1] + 1)])
    return {""} if kind in ("AT", "ASSERT", "ASSERT_NOT") else None


def _union(sets: list[set[str] | None]) -> set[str] | None:
    if any(s is None for s in sets):
        return None
    out = set().union(*sets)
    return out if len(out) <= MOST_STRINGS else None


def _product(sets: list[set[str] | None]) -> set[str] | None:
    out: set[str] | None = {""}
    for s in sets:
        out = None if s is None or len(out) * len(s) > MOST_STRINGS else {a + b for a in out for b in s}
        if out is None:
            return None
    return out


def _sequence(nodes) -> set[str] | None:
    return _product([_exact(n) for n in nodes])


def _clauses(nodes) -> list[Clause]:
    out: list[Clause | None] = []
    run = {""}
    for node in nodes:
        strings = _exact(node)
        if strings is not None and len(run) * len(strings) <= MOST_STRINGS:
            run = {a + b for a in run for b in strings}
            continue
        out.append(_clause(run))
        run = strings if strings is not None else {""}
        kind, value = str(node[0]), node[1]
        if strings is None:
            if kind == "SUBPATTERN":
                out += _clauses(list(value[3]))
            elif kind in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT") and value[0] > 0:
                out += _clauses(list(value[2]))
    return [c for c in [*out, _clause(run)] if c]


def query(pattern: str) -> list[Clause]:
    """The query of a pattern that Java and Python read alike."""
    return list(dict.fromkeys(_clauses(list(re._parser.parse(pattern)))))

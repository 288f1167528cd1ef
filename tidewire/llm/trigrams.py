"""Boolean trigram queries that every match of a regular expression must satisfy."""

from __future__ import annotations

import re
from itertools import product

# A stretch of a pattern with more spellings than this counts as unknown text.
MAX_SPELLINGS = 64

# A query in disjunctive form: one of the sets of trigrams must be in the text as a whole. None asks for nothing.
Query = frozenset[frozenset[str]] | None


def _both(a: Query, b: Query) -> Query:
    if a is None or b is None:
        return b if a is None else a
    return frozenset(x | y for x, y in product(a, b))


def _either(queries: list[Query]) -> Query:
    return None if None in queries else frozenset().union(*queries)


def _asks(spellings: set[str]) -> Query:
    """One of the spellings is in the text; spellings of fewer than three characters ask for nothing."""
    if any(len(s) < 3 for s in spellings):
        return None
    return frozenset(frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in spellings)


def _spellings(op: str, value: object) -> set[str] | None:
    """All texts that a part of a pattern can match, if they are few; in lower case."""
    if op == "LITERAL":
        return {chr(value).lower()}
    if op == "IN":
        found: set[str] = set()
        for kind, inner in value:
            if str(kind) == "LITERAL":
                found.add(chr(inner).lower())
            elif str(kind) == "RANGE" and inner[1] - inner[0] < MAX_SPELLINGS:
                found.update(chr(c).lower() for c in range(inner[0], inner[1] + 1))
            else:
                return None
        return found if len(found) <= 8 else None
    if op == "SUBPATTERN":
        return _sequence_spellings(value[3])
    if op == "BRANCH":
        branches = [_sequence_spellings(b) for b in value[1]]
        return None if None in branches else set().union(*branches)
    if op == "MAX_REPEAT" and value[1] <= 2:
        inner = _sequence_spellings(value[2])
        if inner is not None:
            return {"".join(p) for n in range(value[0], value[1] + 1) for p in product(sorted(inner), repeat=n)}
    return None


def _sequence_spellings(items: object) -> set[str] | None:
    spellings = {""}
    for op, value in items:
        following = _spellings(str(op), value)
        if following is None or len(spellings) * len(following) > MAX_SPELLINGS:
            return None
        spellings = {a + b for a in spellings for b in following}
    return spellings


def _sequence(items: object) -> Query:
    """Literal stretches are joined across parts; a part of unknown text ends a stretch."""
    query: Query = None
    stretch = {""}
    for op, value in items:
        following = _spellings(str(op), value)
        if following is not None and len(stretch) * len(following) <= MAX_SPELLINGS:
            stretch = {a + b for a in stretch for b in following}
            continue
        query, stretch = _both(query, _asks(stretch)), {""}
        if following is not None:
            stretch = following
        elif str(op) == "SUBPATTERN":
            query = _both(query, _sequence(value[3]))
        elif str(op) == "BRANCH":
            query = _both(query, _either([_sequence(b) for b in value[1]]))
        elif str(op) in ("MAX_REPEAT", "MIN_REPEAT") and value[0] > 0:
            query = _both(query, _sequence(value[2]))
    return _both(query, _asks(stretch))


def trigram_query(pattern: str) -> Query:
    """The trigrams (in lower case) that a text needs for a match; None if every text must be searched.

    A conjunction that contains another one is left out: the smaller one already lets such texts pass.
    """
    query = _sequence(re._parser.parse(pattern))
    return query and frozenset(q for q in query if not any(other < q for other in query))

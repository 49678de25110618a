"""Boolean trigram queries from regular expressions.

A query is True (no trigram is mandatory), a trigram, or ("and" | "or", parts); every text
that the expression matches satisfies the query, after both are folded to lower case.
"""

from __future__ import annotations

from re import _constants as C
from re import _parser as parser

#: Alternatives that are followed exactly; beyond it a part only contributes its own query.
MAX_EXACT = 64
MAX_CLASS = 8


def all_of(parts):
    parts = {p for p in parts if p is not True}
    flat = set().union(*(p[1] if p[0] == "and" else {p} for p in parts)) if parts else set()
    return True if not flat else flat.pop() if len(flat) == 1 else ("and", frozenset(flat))


def _asks(query) -> frozenset | None:
    """The trigrams of a plain conjunction."""
    if query[0] == "tri":
        return frozenset([query])
    return query[1] if query[0] == "and" and all(p[0] == "tri" for p in query[1]) else None


def any_of(parts):
    parts = set(parts)
    if True in parts or not parts:
        return True
    # an alternative that asks for more than another one adds nothing
    plain = {p: asked for p in parts if (asked := _asks(p)) is not None}
    parts = {p for p in parts if p not in plain or not any(
        other < plain[p] for other in plain.values())}
    return parts.pop() if len(parts) == 1 else ("or", frozenset(parts))


def of_string(s: str):
    return all_of(("tri", s[i:i + 3]) for i in range(len(s) - 2))


def of_strings(strings):
    return any_of(of_string(s) for s in strings)


def _class(items) -> set[str] | None:
    found = set()
    for op, arg in items:
        if op is C.LITERAL:
            found.add(chr(arg).lower())
        elif op is C.RANGE and arg[1] - arg[0] < MAX_CLASS:
            found |= {chr(c).lower() for c in range(arg[0], arg[1] + 1)}
        else:
            return None
    return found if len(found) <= MAX_CLASS else None


def _walk(seq):
    """(exact strings or None, query) of a sequence of parsed items."""
    exact, queries, whole = {""}, [], True

    def cut():
        nonlocal exact, whole
        queries.append(of_strings(exact))
        exact, whole = {""}, False

    for op, arg in seq:
        own, query = None, True
        if op is C.LITERAL:
            own = {chr(arg).lower()}
        elif op is C.IN:
            own = _class(arg)
        elif op is C.AT:
            own = {""}
        elif op is C.SUBPATTERN:
            own, query = _walk(arg[3])
        elif op is C.BRANCH:
            parts = [_walk(x) for x in arg[1]]
            if all(p[0] is not None for p in parts):
                own = set().union(*(p[0] for p in parts))
            else:
                query = any_of(p[1] for p in parts)
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT):
            least, most, item = arg
            once, inner = _walk(item)
            if (least, most) == (0, 1) and once is not None:
                own = once | {""}
            elif least == most and once is not None and len(once) ** least <= MAX_EXACT:
                own = {""}
                for _ in range(least):
                    own = {x + y for x in own for y in once}
            elif least:
                query = inner if once is None else of_strings(once)
        if own is None or len(exact) * len(own) > MAX_EXACT:
            cut()
            queries.append(query if own is None else of_strings(own))
        else:
            exact = {x + y for x in exact for y in own}
    if whole:
        return exact, of_strings(exact)
    queries.append(of_strings(exact))
    return None, all_of(queries)


def trigram_query(pattern: str):
    """The query of a regular expression (Python syntax)."""
    return _walk(parser.parse(pattern))[1]


def trigrams_of(query) -> set[str]:
    if query is True:
        return set()
    return {query[1]} if query[0] == "tri" else set().union(*map(trigrams_of, query[1]))


def holds(query, present: set[str]) -> bool:
    if query is True:
        return True
    if query[0] == "tri":
        return query[1] in present
    return (all if query[0] == "and" else any)(holds(q, present) for q in query[1])

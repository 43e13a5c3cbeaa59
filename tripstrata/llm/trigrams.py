"""Boolean trigram queries from regular expressions, and a trigram inverted index that answers them.

A query is a condition that every text with a match fulfils: trigrams that must occur, joined by "and" and "or".
Literal stretches give them; classes of up to ``CLASS_LIMIT`` letters and optional parts multiply the stretches
they stand in, up to ``STRING_LIMIT`` strings.  Everything else ends a stretch.  A pattern without any stretch of
three bytes asks for nothing (``ALL``), and each text is a candidate.  Index and queries are in ASCII lower case.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from re import _constants as C
from re import _parser

import numpy as np

from .words import LOWER

CLASS_LIMIT = 8
STRING_LIMIT = 64


@dataclass(frozen=True)
class Query:
    """``kind`` is "all", "tri" (with ``code``), "and" or "or" (with ``parts``)."""

    kind: str
    code: int = -1
    parts: frozenset[Query] = frozenset()

    def codes(self) -> set[int]:
        return {self.code} if self.kind == "tri" else {c for p in self.parts for c in p.codes()}


ALL = Query("all")


def both(parts: Iterable[Query]) -> Query:
    """The parts joined by "and"."""
    flat = frozenset(x for p in parts for x in (p.parts if p.kind == "and" else (p,)) if x != ALL)
    # a choice that holds one of the other parts anyway says nothing more
    flat = frozenset(p for p in flat if not (p.kind == "or" and p.parts & flat))
    return ALL if not flat else next(iter(flat)) if len(flat) == 1 else Query("and", parts=flat)


def either(parts: Iterable[Query]) -> Query:
    """The parts joined by "or"; one that asks for more than another is left out."""
    parts = set(parts)
    if ALL in parts or not parts:
        return ALL
    conditions = {p: p.parts if p.kind == "and" else frozenset((p,)) for p in parts}
    least = [p for p in parts if not any(conditions[q] < conditions[p] for q in parts)]
    return least[0] if len(least) == 1 else Query("or", parts=frozenset(least))


def of_string(text: bytes) -> Query:
    return both(Query("tri", int.from_bytes(text[i : i + 3])) for i in range(len(text) - 2))


def of_strings(texts: Iterable[bytes]) -> Query:
    return either(of_string(t) for t in texts)


def _letter(code: int, ignore_case: bool) -> set[bytes] | None:
    if code >= 0x80 and ignore_case:
        return None  # its other case may be spelled in other bytes
    return {chr(code).lower().encode() if code < 0x80 else chr(code).encode()}


def _letters(items, ignore_case: bool) -> set[bytes] | None:
    found: set[bytes] = set()
    for op, value in items:
        codes = [value] if op is C.LITERAL else range(value[0], value[1] + 1) if op is C.RANGE else None
        if codes is None or len(codes) > 2 * CLASS_LIMIT:
            return None
        letters = [_letter(c, ignore_case) for c in codes]
        if None in letters:
            return None
        found |= set().union(*letters)
    return found if len(found) <= CLASS_LIMIT else None


def _one(op, value, ignore_case: bool) -> tuple[set[bytes] | None, Query]:
    """The strings that one element of a pattern stands for, or None, and what a match of it needs."""
    if op is C.LITERAL:
        return _letter(value, ignore_case), ALL
    if op is C.IN:
        return _letters(value, ignore_case), ALL
    if op is C.AT or op in (C.ASSERT, C.ASSERT_NOT):
        return {b""}, ALL
    if op is C.SUBPATTERN:
        _, on, off, inside = value
        return _sequence(inside, bool((ignore_case or on & C.SRE_FLAG_IGNORECASE) and not off & C.SRE_FLAG_IGNORECASE))
    if op is C.BRANCH:
        strings, queries = zip(*(_sequence(b, ignore_case) for b in value[1]))
        if all(s is not None for s in strings) and len(whole := set().union(*strings)) <= STRING_LIMIT:
            return whole, ALL
        return None, either(q if s is None else of_strings(s) for s, q in zip(strings, queries))
    if op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT):
        least, most, inside = value
        if not least and most != 1:
            return None, ALL
        strings, query = _sequence(inside, ignore_case)
        if not least:
            return (strings | {b""}, ALL) if strings is not None else (None, ALL)
        if least == most == 1:
            return strings, query
        return None, query if strings is None else of_strings(_product([strings] * min(least, 3)) or strings)
    return None, ALL


def _product(sets: list[set[bytes]]) -> set[bytes] | None:
    out = {b""}
    for s in sets:
        if len(out) * len(s) > STRING_LIMIT:
            return None
        out = {a + b for a in out for b in s}
    return out


def _sequence(items, ignore_case: bool) -> tuple[set[bytes] | None, Query]:
    """As :func:`_one` for elements one after the other."""
    stretch, queries, whole = {b""}, [], True
    for op, value in items:
        strings, query = _one(op, value, ignore_case)
        queries.append(query)
        longer = _product([stretch, strings]) if strings is not None else None
        if longer is not None:
            stretch = longer
            continue
        queries.append(of_strings(stretch))
        whole = False
        # where only the product was too large, the ends of the strings so far go on
        ends = {s[-2:] for s in stretch}
        stretch = {b""} if strings is None else _product([ends, strings]) or strings
    if whole:
        return stretch, ALL
    return None, both([*queries, of_strings(stretch)])


def query_of(pattern: str, flags: int = 0) -> Query:
    """What every text that holds a match of ``pattern`` fulfils."""
    parsed = _parser.parse(pattern, flags)
    strings, query = _sequence(parsed, bool(parsed.state.flags & C.SRE_FLAG_IGNORECASE))
    return query if strings is None else of_strings(strings)


class Index:
    """Posting lists of some trigrams over a segment of texts: the texts' numbers, ascending."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, wanted: np.ndarray, codes: np.ndarray):
        """``wanted`` is a flag for each of the 2**24 trigrams, ``codes`` the ascending numbers of those set."""
        self.size, self.codes = len(offsets) - 1, codes
        low = LOWER[data].astype(np.uint32)
        trigrams = (low[:-2] << 16) | (low[1:-1] << 8) | low[2:]
        at = np.flatnonzero(wanted[trigrams])
        text = np.searchsorted(offsets, at, "right") - 1
        inside = at + 3 <= offsets[text + 1]  # not across two texts
        slot = np.searchsorted(codes, trigrams[at[inside]])
        pairs = np.unique(slot * self.size + text[inside])
        self.texts = pairs % max(1, self.size)
        self.cuts = np.searchsorted(pairs, np.arange(len(codes) + 1) * self.size)

    def postings(self, code: int) -> np.ndarray:
        k = int(np.searchsorted(self.codes, code))
        return self.texts[self.cuts[k] : self.cuts[k + 1]]

    def answer(self, query: Query) -> np.ndarray:
        """Numbers of the texts that fulfil ``query``."""
        if query.kind == "all":
            return np.arange(self.size)
        if query.kind == "tri":
            return self.postings(query.code)
        found = sorted((self.answer(p) for p in query.parts), key=len)
        if query.kind == "and":
            return reduce(lambda a, b: np.intersect1d(a, b, assume_unique=True), found)
        return reduce(np.union1d, found)


def wanted_trigrams(queries: Iterable[Query]) -> tuple[np.ndarray, np.ndarray]:
    """Flags and ascending numbers of the trigrams that the queries name."""
    codes = np.array(sorted(set().union(*(q.codes() for q in queries))), np.uint32)
    wanted = np.zeros(1 << 24, bool)
    wanted[codes] = True
    return wanted, codes

"""Trigrams that a match of a regular expression must contain.

A query is an OR of clauses, each an AND of lower-cased trigrams: every match of the
expression contains all trigrams of at least one clause, in some letter case.
"""

from __future__ import annotations

import re
from re import _constants as kinds
from re import _parser as parser

SMALL_CLASS = 8
MOST_ALTERNATIVES = 64

# An alternative: the literal runs that are complete, and the one that may still grow.
Alternative = tuple[tuple[str, ...], str]


def _closed(alternatives: set[Alternative]) -> set[Alternative]:
    """A run of under three characters holds no trigram, so it is not kept."""
    return {((*runs, last) if len(last) > 2 else runs, "") for runs, last in alternatives}


def _grown(alternatives: set[Alternative], characters: str) -> set[Alternative]:
    return {(runs, last + c) for runs, last in alternatives for c in characters}


def _class_members(items) -> str | None:
    """The characters of a small class, or None."""
    found = []
    for kind, value in items:
        if kind is kinds.LITERAL:
            found.append(chr(value))
        elif kind is kinds.RANGE and value[1] - value[0] < SMALL_CLASS:
            found += map(chr, range(value[0], value[1] + 1))
        else:
            return None
    return "".join(found) if len(found) <= SMALL_CLASS else None


def _expand(sequence, alternatives: set[Alternative]) -> set[Alternative]:
    for kind, value in sequence:
        if kind is kinds.LITERAL:
            alternatives = _grown(alternatives, chr(value))
        elif kind is kinds.IN:
            members = _class_members(value)
            alternatives = _grown(alternatives, members) if members else _closed(alternatives)
        elif kind is kinds.BRANCH:
            alternatives = set().union(*(_expand(branch, alternatives) for branch in value[1]))
        elif kind is kinds.SUBPATTERN:
            alternatives = _expand(value[-1], alternatives)
        elif kind in (kinds.MAX_REPEAT, kinds.MIN_REPEAT, kinds.POSSESSIVE_REPEAT):
            least, most, item = value
            if (least, most) == (0, 1):
                alternatives = alternatives | _expand(item, alternatives)
            elif least:
                alternatives = _closed(_expand(item, alternatives))
            else:
                alternatives = _closed(alternatives)
        elif kind is not kinds.AT:
            alternatives = _closed(alternatives)
        if len(alternatives) > MOST_ALTERNATIVES:
            # What came before asks for too much detail; asking for less is still right.
            alternatives = {((), "")}
    return alternatives


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """The clauses of an expression, or None where some match needs no trigram at all."""
    clauses = set()
    for runs, _ in _closed(_expand(parser.parse(pattern, re.ASCII), {((), "")})):
        lower = [r.lower() for r in runs]
        clauses.add(frozenset(r[n : n + 3] for r in lower for n in range(len(r) - 2)))
    if frozenset() in clauses:
        return None
    return sorted((c for c in clauses if not any(o < c for o in clauses)), key=sorted)

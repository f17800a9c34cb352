"""A plain encoder to check against: one loop, no Spark."""

from __future__ import annotations

import regex

from tokenloom.functions.chunks import DEFAULT_PATTERN


def split(text: str, pattern: str = DEFAULT_PATTERN) -> list[str]:
    return regex.findall(pattern, text)


Ranks = dict[tuple[bytes, bytes], int]


def ranked(merges: list[tuple[bytes, bytes]]) -> Ranks:
    """Pair to rank; a pair counts with its first rank."""
    ranks: Ranks = {}
    for rank, pair in enumerate(merges):
        ranks.setdefault(pair, rank)
    return ranks


def encode(chunk: str, ranks: Ranks, ids: dict[bytes, int]) -> list[int]:
    """Lowest-rank merging over byte strings."""
    parts = [bytes([b]) for b in chunk.encode()]
    while True:
        known = [(ranks[p], p) for p in zip(parts, parts[1:]) if p in ranks]
        if not known:
            return [ids.get(p, 0) for p in parts]
        pair = min(known)[1]
        merged, i = [], 0
        while i < len(parts):
            if tuple(parts[i : i + 2]) == pair:
                merged.append(parts[i] + parts[i + 1])
                i += 2
            else:
                merged.append(parts[i])
                i += 1
        parts = merged

"""Words, word hashes and shingles of many texts at once, in numpy.

A word is a run of bytes other than space and \\t..\\r. Hashes have 64 bits and do
not depend on machine, process or batch.
"""

from __future__ import annotations

import numpy as np

from tokenloom.llm.arrow import Texts

WIDTH = 5

_U = np.uint64
_random = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _random.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = _U(0x9E3779B97F4A7C15)
_PLACE = _random.integers(1, 2**63, 64, dtype=np.uint64) * _U(2) + _U(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix64 finaliser)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(count: int) -> np.ndarray:
    out = np.full(max(count, 1), _BASE)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS = _powers(4096)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash for each span of bytes; spans are not empty and do not overlap."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    longest = int(lengths.max())
    powers = _POWERS if longest <= len(_POWERS) else _powers(longest)
    terms = _BYTE[data[place + np.repeat(starts, lengths)]] * powers[place]
    return mix(np.add.reduceat(terms, first) + lengths.astype(np.uint64) * _PLACE[0])


class Words:
    """Word spans of some texts: ``starts``, ``ends``, and ``counts`` per text."""

    def __init__(self, texts: Texts, lower: bool = False):
        self.data = _LOWER[texts.data] if lower else texts.data
        inside = ~_SPACE[texts.data]
        edges = texts.offsets[(texts.offsets > 0) & (texts.offsets < len(texts.data))]
        before = np.empty_like(inside)
        before[:1], before[1:] = False, inside[:-1]
        before[edges] = False
        self.starts = np.flatnonzero(inside & ~before)
        after = np.empty_like(inside)
        after[-1:], after[:-1] = False, inside[1:]
        after[edges - 1] = False
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.inside = inside
        self.bounds = np.searchsorted(self.starts, texts.offsets)
        self.counts = np.diff(self.bounds)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends)


def windows(words: np.ndarray, counts: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``width`` words, and the number of windows of each text."""
    per_text = np.maximum(counts - width + 1, 0)
    if len(words) < width:
        return np.zeros(0, np.uint64), per_text
    size = len(words) - width + 1
    sums = np.zeros(size, np.uint64)
    for k in range(width):
        sums += words[k : k + size] * _PLACE[k + 1]
    starts = np.cumsum(counts) - counts
    at = np.repeat(starts - (np.cumsum(per_text) - per_text), per_text) + np.arange(int(per_text.sum()))
    return mix(sums[at]), per_text


def shingles(texts: Texts, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of each text in order, A-Z lower-cased, and their number.

    A text with fewer words than ``width`` has its whole word sequence as its one
    shingle; a text without words has none.
    """
    words = Words(texts, lower=True)
    hashes = words.hashes()
    found, counts = windows(hashes, words.counts, width)
    short = np.flatnonzero((words.counts > 0) & (words.counts < width))
    if not len(short):
        return found, counts
    whole = np.zeros(len(short), np.uint64)
    for n, i in enumerate(short):
        own = hashes[words.bounds[i] : words.bounds[i + 1]]
        whole[n] = (own * _PLACE[1 : len(own) + 1]).sum(dtype=np.uint64) ^ _PLACE[20 + len(own)]
    found = np.insert(found, np.cumsum(counts)[short], mix(whole))
    counts[short] = 1
    return found, counts


def shingle_sets(texts: Texts, width: int = WIDTH) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    found, counts = shingles(texts, width)
    ends = np.cumsum(counts)
    return [np.unique(found[end - count : end]) for end, count in zip(ends, counts, strict=True)]

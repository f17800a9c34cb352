"""A linear-chain conditional random field over word shapes, in numpy.

Every word has a fixed number of features, each one of a few values; a line of words is
a chain. Training maximises the likelihood of labelled lines; decoding finds the best
labels of many lines at once by Viterbi.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

from tokenloom.llm.arrow import Texts
from tokenloom.llm.words import Words, span_hashes

ROUNDS = 250
RATE = 0.1
DECAY = 1e-3

_DIGITS = np.array([0, 1, 2, 3, 4, 5, 5, 6, 6, 6, 7, 7, 7, 8, 8, 8, 9])
_LENGTHS = np.array([0, 0, 1, 2, 3, 4, 4, 5, 5, 5, *[6] * 5, *[7] * 5, *[8] * 10, 9])
_MARKS = np.zeros(256, bool)
_MARKS[[ord(c) for c in ".,;:!?\"'()"]] = True


def _kind(characters: str) -> np.ndarray:
    table = np.zeros(256, np.int32)
    table[[ord(c) for c in characters]] = 1
    return table


_LOWER = _kind("abcdefghijklmnopqrstuvwxyz")
_LOWER[0xC0:] = 1
_COUNTED = {
    "digit": _kind("0123456789"),
    "lower": _LOWER,
    "upper": _kind("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    "at": _kind("@"),
    "dot": _kind("."),
    "dash": _kind("-/"),
    "odd": _kind("#$%=_,&|<>*"),
}
_FIRST = np.full(256, 5)
for _number, _characters in enumerate(("+", "(", "\"'", "0123456789", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")):
    _FIRST[[ord(c) for c in _characters]] = _number


@dataclass(frozen=True)
class Model:
    """labels: 0 is "nothing". weights: by feature value and label. moves: by label and next label."""

    labels: tuple[str, ...]
    keywords: np.ndarray
    weights: np.ndarray
    moves: np.ndarray


def core_spans(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The words' spans without one mark at each end, where more than that is there."""
    starts, ends = words.starts, words.ends
    front = _MARKS[words.data[starts]] & (ends - starts > 1) & (words.data[starts] != ord("("))
    starts = starts + front
    back = _MARKS[words.data[ends - 1]] & (ends - starts > 1)
    return starts, ends - back


def _own_values(words: Words, keywords: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """Values of the features of each word by itself, with the number of values each can take."""
    starts, ends = core_spans(words)
    sums = {k: np.concatenate([[0], np.cumsum(t[words.data])]) for k, t in _COUNTED.items()}
    n = {k: s[ends] - s[starts] for k, s in sums.items()}
    size = ends - starts
    digits = _DIGITS[np.minimum(n["digit"], 16)]
    letters = n["lower"] + n["upper"]
    case = np.select([letters == 0, n["upper"] == 0, n["lower"] == 0, n["upper"] == 1], [0, 1, 2, 3], 4)
    dots, dashes = np.minimum(n["dot"], 4), np.minimum(n["dash"], 3)
    first = _FIRST[words.data[starts]]
    length = _LENGTHS[np.minimum(size, len(_LENGTHS) - 1)]
    whole = (n["digit"] == size).astype(np.int64)
    lowered = words.data.copy()
    upper = _COUNTED["upper"][lowered] == 1
    lowered[upper] += 32
    at = np.searchsorted(keywords, own := span_hashes(lowered, starts, ends))
    at = np.minimum(at, max(len(keywords) - 1, 0))
    keyword = np.where(keywords[at] == own, at + 1, 0) if len(keywords) else np.zeros(len(own), np.int64)
    return [
        (digits, 10),
        (keyword, len(keywords) + 1),
        (digits * 5 + dots, 50),
        (digits * 4 + dashes, 40),
        (first * 10 + digits, 60),
        (whole * 10 + length, 20),
        (np.minimum(n["at"], 2) * 5 + dots, 15),
        (case, 5),
        (np.minimum(n["odd"], 2) * 5 + case, 15),
    ]


CONTEXT = 2  # the first features also count for the neighbours


def features(texts: Texts, words: Words, keywords: np.ndarray) -> tuple[np.ndarray, int]:
    """Feature numbers (words x features) and how many numbers there are. Each text is one line."""
    own = _own_values(words, keywords)
    columns, offset = [], 0
    for values, size in own:
        columns.append(values + offset)
        offset += size
    starts = np.zeros(len(words.starts), bool)
    starts[words.bounds[:-1][words.counts > 0]] = True
    for values, size in own[:CONTEXT]:
        before = np.concatenate([[0], values[:-1]])
        columns.append(np.where(starts, size, before) + offset)
        offset += size + 1
        after = np.concatenate([values[1:], [0]])
        last = np.concatenate([starts[1:], [True]])[: len(values)]
        columns.append(np.where(last, size, after) + offset)
        offset += size + 1
    return np.stack(columns, 1) if columns else np.zeros((0, 0), np.int64), offset


def _padded(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of consecutive values, filled up to one length; and which places are real."""
    real = np.arange(int(counts.max(initial=0)))[None, :] < counts[:, None]
    out = np.zeros((*real.shape, *values.shape[1:]))
    out[real] = values
    return out, real


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


def train(lines: Sequence[str], tags: Sequence[Sequence[int]], labels: Sequence[str], keywords: Sequence[str]) -> Model:
    """Fit by gradient steps (Adam) on the penalised likelihood; the same input gives the same model.

    ``tags`` has the label of every word of every line.
    """
    import pyarrow as pa

    spelt = Texts(pa.array(sorted(set(keywords)), pa.string()))
    known = np.sort(span_hashes(spelt.data, spelt.offsets[:-1], spelt.offsets[1:]))
    texts = Texts(pa.array(lines, pa.string()))
    words = Words(texts)
    numbers, size = features(texts, words, known)
    gold = np.concatenate([np.asarray(t, np.int64) for t in tags])
    kinds = len(labels)
    weights, moves = np.zeros((size, kinds)), np.zeros((kinds, kinds))
    starts = np.zeros(len(gold), bool)
    starts[words.bounds[:-1][words.counts > 0]] = True
    seen = np.zeros_like(weights)
    np.add.at(seen, (numbers, gold[:, None]), 1)
    pairs = np.zeros_like(moves)
    np.add.at(pairs, (gold[:-1][~starts[1:]], gold[1:][~starts[1:]]), 1)
    first = [np.zeros_like(weights), np.zeros_like(moves)]
    second = [np.zeros_like(weights), np.zeros_like(moves)]
    for round_ in range(1, ROUNDS + 1):
        scores, real = _padded(weights[numbers].sum(1), words.counts)
        share, between = _expected(scores, real, moves)
        expected = np.zeros_like(weights)
        for k in range(numbers.shape[1]):
            np.add.at(expected, numbers[:, k], share[real])
        steps = (seen - expected - DECAY * len(lines) * weights, pairs - between - DECAY * len(lines) * moves)
        for n, (value, step) in enumerate(zip((weights, moves), steps, strict=True)):
            first[n] = 0.9 * first[n] + 0.1 * step
            second[n] = 0.99 * second[n] + 0.01 * step * step
            value += RATE * (first[n] / (1 - 0.9**round_)) / (np.sqrt(second[n] / (1 - 0.99**round_)) + 1e-8)
    return Model(tuple(labels), known, weights, moves)


def _expected(scores: np.ndarray, real: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of each label at each place, and expected number of moves (forward and backward sums)."""
    lines, places, kinds = scores.shape
    ahead = np.zeros_like(scores)
    back = np.zeros_like(scores)
    ahead[:, 0] = scores[:, 0]
    for t in range(1, places):
        step = _log_sum(ahead[:, t - 1, :, None] + moves, 1) + scores[:, t]
        ahead[:, t] = np.where(real[:, t, None], step, ahead[:, t - 1])
    for t in range(places - 2, -1, -1):
        step = _log_sum(moves + (scores[:, t + 1] + back[:, t + 1])[:, None, :], 2)
        back[:, t] = np.where(real[:, t + 1, None], step, 0)
    total = _log_sum(ahead[:, -1], 1)
    share = np.exp(ahead + back - total[:, None, None]) * real[:, :, None]
    between = np.zeros_like(moves)
    for t in range(1, places):
        joint = ahead[:, t - 1, :, None] + moves + (scores[:, t] + back[:, t])[:, None, :] - total[:, None, None]
        between += (np.exp(joint) * real[:, t, None, None]).sum(0)
    return share, between


def decode(model: Model, texts: Texts, words: Words) -> np.ndarray:
    """The best label of every word; each text is one line.

    Lines are decoded side by side, longest first, so each step works on those that go on.
    """
    numbers, _ = features(texts, words, model.keywords)
    if not len(numbers):
        return np.zeros(0, np.int64)
    scores = np.zeros((len(numbers), len(model.labels)))
    for k in range(numbers.shape[1]):
        scores += model.weights[numbers[:, k]]
    order = np.argsort(-words.counts, kind="stable")
    counts, begins = words.counts[order], words.bounds[:-1][order]
    came = np.zeros((len(numbers), len(model.labels)), np.int8)
    best = scores[begins[counts > 0]].copy()
    finals = np.zeros((len(order), len(model.labels)))
    finals[: len(best)] = best
    for t in range(1, int(counts[0])):
        going = int(np.searchsorted(-counts, -t, "left"))
        at = begins[:going] + t
        paths = finals[:going, :, None] + model.moves
        came[at] = paths.argmax(1)
        finals[:going] = paths.max(1) + scores[at]
    out = np.zeros(len(numbers), np.int64)
    label = finals.argmax(1)
    for t in range(int(counts[0]) - 1, -1, -1):
        going = int(np.searchsorted(-counts, -t, "left"))
        at = begins[:going] + t
        out[at] = label[:going]
        label[:going] = came[at, label[:going]]
    return out

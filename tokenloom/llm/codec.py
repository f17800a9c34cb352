"""BPE encoding and decoding in numpy: merge rounds over the symbols of many words at once.

A text is cut at its special tokens, then coarsely where white space begins, which no
word crosses. A coarse piece seen before has its ids at hand; new pieces of a batch are
split into words by the vocabulary's pattern and merged together: all their symbols
lie in one flat array, each round looks up the rank of every neighbouring pair by
binary search over the sorted pair keys, and merges in each word its lowest-ranked
pair, every occurrence from left to right. Words without a pair left drop out.

The pieces at hand are bounded in number and bytes, so memory does not grow with the
corpus; a piece that was dropped is merged again.

A word above ``LONG_WORD`` symbols would need a round for nearly every one of its merges, so
it is merged by a heap of its pairs instead, with the same result.

Nulls and odd input: a null text is empty and has no ids. A text may be one huge word or
one run of white space. Unknown ids decode to
nothing; bytes that are no UTF-8 decode to U+FFFD.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from tokenloom.llm import bpe
from tokenloom.llm.arrow import map_texts, quoted
from tokenloom.operators.merging import rank_merger

AT_HAND = 200_000
LONGEST_AT_HAND = 64
LONG_WORD = 2048

# Unicode's White_Space characters.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
COARSE = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]")


class PairTable:
    """Rank and merged id of a pair of ids, by binary search over sorted keys."""

    def __init__(self, merges: np.ndarray):
        keys = (merges[:, 0] << 32) | merges[:, 1]
        _, first = np.unique(keys, return_index=True)
        self.keys = keys[first]
        self.ranks = first
        self.merged = merges[first, 2]

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged id of each pair; the number of merges stands for no rank."""
        none = len(self.ranks)
        if not none:
            return np.full(len(left), none), np.zeros(len(left), np.int64)
        wanted = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, wanted), none - 1)
        known = self.keys[at] == wanted
        return np.where(known, self.ranks[at], none), self.merged[at]

    @cached_property
    def by_pair(self) -> dict[tuple[int, int], tuple[int, int]]:
        pairs = zip((self.keys >> 32).tolist(), (self.keys & 0xFFFFFFFF).tolist(), strict=True)
        return dict(zip(pairs, zip(self.ranks.tolist(), self.merged.tolist(), strict=True), strict=True))


def merge_words(symbols: np.ndarray, lengths: np.ndarray, table: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the words whose byte ids lie one after the other in ``symbols``, and their numbers.

    Words are not empty.
    """
    none = len(table.ranks)
    done: list[tuple[np.ndarray, np.ndarray]] = []  # word and id of every finished symbol
    word = np.repeat(np.arange(len(lengths)), lengths)
    ends = np.cumsum(lengths)
    huge = np.flatnonzero(lengths > LONG_WORD)
    if len(huge):
        merge = rank_merger()
        for k in huge:
            ids = np.array(merge(symbols[ends[k] - lengths[k] : ends[k]].tolist(), table.by_pair), np.int64)
            done.append((np.full(len(ids), k), ids))
        rest = ~np.isin(word, huge)
        symbols, word = symbols[rest], word[rest]
    while len(symbols):
        inner = word[:-1] == word[1:]
        rank = np.full(len(symbols), none)
        merged = np.zeros(len(symbols), np.int64)
        rank[:-1][inner], merged[:-1][inner] = table.find(symbols[:-1][inner], symbols[1:][inner])
        starts = np.flatnonzero(np.concatenate([[True], ~inner]))
        sizes = np.diff(np.concatenate([starts, [len(symbols)]]))
        lowest = np.repeat(np.minimum.reduceat(rank, starts), sizes)
        live = lowest < none
        if not live.all():
            done.append((word[~live], symbols[~live]))
            symbols, word, rank, merged, lowest = (x[live] for x in (symbols, word, rank, merged, lowest))
            if not len(symbols):
                break
        chosen = rank == lowest
        # In a run of overlapping choices (pairs of equal symbols) every second one is left out.
        index = np.arange(len(chosen))
        begin = np.maximum.accumulate(np.where(chosen & ~np.concatenate([[False], chosen[:-1]]), index, -1))
        chosen &= (index - begin) % 2 == 0
        symbols = np.where(chosen, merged, symbols)
        stays = ~np.concatenate([[False], chosen[:-1]])
        symbols, word = symbols[stays], word[stays]
    words = np.concatenate([d[0] for d in done]) if done else np.zeros(0, np.int64)
    ids = np.concatenate([d[1] for d in done]) if done else np.zeros(0, np.int64)
    order = np.argsort(words, kind="stable")
    return ids[order], np.bincount(words, minlength=len(lengths))


def gather(store: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The slices of ``store`` that begin at ``starts``, one after the other."""
    total = int(lengths.sum())
    shift = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    return store[np.arange(total) + shift]


class Codec:
    """Encodes and decodes batches of texts with one vocabulary."""

    def __init__(self, vocabulary: bpe.ByteBpe):
        import regex

        self.vocabulary = vocabulary
        self.table = PairTable(vocabulary.merges)
        self.fine = regex.compile(bpe.PATTERN)
        special = sorted(vocabulary.special, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        sizes = np.array([len(t) for t in vocabulary.tokens], np.int64)
        self.token_bytes = np.frombuffer(b"".join(vocabulary.tokens), np.uint8)
        self.token_sizes, self.token_starts = sizes, np.cumsum(sizes) - sizes
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.parts: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []
        for text, number in self.vocabulary.special.items():
            self._remember([text], np.array([number]), np.array([1]))

    def _remember(self, pieces: Sequence[str], ids: np.ndarray, counts: np.ndarray) -> None:
        at = len(self.known)
        self.known.update(zip(pieces, range(at, at + len(pieces)), strict=True))
        self.parts.append(ids)
        self.sizes.append(counts)

    def _merged(self, pieces: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of coarse pieces one after the other, and how many each has."""
        words = [self.fine.findall(p) for p in pieces]
        flat = [w.encode("utf-8", "surrogatepass") for found in words for w in found]
        symbols = self.vocabulary.byte_ids[np.frombuffer(b"".join(flat), np.uint8)]
        lengths = np.array([len(w) for w in flat], np.int64)
        ids, counts = merge_words(symbols, lengths, self.table)
        owner = np.repeat(np.arange(len(pieces)), [len(w) for w in words])
        return ids, np.bincount(owner, weights=counts, minlength=len(pieces)).astype(np.int64)

    def encode(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and the number of ids of each text."""
        pieces: list[str] = []
        counts = np.zeros(len(texts), np.int64)
        for n, text in enumerate(texts):
            before = len(pieces)
            if text:
                cut = self.special.split(text) if self.special else [text]
                for k, part in enumerate(cut):
                    if k % 2:
                        pieces.append(part)
                    elif part:
                        pieces += COARSE.findall(part)
            counts[n] = len(pieces) - before
        if len(self.known) > AT_HAND:
            self._forget()
        fresh = [p for p in dict.fromkeys(pieces) if p not in self.known]
        extra = len(self.known)
        if fresh:
            self._remember(fresh, *self._merged(fresh))
        number = np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))
        if len(self.parts) > 1:
            self.parts, self.sizes = [np.concatenate(self.parts)], [np.concatenate(self.sizes)]
        sizes = self.sizes[0]
        starts = np.cumsum(sizes) - sizes
        ids = gather(self.parts[0], starts[number], sizes[number])
        owner = np.repeat(np.arange(len(texts)), counts)
        per_text = np.bincount(owner, weights=sizes[number], minlength=len(texts)).astype(np.int64)
        if fresh and max(map(len, fresh)) > LONGEST_AT_HAND:
            self._drop_long(extra)
        return ids, per_text

    def _drop_long(self, since: int) -> None:
        """Forget long pieces, which seldom come again; ``since``: the first number that may be one."""
        names = list(self.known)
        stays = np.array([n < since or len(p) <= LONGEST_AT_HAND for n, p in enumerate(names)])
        sizes = self.sizes[0]
        kept = np.flatnonzero(stays)
        ids = gather(self.parts[0], (np.cumsum(sizes) - sizes)[kept], sizes[kept])
        self.known = {names[k]: n for n, k in enumerate(kept)}
        self.parts, self.sizes = [ids], [sizes[kept]]

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The text of each run of ids; ``counts`` says how many ids it has."""
        known = (ids >= 0) & (ids < len(self.token_sizes))
        safe = np.where(known, ids, 0)
        sizes = np.where(known, self.token_sizes[safe], 0)
        data = gather(self.token_bytes, self.token_starts[safe], sizes).tobytes()
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])]
        return [data[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:], strict=True)]


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """The codec of a vocabulary file, made once per worker process."""
    return Codec(bpe.read_byte_bpe(path))


def encode_texts(docs: DataFrame, path: str, keep: Sequence[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` and the ids of every text."""

    def run(part):
        ids, counts = codec(path).encode(part.column(text).to_pylist())
        offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
        return [pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32)))]

    return map_texts(docs, text, run, "ids array<int>", keep=keep)


def decode_ids(rows: DataFrame, path: str, keep: Sequence[str], ids: str = "ids") -> DataFrame:
    """Columns ``keep`` and the text of every list of ids (null: an empty text)."""

    def run(batches):
        for batch in batches:
            lists = batch.column(ids)
            counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            flat = lists.flatten().fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            texts = codec(path).decode(flat, counts)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(texts, pa.string())], names=[*keep, "text"])

    columns = [*dict.fromkeys([*keep, ids])]
    schema = StructType([*(rows.schema[c] for c in keep), StructField("text", StringType())])
    return rows.select(*(quoted(c) for c in columns)).mapInArrow(run, schema)


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def round_trips(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_tokens and digests of the ids and of the text decoded from them."""

    def run(part):
        coder = codec(path)
        ids, counts = coder.encode(part.column(text).to_pylist())
        ends = np.concatenate([[0], np.cumsum(counts)])
        raw = ids.astype("<u4")
        of_ids = [sha256(raw[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        of_texts = [sha256(t.encode("utf-8")) for t in coder.decode(ids, counts)]
        return [pa.array(counts), pa.array(of_ids, pa.string()), pa.array(of_texts, pa.string())]

    return map_texts(docs, text, run, "n_tokens long, ids_sha256 string, decoded_sha256 string", keep=[key])


def encoded_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The query: every document encoded and decoded again."""
    return round_trips(spark.read.parquet(f"{folder}/documents.parquet"), bpe.default_path())

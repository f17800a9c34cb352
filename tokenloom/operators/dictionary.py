"""The dictionary of distinct chunks, and putting it back onto occurrences.

Each distinct chunk is encoded once. Chunk frequencies are very uneven, so the
way back is split: the dictionary is broadcast whole while it is small, and
beyond that only its frequent chunks are. What is left to the shuffle join
then has no frequent key.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.bounds import chunk_finder, texts_to_split
from tokenloom.functions.chunks import chunk_array
from tokenloom.operators.encode import encode_chunks
from tokenloom.operators.vocabulary import Vocabulary
from tokenloom.plans.sizes import BROADCAST_ROWS, BROADCAST_TEXT_BYTES
from tokenloom.plans.workspace import written

# A chunk is frequent when it makes up at least this share of all occurrences,
# so at most its reciprocal many chunks are.
FREQUENT_SHARE = 1 / 50_000
# Bytes of chunks, with an offset for each, whose distinct ones are found together in a task.
BLOCK_BYTES = 32 << 20


@dataclass(frozen=True)
class Dictionary:
    """``table``: (chunk, n, state, n_tokens), stored; with its measured size."""

    table: DataFrame
    rows: int
    occurrences: int
    text_bytes: int
    broadcast_rows: int = BROADCAST_ROWS
    broadcast_bytes: int = BROADCAST_TEXT_BYTES
    frequent_share: float = FREQUENT_SHARE

    @property
    def fits(self) -> bool:
        return self.rows <= self.broadcast_rows and self.text_bytes <= self.broadcast_bytes

    def frequent(self) -> DataFrame:
        """The chunks above the frequency threshold that stay within the size bound.

        The threshold is raised until they fit. Nothing is lost by that: the
        other chunks take the shuffle join.
        """
        share = self.frequent_share
        while True:
            often = self.table.where(F.col("n") >= share * self.occurrences)
            size = often.agg(F.count("*").alias("rows"), _text_bytes().alias("bytes")).first()
            if size["rows"] <= self.broadcast_rows and size["bytes"] <= self.broadcast_bytes:
                return often
            share *= 4


def _text_bytes():
    per_row = F.octet_length("chunk") + F.octet_length("state") + 32
    return F.coalesce(F.sum(per_row.cast("bigint")), F.lit(0))


def occurrences(
    corpus: DataFrame, key: Sequence[str], vocab: Vocabulary, keep_blank: bool = False
) -> DataFrame:
    """(key.., pos, chunk) of a corpus; with ``keep_blank`` a text without chunks keeps a null row."""
    chunks = chunk_array(F.col("text"), vocab.pattern, vocab.added_texts)
    explode = F.posexplode_outer if keep_blank else F.posexplode
    return corpus.select(*key, explode(chunks).alias("pos", "chunk"))


def count_chunks(corpus: DataFrame, vocab: Vocabulary, by: Sequence[str] = ()) -> DataFrame:
    """Distinct chunks with their frequency, per group if ``by`` is given."""
    if by:
        return occurrences(corpus, by, vocab).groupBy(*by, "chunk").agg(F.count("*").alias("n"))
    find, limit = chunk_finder(corpus.sparkSession, vocab.pattern), BLOCK_BYTES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for _, chunks, _ in find(batch):
                held.append(chunks)
                size += chunks.nbytes
                if size >= limit:
                    yield from counted(held)
                    size = 0
        yield from counted(held)

    def counted(held: list[pa.Array]) -> Iterator[pa.RecordBatch]:
        found = pa.chunked_array(held, pa.string()).value_counts()
        if len(found):
            yield pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], names=["chunk", "n"])
        held.clear()
        pa.default_memory_pool().release_unused()

    parts = texts_to_split(corpus, [], vocab.pattern, vocab.added_texts).mapInArrow(count, "chunk string, n long")
    return parts.groupBy("chunk").agg(F.sum("n").alias("n"))


def build_dictionary(corpus: DataFrame, vocab: Vocabulary) -> Dictionary:
    """Encode every distinct chunk once and store the result."""
    return measured(written(encode_chunks(count_chunks(corpus, vocab), vocab, rounds=True), "dictionary"))


def measured(table: DataFrame) -> Dictionary:
    """A stored dictionary table with its size."""
    size = table.agg(
        F.count("*").alias("rows"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("occurrences"),
        _text_bytes().alias("bytes"),
    ).first()
    return Dictionary(table, size["rows"], size["occurrences"], size["bytes"])


def with_codes(rows: DataFrame, dictionary: Dictionary, columns: Sequence[str]) -> DataFrame:
    """Add dictionary ``columns`` to rows that have a ``chunk``.

    Rows are kept: the columns are null for a null or unknown chunk.
    """
    codes = dictionary.table.select("chunk", *columns)
    if dictionary.fits:
        return rows.join(F.broadcast(codes), "chunk", "left")
    often = dictionary.frequent()
    hit = often.select("chunk", *columns, F.lit(True).alias("hit"))
    near = rows.join(F.broadcast(hit), "chunk", "left").where("hit or chunk is null").drop("hit")
    names = often.select("chunk")
    rest = rows.where(F.col("chunk").isNotNull()).join(F.broadcast(names), "chunk", "left_anti")
    rare = codes.join(F.broadcast(names), "chunk", "left_anti")
    return near.unionByName(rest.join(rare, "chunk", "left"))

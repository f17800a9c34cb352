"""Best-fit packing of tokenized documents by patterns of lengths.

Each document is encoded, gets an end id, and is cut into pieces of at most
``MAX_LENGTH`` tokens if it is longer; only its first piece may be shorter then.
A pattern is a choice of up to ``FEW`` piece lengths that fill a sequence exactly.
How often each is repeated comes from a non-negative least squares fit of all
patterns to the histogram of lengths, rounded down; what is left over is packed
longest first, each piece into the fullest sequence that still takes it.

The driver holds the histogram (``MAX_LENGTH`` counts) and the plan: a list of
patterns with repeat counts, whose size depends on ``MAX_LENGTH`` and not on the
number of documents. Pieces are numbered within their length by counting hash
buckets, so no task sees all pieces of one length, and take the place that the plan
has for that number.

Nulls and odd input: a null or empty text is one piece that holds the end id. A null
id is kept; repeated rows are packed each for itself. An empty table gives an empty
one. Other columns are kept if named.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tokenloom.llm import bpe
from tokenloom.llm.arrow import map_texts, quoted
from tokenloom.plans.workspace import written

MAX_LENGTH = 1024
END_ID = 2
FEW = 3
ROUNDS = 800


def piece_bounds(length: int, longest: int) -> list[tuple[int, int]]:
    """Starts and lengths of the pieces of a document; all but the first are full."""
    first = length % longest or min(length, longest)
    starts = [0, *range(first, length, longest)]
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], length], strict=True)]


def cut_pieces(
    docs: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    longest: int = MAX_LENGTH,
    end_id: int = END_ID,
    with_ids: bool = True,
) -> DataFrame:
    """id, piece, start, length, ids_crc32 and, if wanted, the ids of every piece."""

    def run(part):
        out = []
        for text in part.column("text").to_pylist():
            ids = np.array([*bpe.encode(path, text or ""), end_id], "<u4")
            found = []
            for number, (start, length) in enumerate(piece_bounds(len(ids), longest)):
                own = ids[start : start + length]
                piece = {"piece": number, "start": start, "length": length, "ids_crc32": zlib.crc32(own.tobytes())}
                found.append(piece | ({"ids": own.astype(np.int32)} if with_ids else {}))
            out.append(found)
        fields = [("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
        fields += [("ids", pa.list_(pa.int32()))] if with_ids else []
        return [pa.array(out, pa.list_(pa.struct(fields)))]

    ids = ", ids: array<int>" if with_ids else ""
    schema = f"pieces array<struct<piece: int, start: long, length: long, ids_crc32: long{ids}>>"
    named = docs.select(quoted(key).alias("id"), quoted(text).alias("text"))
    return map_texts(named, "text", run, schema, keep=["id"]).select("id", F.inline("pieces"))


def full_patterns(lengths: np.ndarray, longest: int) -> np.ndarray:
    """All ways to fill a sequence with up to three of the given lengths; rows (a, b, c), 0 for none."""
    have = np.zeros(longest + 1, bool)
    have[lengths] = True
    have[0] = True
    a, b = np.meshgrid(np.arange(longest + 1), np.arange(longest + 1), indexing="ij")
    c = longest - a - b
    good = (a >= b) & (b >= c) & (c >= 0) & have[a] & have[b]
    a, b, c = a[good], b[good], c[good]
    good = have[c]
    return np.stack([a[good], b[good], c[good]], 1)


def fit_counts(patterns: np.ndarray, histogram: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Repeat counts x >= 0 that bring the lengths used closest to the histogram, in least squares.

    Accelerated projected gradient steps; a pattern touches three lengths, so neither
    the matrix nor its square is formed.
    """
    size = len(histogram)

    def used(x):
        total = sum(np.bincount(patterns[:, k], weights=x, minlength=size) for k in range(FEW))
        total[0] = 0
        return total

    def back(r):
        r = r.copy()
        r[0] = 0
        return r[patterns].sum(1)

    if not len(patterns):
        return np.zeros(0)
    v = np.ones(len(patterns))
    for _ in range(20):  # the largest squared singular value, by power iteration
        v = back(used(v / np.linalg.norm(v)))
    step = 1 / (1.05 * np.linalg.norm(v) + 1e-9)
    scale = max(float(histogram.max()), 1.0)
    goal = histogram / scale
    x = y = np.zeros(len(patterns))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(y - step * back(used(y) - goal), 0)
        later = (1 + math.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / later * (new - x)
        moved = np.abs(new - x).max()
        x, t = new, later
        if moved < 1e-9:
            break
    return x * scale


@dataclass(frozen=True)
class Plan:
    """Slots by length: piece numbers from ``first`` on go to sequences from ``sequence`` on, at ``offset``."""

    length: np.ndarray
    first: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int


def plan_packing(histogram: np.ndarray, longest: int = MAX_LENGTH) -> Plan:
    """Place every piece of the histogram (counts by length, the first for length 0)."""
    left = histogram.astype(np.int64).copy()
    groups: list[tuple[tuple[int, ...], int]] = []  # lengths of a sequence, and how many such there are
    if left[longest]:
        groups.append(((longest,), int(left[longest])))
        left[longest] = 0
    patterns = full_patterns(np.flatnonzero(left), longest)
    counts = np.floor(fit_counts(patterns, left) + 1e-6).astype(np.int64)
    for k in np.argsort(-counts, kind="stable"):
        if not counts[k]:
            break
        lengths = tuple(int(n) for n in patterns[k] if n)
        need = {n: lengths.count(n) for n in lengths}
        repeat = min(int(counts[k]), *(int(left[n]) // m for n, m in need.items()))
        if repeat:
            groups.append((lengths, repeat))
            for n, m in need.items():
                left[n] -= repeat * m
    groups += _best_fit(left, longest)
    slots: list[tuple[int, int, int, int]] = []
    taken = np.zeros(longest + 1, np.int64)
    base = 0
    for lengths, repeat in groups:
        offset = 0
        for n in lengths:
            slots.append((n, int(taken[n]), base, offset))
            taken[n] += repeat
            offset += n
        base += repeat
    table = np.array(slots, np.int64).reshape(-1, 4)
    table = table[np.lexsort((table[:, 1], table[:, 0]))]
    return Plan(*table.T, base)


def _best_fit(left: np.ndarray, longest: int) -> list[tuple[tuple[int, ...], int]]:
    """Pack what is left, longest first, each into the fullest open sequence; equal sequences move together."""
    opened: list[dict[tuple[int, ...], int]] = [{} for _ in range(longest + 1)]  # by room, counts by lengths
    for n in range(longest, 0, -1):
        count = int(left[n])
        room = n
        while count and room <= longest:
            if not opened[room]:
                room += 1
                continue
            lengths, have = opened[room].popitem()
            used = min(have, count)
            if have > used:
                opened[room][lengths] = have - used
            grown = (*lengths, n)
            opened[room - n][grown] = opened[room - n].get(grown, 0) + used
            count -= used
            room = room - n if room >= 2 * n else room  # what just took one may take the next
        if count:
            each = longest // n  # a sequence of its own takes as many of this length as fit
            for fill, made in ((each, count // each), (count % each, 1)):
                if fill and made:
                    grown = (n,) * fill
                    room = longest - n * fill
                    opened[room][grown] = opened[room].get(grown, 0) + made
    return [item for group in opened for item in group.items()]


def numbered(pieces: DataFrame) -> DataFrame:
    """Stored pieces with their ``number`` from 0 within all pieces of the same length.

    A bucket is a function of the row, so a task that runs again gives the same numbers.
    """
    total = pieces.count()
    buckets = max(1, math.isqrt(total))
    marked = pieces.withColumn("bucket", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.lit(buckets)))
    counts = marked.groupBy("length", "bucket").count()
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("length", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "bucket").orderBy("id", "piece", "ids_crc32")
    own = marked.withColumn("own", F.row_number().over(within) - 1)
    joined = own.join(counts, ["length", "bucket"])
    return joined.withColumn("number", F.col("before") + F.col("own")).drop("bucket", "before", "own")


def pack(pieces: DataFrame, longest: int = MAX_LENGTH) -> DataFrame:
    """Stored pieces with ``sequence_id`` and ``offset``; every sequence is filled from 0 without gaps."""
    rows = pieces.groupBy("length").count().collect()  # at most ``longest`` rows
    histogram = np.zeros(longest + 1, np.int64)
    for r in rows:
        histogram[r["length"]] = r["count"]
    plan = plan_packing(histogram, longest)
    names = pieces.columns
    bounds = np.searchsorted(plan.length, np.arange(longest + 2))

    def place(batches):
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("number").to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for n in np.unique(length):
                own = length == n
                first = plan.first[bounds[n] : bounds[n + 1]]
                at = bounds[n] + np.searchsorted(first, number[own], "right") - 1
                sequence[own] = plan.sequence[at] + number[own] - plan.first[at]
                offset[own] = plan.offset[at]
            kept = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"]
            )

    schema = StructType([*pieces.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])
    return numbered(pieces).select(*names, "number").mapInArrow(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids and doc_ids of every packed sequence, from packed pieces with their ids.

    A sequence holds at most ``MAX_LENGTH`` ids, so its group is small.
    """
    ordered = F.array_sort(F.collect_list(F.struct("offset", "id", "ids")))
    grouped = packed.groupBy("sequence_id").agg(ordered.alias("parts"))
    return grouped.select("sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.id").alias("doc_ids"))


def packed_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The query: where each piece of each document went."""
    return pack_texts(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder, with_ids=False)


def pack_texts(spark: SparkSession, docs: DataFrame, folder: str, with_ids: bool = True) -> DataFrame:
    """The pipeline's last stage: its documents as packed pieces, with their ids; ``sequences`` puts them together."""
    pieces = written(cut_pieces(docs, bpe.default_path(), with_ids=with_ids), "pieces")
    return pack(pieces).withColumnRenamed("id", "doc_id")

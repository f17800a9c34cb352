"""Compression of vectors to short codes, with codebooks fitted over Hilbert-sorted blocks.

A vector is cut into equal parts; each part position has a codebook, and a code names
the nearest entry of each part's codebook. Codebooks are fitted by Lloyd's rounds over
all vectors, in exact integers.

Rows are stored once in chunks (one per Arrow batch). Within a chunk, the parts of each
position lie flat in the order of a Hilbert curve, cut into blocks of ``BLOCK``; each
block has the box of its smallest and largest components and their sums. In each round
an entry stays on a block's shortlist if its least distance to the box does not exceed
the smallest among all entries' greatest distances to it. A block with one entry on its
shortlist goes there by its sums, unread; the others are compared with their shortlists
by exact integer kernels. So results equal plain Lloyd's rounds, ties included.

At scale: vectors are never shuffled. A round reads the chunks and sends on one row for
each entry of a part and task, combined before they are shuffled; the driver holds the
codebooks. The summed errors of labels are looked up with the heaviest labels apart
(``lookup.find``).

Nulls and odd input: vectors that are null, of another length, or hold a null, NaN or
infinity are dropped. A null id is coded like any other and starts no entry before
others do; of repeated ids the smaller vector comes first. Null labels are one label.
Fewer vectors than entries make smaller codebooks; an empty table gives an empty one.
Other columns play no part.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, LongType, StringType, StructField, StructType

from tokenloom.llm.arrow import quoted
from tokenloom.llm.lookup import find
from tokenloom.llm.vectors import COMPONENTS, floored_means, integer_vectors, joined_numbers, matrix
from tokenloom.plans.workspace import written

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
BLOCK = 32


def hilbert_keys(points: np.ndarray) -> np.ndarray:
    """The place of each point (rows of integers) along a Hilbert curve through their common box.

    Skilling's transformation (2004) of coordinates to the curve's transposed index,
    with as many bits for each coordinate as 62 bits allow.
    """
    count, width = points.shape
    used = min(width, 62)
    bits = max(1, min(16, 62 // max(used, 1)))
    low = points[:, :used].min(0, initial=0) if not count else points[:, :used].min(0)
    span = max(int((points[:, :used] - low).max(initial=0)) + 1, 1)
    shift = max(0, span.bit_length() - bits)
    x = ((points[:, :used] - low) >> shift).astype(np.int64)
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        p = q - 1
        for i in range(used):
            has = (x[:, i] & q) != 0
            swap = np.where(has, 0, (x[:, 0] ^ x[:, i]) & p)
            x[:, 0] ^= np.where(has, p, swap)
            x[:, i] ^= swap
        q >>= 1
    for i in range(1, used):
        x[:, i] ^= x[:, i - 1]
    turn = np.zeros(count, np.int64)
    q = top
    while q > 1:
        turn ^= np.where((x[:, used - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= turn[:, None]
    key = np.zeros(count, np.int64)
    for bit in range(bits - 1, -1, -1):
        for i in range(used):
            key = (key << 1) | ((x[:, i] >> bit) & 1)
    return key


STORED = ("points", "order", "low", "high", "sums")


class Blocks:
    """The parts of one position in a chunk: ``points`` in curve order, ``order`` (their rows), boxes and sums."""

    def __init__(self, points: np.ndarray, order: np.ndarray, low: np.ndarray, high: np.ndarray, sums: np.ndarray, block: int):
        self.points, self.order, self.low, self.high, self.sums = points, order, low, high, sums
        self.starts = np.arange(0, len(points), block)
        self.sizes = np.diff(np.concatenate([self.starts, [len(points)]]))

    @staticmethod
    def sorted(points: np.ndarray, block: int = BLOCK) -> Blocks:
        order = np.argsort(hilbert_keys(points), kind="stable")
        points, starts = points[order], np.arange(0, len(points), block)
        boxes = np.minimum.reduceat(points, starts), np.maximum.reduceat(points, starts)
        return Blocks(points, order, *boxes, np.add.reduceat(points, starts), block)

    def stored(self) -> dict[str, bytes]:
        return {name: _packed(getattr(self, name)) for name in STORED}

    @staticmethod
    def read(row: dict[str, bytes], width: int, block: int) -> Blocks:
        points, order, low, high, sums = (_unpacked(row[name]) if name in row else np.zeros(0, np.int64) for name in STORED)
        return Blocks(points.reshape(-1, width), order, *(a.reshape(-1, width) for a in (low, high, sums)), block)


def shortlists(blocks: Blocks, entries: np.ndarray) -> np.ndarray:
    """Which entries (columns) may be nearest to some point of a block (rows)."""
    low, high = blocks.low[:, None, :], blocks.high[:, None, :]
    outside = np.maximum(np.maximum(low - entries, entries - high), 0)
    least = (outside * outside).sum(2)
    reach = np.maximum(np.abs(entries - low), np.abs(entries - high))
    most = (reach * reach).sum(2)
    return least <= most.min(1, keepdims=True)


def _kernel(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry (the first of several) and squared distance of every point, in integers."""
    best = np.zeros(len(points), np.int64)
    least = np.full(len(points), np.iinfo(np.int64).max)
    for k, entry in enumerate(entries):
        step = points - entry
        distance = np.einsum("ij,ij->i", step, step)
        nearer = distance < least
        best[nearer], least[nearer] = k, distance[nearer]
    return best, least


def _groups(listed: np.ndarray):
    """The distinct shortlists, each with the blocks that have it."""
    rows, which = np.unique(listed, axis=0, return_inverse=True)
    which = which.reshape(-1)
    order = np.argsort(which, kind="stable")
    ends = np.cumsum(np.bincount(which, minlength=len(rows)))
    for n, row in enumerate(rows):
        yield np.flatnonzero(row), order[ends[n - 1] if n else 0 : ends[n]]


def _points_of(blocks: Blocks, chosen: np.ndarray) -> np.ndarray:
    """Places of the points of some blocks."""
    sizes = blocks.sizes[chosen]
    first = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) + np.repeat(blocks.starts[chosen] - first, sizes)


def add_to_sums(blocks: Blocks, entries: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> None:
    """Add every point to the sum and count of its nearest entry."""
    for short, chosen in _groups(shortlists(blocks, entries)):
        if len(short) == 1:
            sums[short[0]] += blocks.sums[chosen].sum(0)
            counts[short[0]] += blocks.sizes[chosen].sum()
            continue
        at = _points_of(blocks, chosen)
        own = short[_kernel(blocks.points[at], entries[short])[0]]
        np.add.at(sums, own, blocks.points[at])
        counts += np.bincount(own, minlength=len(counts))


def nearest_entries(blocks: Blocks, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of every point, in the order of the chunk's rows."""
    code, error = np.zeros(len(blocks.points), np.int64), np.zeros(len(blocks.points), np.int64)
    for short, chosen in _groups(shortlists(blocks, entries)):
        at = _points_of(blocks, chosen)
        own, distance = _kernel(blocks.points[at], entries[short])
        rows = blocks.order[at]
        code[rows], error[rows] = short[own], distance
    return code, error


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers in the narrowest of three widths; the first byte tells which."""
    largest = int(np.abs(numbers).max(initial=0))
    width = 2 if largest < 1 << 15 else 4 if largest < 1 << 31 else 8
    return bytes([width]) + numbers.astype(f"<i{width}").tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<i{data[0]}", offset=1).astype(np.int64)


def chunks(vectors: DataFrame, label: str, parts: int, components: int, block: int = BLOCK) -> DataFrame:
    """Rows of whole batches: lists of ids and labels, and for each part its flat points, their order, boxes and sums."""
    width = components // parts
    schema = StructType(
        [
            StructField("vec_id", ArrayType(vectors.schema["vec_id"].dataType)),
            StructField("label", ArrayType(vectors.schema[label].dataType)),
            *(StructField(name, ArrayType(BinaryType())) for name in STORED),
        ]
    )

    def one(column) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            points = matrix(batch.column("v"), components).reshape(-1, parts, width)
            packed = [Blocks.sorted(points[:, p], block).stored() for p in range(parts)]
            columns = [pa.array([[p[name] for p in packed]], pa.list_(pa.binary())) for name in STORED]
            yield pa.RecordBatch.from_arrays([one(batch.column("vec_id")), one(batch.column(label)), *columns], names=schema.names)

    return vectors.select("vec_id", quoted(label).alias(label), "v").mapInArrow(run, schema)


def _stored_parts(batch: pa.RecordBatch, width: int, block: int):
    """The blocks of every part, for each row of chunks; what a row does not carry stays empty."""
    names = [n for n in STORED if n in batch.schema.names]
    for row in batch.select(names).to_pylist():
        yield [Blocks.read(dict(zip(names, values, strict=True)), width, block) for values in zip(*row.values(), strict=True)]


def entry_sums(stored: DataFrame, books: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Sums and counts of the points of every entry, shaped as the codebooks."""
    parts, entries, width = books.shape

    def run(batches):
        sums, counts = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            for row in _stored_parts(batch, width, block):
                for p, blocks in enumerate(row):
                    add_to_sums(blocks, books[p], sums[p], counts[p])
        part, entry = np.nonzero(counts)
        if len(part):
            yield pa.RecordBatch.from_arrays(
                [pa.array(part * entries + entry), pa.array(counts[part, entry]), *(pa.array(sums[part, entry, k]) for k in range(width))],
                names=names,
            )

    names = ["place", "n", *(f"s{k}" for k in range(width))]
    partial = stored.select("points", "low", "high", "sums").mapInArrow(run, ", ".join(f"{n} long" for n in names))
    # At most one row for each entry of each part.
    rows = partial.groupBy("place").agg(*(F.sum(n).alias(n) for n in names[1:])).collect()
    sums, counts = np.zeros((parts * entries, width), np.int64), np.zeros(parts * entries, np.int64)
    for r in rows:
        counts[r["place"]] = r["n"]
        sums[r["place"]] = [r[f"s{k}"] for k in range(width)]
    return sums.reshape(books.shape), counts.reshape(parts, entries)


def first_books(vectors: DataFrame, parts: int, entries: int, components: int) -> np.ndarray:
    """The parts of the vectors with the smallest ids."""
    rows = vectors.select("vec_id", "v").orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()
    found = np.array([r["v"] for r in rows], np.int64).reshape(len(rows), parts, components // parts)
    return np.ascontiguousarray(found.transpose(1, 0, 2))


def fit(stored: DataFrame, books: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    for _ in range(rounds):
        sums, counts = entry_sums(stored, books)
        width = books.shape[2]
        books = floored_means(sums.reshape(-1, width), counts.reshape(-1), books.reshape(-1, width)).reshape(books.shape)
    return books


def encode(stored: DataFrame, books: np.ndarray, block: int = BLOCK) -> DataFrame:
    """vec_id, label, code (hex, two digits for each part) and error of every vector."""
    parts, entries, width = books.shape
    if entries > 256:
        raise ValueError("a code has two hex digits for each part")
    id_type, label_type = stored.schema["vec_id"].dataType.elementType, stored.schema["label"].dataType.elementType
    schema = StructType(
        [StructField("vec_id", id_type), StructField("label", label_type), StructField("code", StringType()), StructField("error", LongType())]
    )

    def run(batches):
        for batch in batches:
            for n, row in enumerate(_stored_parts(batch, width, block)):
                found = [nearest_entries(blocks, books[p]) for p, blocks in enumerate(row)]
                digits = np.stack([code for code, _ in found], 1).astype(np.uint8).tobytes().hex()
                codes = [digits[at : at + 2 * parts] for at in range(0, len(digits), 2 * parts)]
                error = np.sum([e for _, e in found], 0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id")[n].values, batch.column("label")[n].values, pa.array(codes, pa.string()), pa.array(error)], names=schema.names
                )

    return stored.mapInArrow(run, schema)


def decoded(codes: DataFrame, books: np.ndarray, scale: int = SCALE) -> DataFrame:
    """vec_id and the vector that each code stands for."""
    parts, _, width = books.shape

    def run(batches):
        for batch in batches:
            digits = np.frombuffer(bytes.fromhex("".join(batch.column("code").to_pylist())), np.uint8).reshape(-1, parts)
            flat = books[np.arange(parts), digits].reshape(-1).astype(float) / scale
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * (parts * width))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.ListArray.from_arrays(offsets, pa.array(flat))], names=["vec_id", "vector"])

    schema = StructType([codes.schema["vec_id"], StructField("vector", ArrayType(DoubleType()))])
    return codes.select("vec_id", "code").mapInArrow(run, schema)


def _label_key(label: Column) -> Column:
    """A label as a text; null is a text too."""
    return F.when(label.isNull(), "~").otherwise(F.concat(F.lit("="), label.cast("string")))


def with_label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` (stored) with the summed error of each row's label."""
    rows = coded.withColumn("label_key", _label_key(F.col("label")))
    exact = F.sum(F.col("error").cast("decimal(20,0)")).cast("long")
    totals = written(rows.groupBy("label_key").agg(F.count("*").alias("n"), exact.alias("label_error")), "label-errors")
    return find(rows, totals, ["label_key"], "n", "label_error").drop("label_key")


def compressed(
    table: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    components: int = COMPONENTS,
) -> tuple[DataFrame, np.ndarray]:
    """Stored codes (vec_id, label, code, error) of every vector, and the codebooks (part, entry, component)."""
    if components % parts:
        raise ValueError("the parts of a vector are equal")
    vectors = integer_vectors(table.withColumnRenamed(label, "label"), scale, key, vector, components, keep=("label",))
    stored = written(chunks(vectors, "label", parts, components), "chunks")
    books = first_books(vectors, parts, entries, components)
    if books.shape[1]:
        books = fit(stored, books, rounds)
    return written(encode(stored, books), "codes"), books


def compressed_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """The query: code and error of every vector, its label's summed error, and a digest of the codebooks."""
    coded, books = compressed(spark.read.parquet(f"{folder}/embeddings.parquet"))
    digest = hashlib.sha256(joined_numbers(books).encode()).hexdigest()
    return with_label_errors(coded).select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _sql() -> str:
    """Plain Lloyd's rounds: every part against every entry."""
    width = COMPONENTS // PARTS
    steps = []
    for n in range(ROUNDS + 1):
        steps.append(f"""
a{n} AS MATERIALIZED (
  SELECT row, p, v, e, d FROM (
    SELECT x.row, x.p, x.v, b.e,
           CAST(list_sum(list_transform(range(1, {width + 1}), lambda i: (x.v[i] - b.v[i]) * (x.v[i] - b.v[i]))) AS BIGINT) AS d
    FROM parts x JOIN b{n} b USING (p))
  QUALIFY row_number() OVER (PARTITION BY row, p ORDER BY d, e) = 1)""")
        if n < ROUNDS:
            steps.append(f"""
s{n} AS (
  SELECT p, e, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS m
  FROM (SELECT p, e, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{n}) GROUP BY p, e, i),
m{n} AS (
  SELECT p, e, list((s - ((s % m) + m) % m) // m ORDER BY i) AS v FROM s{n} GROUP BY p, e),
b{n + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.v, b.v) AS v FROM b{n} b LEFT JOIN m{n} m USING (p, e))""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = {COMPONENTS}
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {COMPONENTS}),
parts AS MATERIALIZED (
  SELECT row, p, v[p * {width} + 1 : (p + 1) * {width}] AS v
  FROM kept CROSS JOIN (SELECT unnest(range({PARTS})) AS p)),
firsts AS (SELECT row, row_number() OVER (ORDER BY vec_id, v) - 1 AS e FROM kept ORDER BY vec_id, v LIMIT {ENTRIES}),
b0 AS MATERIALIZED (SELECT p, e, v FROM parts JOIN firsts USING (row)),{",".join(steps)},
coded AS (
  SELECT row, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM a{ROUNDS} GROUP BY row),
digest AS (
  SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{ROUNDS})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN kept USING (row) CROSS JOIN digest
"""


SQL = _sql()

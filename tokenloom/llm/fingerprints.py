"""MinHash fingerprints of documents.

Each of ``PERMUTATIONS`` universal hash functions keeps the least value over a text's
5-word shingles (A-Z lower-cased); the share of equal values estimates the Jaccard
similarity of two shingle sets. The hashing runs in numpy over slices of texts.

``fingerprint_pairs`` compares every text with an edited copy of itself and with the
next document by id. Rows are dealt to ranges of ids, and each range also gets the
first row of the next one, so each task reads its rows once, in order, and no row
travels more than once (but for one more per range).

``similar_documents`` joins fingerprints by bands: documents that agree in a band meet
the smallest id of that bucket, and the pair counts if the Jaccard similarity of the
full sets is high enough. A bucket of n documents makes n - 1 pairs, not all of them.
Where that leaves the members of a bucket in several groups, as documents of one template
are, similar ones may stand behind a smaller unlike one. All members of such buckets go
through the exact prefix filter over full sets (``near``), which compares across groups.

Nulls and odd input: a null text is empty. A text without words has the empty
fingerprint, which is like another such text (1) and unlike any other (0). A text of
fewer than five words has one shingle. Order is by id, nulls first, then text, so
repeated ids and rows have a defined order; a sole document is its own next one. An
empty table gives an empty one. Other columns play no part.
"""

from __future__ import annotations

import base64
import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tokenloom.llm.arrow import Texts, map_texts, quoted, slices
from tokenloom.llm.components import components
from tokenloom.llm.lookup import find
from tokenloom.llm.near import across_families, confirmed, full_sets, in_groups
from tokenloom.llm.words import shingles
from tokenloom.plans.workspace import written

PERMUTATIONS = 128
BAND_ROWS = 4
RANGES_PER_PARTITION = 8

_random = np.random.Generator(np.random.PCG64(77))
_FACTOR = _random.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _random.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64)
_EMPTY = np.uint32(0xFFFFFFFF)


def signatures(texts: list[str]) -> np.ndarray:
    """One row of ``PERMUTATIONS`` minima per text; all ones for a text without words."""
    values, counts = shingles(Texts(pa.array(texts, pa.large_string())))
    out = np.full((len(texts), PERMUTATIONS), _EMPTY)
    filled = np.flatnonzero(counts)
    if len(filled):
        starts = (np.cumsum(counts) - counts)[filled]
        hashed = np.empty_like(values)
        for k in range(PERMUTATIONS):
            # Multiply-shift: the high half of a * x + b, with a odd.
            np.multiply(values, _FACTOR[k], out=hashed)
            np.add(hashed, _SHIFT[k], out=hashed)
            out[filled, k] = np.minimum.reduceat(hashed, starts) >> np.uint64(32)
    return out


def spelt(signature: np.ndarray) -> str:
    return base64.b64encode(signature.astype("<u4").tobytes()).decode()


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).mean(axis=1)


def edited(text: str, following: str) -> str:
    """The last half of the characters replaced by the first as many of the next text, or all it has."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _range_of(bounds: list, ident: Column) -> Column:
    """The number of bounds at or below ``ident`` (0 for null), looked up in two steps."""
    if not bounds:
        return F.lit(0)
    step = math.isqrt(len(bounds)) + 1
    parts = [bounds[n : n + step] for n in range(0, len(bounds), step)]
    tops = F.array(*(F.lit(p[0]) for p in parts))
    rest = F.array(*(F.array(*map(F.lit, p)) for p in parts))
    top = F.size(F.filter(tops, lambda b: b <= ident))
    within = F.size(F.filter(F.get(rest, top - 1), lambda b: b <= ident))
    return F.when(top > 0, (top - 1) * step + within).otherwise(0)


def in_order(docs: DataFrame) -> DataFrame:
    """part, extra, id, text: ranges of ids in order, each closed by the first row of the next (``extra``).

    The driver holds one id per range, a fixed number for each partition.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = partitions * RANGES_PER_PARTITION
    shares = [n / ranges for n in range(1, ranges)]
    found = docs.select(F.percentile_approx("id", shares, 10 * ranges).alias("bounds")).first()[0]
    bounds = sorted({b for b in found or [] if b is not None})
    marked = docs.withColumn("own", _range_of(bounds, F.col("id")))
    firsts = marked.groupBy("own").agg(F.min(F.struct("id")).alias("first")).orderBy("own").collect()
    closing = [(r["first"]["id"], firsts[n - 1]["own"]) for n, r in enumerate(firsts)]
    schema = f"first {docs.schema['id'].dataType.simpleString()}, target int"
    closed = F.broadcast(spark.createDataFrame(closing, schema))
    joined = marked.join(closed, F.col("id").eqNullSafe(F.col("first")), "left")
    places = F.array_compact(
        F.array(
            F.struct(F.col("own").alias("part"), F.lit(False).alias("extra")),
            F.when(F.col("target").isNotNull(), F.struct(F.col("target").alias("part"), F.lit(True).alias("extra"))),
        )
    )
    dealt = joined.select("id", "text", F.inline(places))
    return dealt.repartition(partitions, "part").sortWithinPartitions("part", "extra", "id", "text")


SCHEMA = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def fingerprint_pairs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """id and the columns of ``SCHEMA`` for every row."""
    named = docs.select(quoted(key).alias("id"), F.coalesce(quoted(text), F.lit("")).alias("text"))

    def run(batches):
        held = None  # the last row so far: part, extra, id, text, signature
        for batch in batches:
            for rows in slices(batch, "text"):
                texts = rows.column("text").to_pylist()
                own = signatures(texts)
                now = list(
                    zip(
                        rows.column("part").to_pylist(),
                        rows.column("extra").to_pylist(),
                        rows.column("id").to_pylist(),
                        texts,
                        own,
                        strict=True,
                    )
                )
                chain = [*([held] if held else []), *now]
                pairs = [(a, b) for a, b in zip(chain[:-1], chain[1:], strict=True) if not a[1]]
                held = chain[-1]
                if pairs:
                    yield compared(pairs)

    def compared(pairs):
        changed = [edited(a[3], b[3]) for a, b in pairs]
        own, following = np.stack([a[4] for a, _ in pairs]), np.stack([b[4] for _, b in pairs])
        other = signatures(changed)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([a[2] for a, _ in pairs], kind),
                pa.array([len(a[3]) for a, _ in pairs], pa.int64()),
                pa.array([hashlib.sha256(c.encode("utf-8")).hexdigest() for c in changed]),
                pa.array([spelt(s) for s in own]),
                pa.array([spelt(s) for s in other]),
                pa.array(likeness(own, other)),
                pa.array(likeness(own, following)),
            ],
            names=names,
        )

    kind = to_arrow_type(named.schema["id"].dataType)
    names = ["id", *(part.split()[0] for part in SCHEMA.split(", "))]
    return in_order(named).mapInArrow(run, f"id {named.schema['id'].dataType.simpleString()}, {SCHEMA}")


def fingerprinted_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The query: fingerprints of every document and of its edited text."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return fingerprint_pairs(docs).withColumnRenamed("id", "doc_id")


def banded(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """id and bands: one hash for every ``BAND_ROWS`` values of the fingerprint; texts without words have none."""

    def run(part):
        texts = part.column("text").to_pylist()
        own = signatures([t or "" for t in texts])
        blocks = own.astype(np.uint64).reshape(len(texts), -1, BAND_ROWS)
        weights = _FACTOR[:BAND_ROWS]
        bands = (blocks * weights).sum(2, dtype=np.uint64).view(np.int64)
        empty = (own == _EMPTY).all(axis=1)
        return [pa.array([[] if e else b for e, b in zip(empty, bands, strict=True)], pa.list_(pa.int64()))]

    named = docs.select(quoted(key).alias("id"), quoted(text).alias("text"))
    return map_texts(named, "text", run, "bands array<long>", keep=["id"])


def similar_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """a, b: links between documents whose sets are similar enough.

    All are true, and documents that share a band and are similar are connected by them.
    """
    bands = written(banded(docs, key, text).where("id IS NOT NULL"), "bands")
    entries = bands.select("id", F.posexplode("bands").alias("band", "value"))
    leaders = entries.groupBy("band", "value").agg(F.min("id").alias("leader"), F.count("*").alias("n")).where("n > 1")
    met = find(entries, written(leaders, "leaders"), ["band", "value"], "n", "leader").where("leader IS NOT NULL")
    met = written(met, "buckets")
    pairs = met.where("id <> leader").select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct()
    sets = written(full_sets(docs, written(met.select(F.col("id").alias("rep")).distinct(), "ends"), key, text), "sets")
    found = written(confirmed(pairs, sets), "confirmed")

    groups = written(components(found), "groups")
    members = written(in_groups(met, groups, "id", "group"), "bucket-groups")
    spans = members.groupBy("band", "value").agg(F.min("group").alias("first"), F.max("group").alias("last"), F.count("*").alias("n"))
    mixed = written(spans.where("first <> last").select("band", "value", "n", F.lit(True).alias("mixed")), "mixed-buckets")
    behind = find(members, mixed, ["band", "value"], "n", "mixed").where("mixed")
    families = behind.select(F.col("id").alias("rep"), F.col("group").alias("family")).distinct()
    more = confirmed(across_families(written(families, "families"), sets, groups), sets)
    return found.union(more)

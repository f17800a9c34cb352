"""Mixing sources to target weights by fitting a word budget to counts of document lengths.

A document's size is its number of words. Sources in order of their names share the
corpus's words by ``WEIGHTS``, repeated in turn; no target exceeds ``MOST`` times its
source's words, and what is cut off there is shared again by weight until none is above.

A source whose target holds all its words several times takes each document that often.
The rest of its budget is a subset sum over lengths: of the documents of each length, a
proportional number is taken, rounded down, and the words still missing are met by
bounded-knapsack dynamic programming over what is left of each length. Which documents
of a length are taken is decided by a seeded hash.

At scale: only (source, length) counts are grouped by source, at most one row for each
length there is. The driver sees totals. Documents are ranked in buckets of their hash,
and only those of a bucket that is taken in part are ordered, so no task sees all
documents of one source or length; equal rows are one row with a count there. Sources
that hold a large share of all rows are looked up apart (``lookup.find``).

Nulls and odd input: a null text has no words; a document without words is taken 0
times. A null source is a source of its own, after all others. A null id is an id like
any other. Repeated rows are each a document of their own, and which of them is taken
makes no difference. A corpus without words has targets of 0; an empty table gives an
empty one. Other columns play no part.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tokenloom.llm.arrow import quoted
from tokenloom.llm.lookup import find
from tokenloom.plans.workspace import written

WEIGHTS = (5, 2, 1)
MOST = 3
SEED = 20240311
# Up to this many words (and one document more) are left to dynamic programming.
LEFT = 1 << 16
NAMES_PER_PART = 100_000

WORD = r"[^\x20\x09-\x0D]++"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def sized_documents(docs: DataFrame, key: str, text: str, source: str, seed: int) -> DataFrame:
    """id, source (a text, for null too), size and a seeded hash of every row. The result is stored."""
    name = F.when(quoted(source).isNull(), "~").otherwise(F.concat(F.lit("="), quoted(source).cast("string")))
    return written(
        docs.select(
            quoted(key).alias("id"),
            name.alias("source"),
            word_count(quoted(text)).alias("size"),
            F.xxhash64(F.lit(seed), quoted(key), quoted(text)).alias("hash"),
        ),
        "sizes",
    )


def ranked_sources(sources: DataFrame) -> DataFrame:
    """``sources`` with ``rank``: 0, 1, ... by code point, null last ("~" comes after "=")."""
    parts = 1 + sources.count() // NAMES_PER_PART
    ordered = sources.repartitionByRange(parts, "source").sortWithinPartitions("source")
    part = F.spark_partition_id()
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    # Stored, so that parts and places are those of one sort.
    placed = written(ordered.select("*", part.alias("part"), place.alias("place")), "ordered-sources")
    sizes = sorted((r["part"], r["n"]) for r in placed.groupBy("part").agg(F.count("*").alias("n")).collect())
    before = np.concatenate([[0], np.cumsum([n for _, n in sizes])])
    table = placed.sparkSession.createDataFrame([(p, int(b)) for (p, _), b in zip(sizes, before)], "part int, before long")
    # One row for every ``NAMES_PER_PART`` sources.
    return placed.join(F.broadcast(table), "part").select(*sources.columns, (F.col("before") + F.col("place")).alias("rank"))


def with_targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Stored ``sources`` (source, words, rank) with ``target``."""
    turn = F.pmod(F.col("rank"), F.lit(len(weights)))
    weight = F.element_at(F.array(*map(F.lit, weights)), turn.cast("int") + 1)
    table = written(sources.withColumn("weight", weight.cast("long")).withColumn("cap", most * F.col("words")), "weighed-sources")
    total = table.agg(F.sum("words")).first()[0] or 0
    share, capped = 0.0, -1  # words per unit of weight, and how many sources are at their cap
    while True:
        above = F.col("cap") < share * F.col("weight")
        now = table.agg(
            F.count_if(above).alias("capped"),
            F.coalesce(F.sum(F.when(above, F.col("cap"))), F.lit(0)).alias("held"),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)).alias("open"),
        ).first()
        if now["capped"] == capped or not now["open"]:
            break
        share, capped = (total - now["held"]) / now["open"], now["capped"]
    return table.withColumn("target", F.least(F.col("cap").cast("double"), share * F.col("weight")))


def fill(lengths: np.ndarray, spare: np.ndarray, budget: int) -> np.ndarray:
    """How many of each length (distinct, above 0; at most ``spare``) to take so that their sum is nearest to ``budget``.

    Bounded knapsack over sums up to twice the budget: each length's spare documents
    come in groups of 1, 2, 4, ..., and a sum remembers the group that reached it first.
    """
    taken = np.zeros(len(lengths), np.int64)
    if budget <= 0:
        return taken
    top = 2 * budget
    reached = np.zeros(top + 1, bool)
    reached[0] = True
    by = np.full(top + 1, -1, np.int32)  # the group that reached a sum
    groups: list[tuple[int, int]] = []
    for at in np.argsort(-lengths, kind="stable"):
        n, left, size = int(lengths[at]), int(min(spare[at], top // lengths[at])), 1
        while left and not reached[budget]:
            size = min(size, left)
            step = size * n
            if step > top:
                break
            new = np.zeros(top + 1, bool)
            new[step:] = reached[:-step] & ~reached[step:]
            by[new] = len(groups)
            groups.append((at, size))
            reached |= new
            left -= size
            size *= 2
        if reached[budget]:
            break
    sums = np.flatnonzero(reached)
    best = int(sums[np.argmin(np.abs(sums - budget))])
    while best:
        at, size = groups[by[best]]
        taken[at] += size
        best -= size * int(lengths[at])
    return taken


def chosen_counts(lengths: np.ndarray, counts: np.ndarray, target: float, left: int = LEFT, most: int = MOST) -> tuple[int, np.ndarray]:
    """How often every document is taken, and how many of each length are taken once more."""
    lengths, counts = lengths.astype(np.int64), counts.astype(np.int64)
    words = int((lengths * counts).sum())
    budget = round(target)
    full = min(most, budget // words) if words else 0
    extra = np.zeros(len(lengths), np.int64)
    rest = budget - full * words
    real = np.flatnonzero(lengths > 0)
    if full == most or rest <= 0 or not len(real):
        return full, extra
    for at in real:
        extra[at] = int(counts[at]) * rest // words
    rest -= int((lengths * extra).sum())
    for at in real[np.argsort(-lengths[real], kind="stable")]:
        if rest <= left:
            break
        more = min(int(counts[at] - extra[at]), (rest - left) // int(lengths[at]))
        extra[at] += more
        rest -= more * int(lengths[at])
    extra[real] += fill(lengths[real], counts[real] - extra[real], rest)
    return full, extra


def fitted(histogram: DataFrame, targets: DataFrame) -> DataFrame:
    """source, size, n, words, target, full, extra for every length of every source. The result is stored."""

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        full, extra = chosen_counts(rows["size"].to_numpy(), rows["n"].to_numpy(), float(rows["target"].iloc[0]))
        return rows.assign(full=np.int64(full), extra=extra)

    joined = histogram.join(targets.select("source", "words", "target"), "source")
    schema = "source string, size long, n long, words long, target double, full long, extra long"
    return written(joined.groupBy("source").applyInPandas(fit, schema), "length-counts")


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    seed: int = SEED,
) -> DataFrame:
    """id, size, source_size, target and ``copies`` (how often the mix takes it) for every row."""
    sized = sized_documents(docs, key, text, source, seed)
    histogram = written(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "lengths")
    sources = histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("words"))
    plan = fitted(histogram, with_targets(ranked_sources(written(sources, "sources")), weights))
    plan = plan.withColumn("plan", F.struct("n", "words", "target", "full", "extra"))
    rows = find(sized, plan.select("source", "size", "n", "plan"), ["source", "size"], "n", "plan")
    planned = written(rows.select("id", "source", "size", "hash", "plan.*"), "planned")

    whole = planned.where("extra = 0 OR extra = n").select(
        "id", "size", "words", "target", (F.col("full") + F.when(F.col("extra") > 0, 1).otherwise(0)).alias("copies")
    )
    part = planned.where("extra > 0 AND extra < n").withColumn("bucket", F.pmod("hash", F.lit(max(1, math.isqrt(sized.count())))))
    counts = part.groupBy("source", "size", "bucket").agg(F.count("*").alias("own"))
    earlier = Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("before", F.coalesce(F.sum("own").over(earlier), F.lit(0)))
    counts = written(counts.withColumn("span", F.struct("own", "before")), "buckets")
    keys = ["source", "size", "bucket"]
    dealt = find(part, counts.select(*keys, "own", "span"), keys, "own", "span")
    room = F.col("extra") - F.col("span.before")
    dealt = dealt.withColumn("room", room).withColumn("own", F.col("span.own"))

    clear = dealt.where("room <= 0 OR room >= own").select(
        "id", "size", "words", "target", (F.col("full") + F.when(F.col("room") > 0, 1).otherwise(0)).alias("copies")
    )
    alike = dealt.where("room > 0 AND room < own").groupBy(*keys, "hash", "id", "words", "target", "full", "room").agg(F.count("*").alias("m"))
    in_order = Window.partitionBy(*keys).orderBy("hash", "id").rowsBetween(Window.unboundedPreceding, -1)
    alike = alike.withColumn("taken", F.least("m", F.greatest(F.lit(0), F.col("room") - F.coalesce(F.sum("m").over(in_order), F.lit(0)))))
    split = alike.select("id", "size", "words", "target", "full", "taken", F.explode(F.sequence(F.lit(1), F.col("m"))).alias("one"))
    split = split.select("id", "size", "words", "target", (F.col("full") + (F.col("one") <= F.col("taken")).cast("long")).alias("copies"))
    every = whole.unionByName(clear).unionByName(split)
    return every.select("id", "size", F.col("words").alias("source_size"), "target", F.col("copies").cast("long").alias("copies"))


def mixed_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The query: what the mix takes of every document."""
    mixed = mix(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "source"))
    return mixed.select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies"
    )


def copied(docs: DataFrame, mixed: DataFrame, key: str = "doc_id") -> DataFrame:
    """The mix itself: every document of ``docs`` (unique ids) as often as it is taken, with its columns."""
    times = mixed.where("copies > 0").select(F.col("id").alias("_mix_id"), F.col("copies").alias("_copies"))
    joined = docs.join(times, quoted(key).eqNullSafe(F.col("_mix_id")))
    return joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*(quoted(c) for c in docs.columns))

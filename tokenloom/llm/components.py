"""Connected components of a graph given as links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.plans.workspace import written


def components(links: DataFrame) -> DataFrame:
    """node, component (its smallest node) for every node of the links ``a``, ``b``.

    Rounds of two steps until nothing changes: every node's larger neighbours are
    linked to its smallest neighbour, then every node's smaller ones are. The number
    of rounds grows with the logarithm of the longest path. Each round is written, so
    no lineage builds up and a lost executor costs no earlier round. Minima combine in
    each task first; a node with very many links makes a skewed join, which adaptive
    execution splits.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = written(edges, "links")
    state = _state(edges)
    while state[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        larger = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = larger.groupBy("u").agg(F.min("v").alias("m"))
        smaller = larger.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(smaller.union(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def _state(edges: DataFrame) -> tuple:
    """What tells two sets of links apart: their number and a sum of hashes."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())

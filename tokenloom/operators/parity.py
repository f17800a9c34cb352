"""Comparing two tokenizations of one corpus."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.ids import first_difference


def parity(a: DataFrame, b: DataFrame, key: Sequence[str] = ("doc_id",)) -> DataFrame:
    """(key.., equal, first_diff, size_a, size_b, side) for every key of either side.

    ``first_diff`` is 1-based; ``side`` names the side a key is missing from
    the other of, or is ``both``. Two tables bucketed by key join in place.
    """
    left = a.select(*key, F.col("ids").alias("ids_a"), F.lit(True).alias("in_a"))
    right = b.select(*key, F.col("ids").alias("ids_b"), F.lit(True).alias("in_b"))
    side = (
        F.when(F.col("in_a").isNull(), "b").when(F.col("in_b").isNull(), "a").otherwise("both")
    )
    return left.join(right, list(key), "full").select(
        *key,
        (F.col("ids_a").eqNullSafe(F.col("ids_b")) & (side == "both")).alias("equal"),
        first_difference(F.col("ids_a"), F.col("ids_b")).alias("first_diff"),
        F.when(F.col("ids_a").isNotNull(), F.size("ids_a")).alias("size_a"),
        F.when(F.col("ids_b").isNotNull(), F.size("ids_b")).alias("size_b"),
        side.alias("side"),
    )


def parity_summary(compared: DataFrame) -> DataFrame:
    """One row: keys compared, equal, different and one-sided."""
    return compared.agg(
        F.count("*").alias("keys"),
        F.count_if("equal").alias("equal"),
        F.count_if(~F.col("equal") & (F.col("side") == "both")).alias("different"),
        F.count_if(F.col("side") == "a").alias("only_a"),
        F.count_if(F.col("side") == "b").alias("only_b"),
    )

"""Left joins on keys of which a few may hold a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEAVY = 10_000
SPLITS = 1000


def find(rows: DataFrame, table: DataFrame, keys: Sequence[str], weight: str, value: str) -> DataFrame:
    """``rows`` with the column ``value`` of ``table``; null where the key is not there.

    ``table`` is stored, has one row for each of its keys, and ``weight`` says how many
    rows look a key up. Keys above 1/``HEAVY`` of all weight are looked up by
    broadcast: there are at most ``HEAVY`` of them, so its size is bounded. The rest
    goes through a shuffle join without a hot key; rows that already have their value
    are dealt out evenly there.
    """
    total = table.agg(F.sum(weight)).first()[0] or 0
    is_heavy = F.col(weight) * HEAVY > F.lit(total)
    heavy = table.where(is_heavy).select(*keys, F.col(value).alias("_heavy"))
    light = table.where(~is_heavy).select(*keys, F.lit(0).alias("_part"), F.col(value).alias("_light"))
    marked = rows.join(F.broadcast(heavy), [*keys], "left")
    spread = 1 + F.pmod(F.xxhash64(*rows.columns), F.lit(SPLITS))
    part = F.when(F.col("_heavy").isNull(), 0).otherwise(spread).cast("int")
    joined = marked.withColumn("_part", part).join(light, [*keys, "_part"], "left")
    return joined.select(*rows.columns, F.coalesce("_heavy", "_light").alias(value))

"""Using the whole cluster on inputs with few splits."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame


def wanted_partitions(df: DataFrame) -> int | None:
    """The number of cores if the scan has fewer splits than that, else None."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return cores if df.rdd.getNumPartitions() < cores else None


def spread(df: DataFrame) -> DataFrame:
    """Deal out rows when the scan has fewer splits than the cluster has cores.

    Splitting text costs far more than moving it once, but only a small input
    has so few splits: on a large one this changes nothing and adds no shuffle.
    """
    partitions = wanted_partitions(df)
    return df.repartition(partitions) if partitions else df


def lies_together(df: DataFrame, key: Sequence[str]) -> bool:
    """Whether rows of one key lie in one task already, as those of a table bucketed by key do.

    It is read from the plan of a grouping, and only a plan is chosen by it.
    """
    grouped = df.groupBy(*key).count()._jdf.queryExecution().executedPlan().toString()
    return not re.search(r"(?<!Broadcast)Exchange ", grouped)

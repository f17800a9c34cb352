"""Written intermediate tables.

They go to the shared folder the cluster names in ``spark.checkpoint.dir``, so
they outlive any executor and cut the lineage behind them.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    context = spark.sparkContext
    folder = spark.conf.get(_SETTING, None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    # Only a session within one JVM gets here: a cluster names its shared folder.
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise RuntimeError(f"set {_SETTING} to a folder every executor can reach")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="tokenloom-")
    return _local_folders[context.applicationId]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/tokenloom/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` once and return the stored table. The default codec keeps buffers of a whole page outside the heap, which counts where rows are large."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)

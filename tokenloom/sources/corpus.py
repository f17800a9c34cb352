"""Text to tokenize: only the key and the text are read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenloom.plans.parallel import spread


def _project(df: DataFrame, key: Sequence[str], text: str, keep: Sequence[str]) -> DataFrame:
    columns: list[Column] = [F.col(c) for c in dict.fromkeys([*key, *keep])]
    return df.select(*columns, F.col(text).alias("text"))


def read_corpus(
    spark: SparkSession,
    path: str,
    key: Sequence[str] = ("doc_id",),
    text: str = "text",
    keep: Sequence[str] = (),
    format: str = "parquet",
) -> DataFrame:
    """The key, the kept columns and the text; the scan reads nothing else."""
    return spread(_project(spark.read.format(format).load(path), key, text, keep))


def stream_corpus(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    key: Sequence[str] = ("doc_id",),
    text: str = "text",
    keep: Sequence[str] = (),
    format: str = "parquet",
    max_files_per_trigger: int | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """The same as a stream of files; ``partitions`` deals out the rows of small batches."""
    reader = spark.readStream.format(format).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = _project(reader.load(path), key, text, keep)
    return rows.repartition(partitions) if partitions else rows

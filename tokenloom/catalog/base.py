"""What a catalog entry is, and the tables it starts from."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.sources.corpus import read_corpus


@dataclass(frozen=True)
class Entry:
    """A runnable query, the SQL that checks it, and what it covers."""

    covers: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def documents(spark: SparkSession, folder: str, keep: Sequence[str] = ()) -> DataFrame:
    return read_corpus(spark, f"{folder}/documents.parquet", ["doc_id"], keep=keep)


def conversations(spark: SparkSession, folder: str, keep: Sequence[str] = ()) -> DataFrame:
    return read_corpus(spark, f"{folder}/conversations.parquet", ["conv_id", "turn"], keep=keep)


def joined(ids: Column) -> Column:
    """Ids as text, so that engines compare them alike."""
    return F.array_join(ids.cast("array<string>"), " ")


def long(column: str) -> Column:
    return F.col(column).cast("bigint").alias(column)

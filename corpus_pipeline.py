"""The corpus pipeline: documents through quality rules, deduplication, redaction and packing.

Each stage is written as Parquet and read again, so no stage is computed twice and a
lost executor costs only the tasks it ran.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tokenloom.catalog.base import Entry
from tokenloom.llm import lines, near, packing, pii, quality
from tokenloom.plans.workspace import written

STAGES = [
    ("quality rules", quality.keep_good),
    ("line dedup", lines.drop_lines),
    ("near dedup", near.keep_first),
    ("pii", pii.redact_documents),
    ("best-fit packing", packing.pack_texts),
]

# Encoding to tokens has no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; returns the packed pieces."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


ENTRY = Entry("pipeline", run, ORACLE_SQL)

"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the number of cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from tokenloom.catalog import ENTRIES  # noqa: E402
from tokenloom.fixtures import vocabulary_64  # noqa: E402

HEADLINE = [
    "tokens_by_lang",
    "tokens_by_lang_by_dictionary",
    "tokens_by_document",
    "tokens_by_document_by_dictionary",
    "chunk_frequencies",
    "chunk_ids_by_literal_sweep",
    "chunk_ids_by_candidate_sweep",
    "chunk_ids_by_candidate_search",
    "document_ids",
    "document_ids_by_dictionary",
    "document_ids_with_shuffled_dictionary",
    "round_trip",
    "round_trip_by_join",
    "neighbour_ids",
    "compared_ids_summary",
    "request_messages",
    "streamed_tokens_by_lang",
    "first_token_ids",
    "resolved_merges",
    "merge_problems",
    "typed_tokens",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        # Encoding is heavy per byte, so small shuffle partitions are kept apart.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # The vocabularies are loaded and the JVM is warmed before the clock starts.
    vocabulary_64(spark)
    vocabulary_64(spark, 32)
    warm = "/root/testdata/sf0.001"
    if os.path.isdir(warm):
        ENTRIES["document_ids"].run(spark, warm).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        start = time.perf_counter()
        ENTRIES[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

"""Writing token ids and request files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_token_ids(tokens: DataFrame, path: str, key: Sequence[str] = ("doc_id",), mode: str = "error") -> None:
    """Parquet rows of (key.., ids, n_tokens, ok)."""
    tokens.select(*key, "ids", "n_tokens", "ok").write.mode(mode).parquet(path)


def save_token_table(tokens: DataFrame, table: str, key: Sequence[str], buckets: int) -> None:
    """A table bucketed by key: comparing or joining two such tables needs no shuffle."""
    (
        tokens.select(*key, "ids", "n_tokens", "ok")
        .write.bucketBy(buckets, *key)
        .sortBy(*key)
        .saveAsTable(table)
    )


def write_requests(requests: DataFrame, path: str, mode: str = "error") -> None:
    """JSON lines, one request body per line."""
    requests.select(F.col("body").alias("value")).write.mode(mode).text(path)

"""Broadcasts only behind a check of what is being broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A broadcast table costs several times its text size in executor memory.
BROADCAST_TEXT_BYTES = 64 << 20
BROADCAST_ROWS = 2_000_000


def hinted(df: DataFrame, rows: int, text_bytes: int) -> DataFrame:
    """``df`` with a broadcast hint if it is within bounds, else left to a shuffle join."""
    if rows <= BROADCAST_ROWS and text_bytes <= BROADCAST_TEXT_BYTES:
        return F.broadcast(df)
    return df

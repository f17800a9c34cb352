"""Message parts and message content."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PART = "struct<type: string, text: string, tokens: array<int>>"


def text_part(text: Column) -> Column:
    return F.struct(
        F.lit("text").alias("type"), text.alias("text"), F.lit(None).cast("array<int>").alias("tokens")
    )


def tokens_part(ids: Column) -> Column:
    return F.struct(
        F.lit("input_tokens").alias("type"), F.lit(None).cast("string").alias("text"), ids.alias("tokens")
    )


def content_json(parts: Column) -> Column:
    """Content of a message as JSON: one lone token run is a bare int array.

    Anything else is an array of typed parts, each with its own field only.
    """
    only = F.try_element_at(parts, F.lit(1))
    lone = (F.size(parts) == 1) & (only["type"] == "input_tokens")
    return F.when(lone, F.to_json(only["tokens"])).otherwise(F.to_json(parts))

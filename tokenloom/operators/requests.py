"""Request bodies as JSON text, one row per request."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.content import content_json


def messages_in_order(
    messages: DataFrame, conversation: Sequence[str] = ("conv_id",), turn: str = "turn"
) -> DataFrame:
    """(conversation.., messages): role and content of every turn, in order.

    ``messages`` has (conversation.., turn, role, parts); a conversation becomes
    one request, so it fits a row.
    """
    each = F.struct(turn, "role", content_json(F.col("parts")).alias("content"))
    gathered = messages.groupBy(*conversation).agg(F.sort_array(F.collect_list(each)).alias("m"))
    return gathered.select(
        *conversation,
        F.transform(
            "m", lambda m: F.struct(m["role"].alias("role"), F.parse_json(m["content"]).alias("content"))
        ).alias("messages"),
    )


def build_requests(
    messages: DataFrame,
    model: str | Column,
    max_tokens: int = 32,
    temperature: float = 0.0,
    stream: bool = False,
    conversation: str = "conv_id",
    turn: str = "turn",
) -> DataFrame:
    """Chat requests (request_id, body)."""
    body = F.struct(
        _column(model).alias("model"),
        F.col("messages"),
        F.lit(max_tokens).alias("max_tokens"),
        F.lit(float(temperature)).alias("temperature"),
        F.lit(stream).alias("stream"),
    )
    return messages_in_order(messages, [conversation], turn).select(
        F.col(conversation).alias("request_id"), F.to_json(body).alias("body")
    )


def build_count_requests(tokens: DataFrame, model: str | Column, key: str = "doc_id") -> DataFrame:
    """Requests that ask a server to count ids (request_id, body)."""
    body = F.struct(_column(model).alias("model"), F.col("ids").alias("input_tokens"))
    return tokens.select(F.col(key).alias("request_id"), F.to_json(body).alias("body"))


def build_tokenize_requests(corpus: DataFrame, add_special: bool = False, key: str = "doc_id") -> DataFrame:
    """Requests that ask a server to tokenize text (request_id, body)."""
    body = F.struct(
        F.col("text").alias("content"),
        F.lit(add_special).alias("add_special"),
        F.lit(True).alias("parse_special"),
    )
    return corpus.select(F.col(key).alias("request_id"), F.to_json(body).alias("body"))


def _column(value: str | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value)

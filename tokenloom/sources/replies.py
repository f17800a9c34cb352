"""Replies of a model server, read from (request_id, status, body) rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reply_tokens(body: Column) -> Column:
    """The ``tokens`` list of a reply; null when there is none or it is malformed."""
    return F.from_json(body, "tokens array<int>")["tokens"]


def reply_count(body: Column) -> Column:
    """The ``input_tokens`` number of a reply; null when there is none."""
    return F.from_json(body, "input_tokens bigint")["input_tokens"]


def reply_error(status: Column, body: Column, action: str = "request") -> Column:
    """Message of a failed request, also without a status or body; null for status 200."""
    code = F.coalesce(status.cast("string"), F.lit("no status"))
    return F.when(
        ~status.eqNullSafe(200),
        F.concat(F.lit(action), F.lit(" returned "), code, F.lit(": "), F.coalesce(body, F.lit("no body"))),
    )


def parse_responses(responses: DataFrame, action: str = "request") -> DataFrame:
    """(request_id, status, tokens, input_tokens, ok, error) of every reply.

    Failed replies are kept, with their status and body in ``error``.
    """
    status, body = F.col("status"), F.col("body")
    good = status == 200
    parsed = responses.select(
        "request_id",
        "status",
        F.when(good, reply_tokens(body)).alias("tokens"),
        F.when(good, reply_count(body)).alias("input_tokens"),
        reply_error(status, body, action).alias("error"),
    )
    ok = F.col("error").isNull() & (F.col("tokens").isNotNull() | F.col("input_tokens").isNotNull())
    return parsed.withColumn("ok", F.coalesce(ok, F.lit(False)))


def match_responses(
    requests: DataFrame, responses: DataFrame, on: Sequence[str] = ("request_id",)
) -> DataFrame:
    """Requests beside their replies; a request without a reply has ``answered`` false."""
    replies = responses.withColumn("answered", F.lit(True))
    return requests.join(replies, list(on), "left").withColumn(
        "answered", F.coalesce("answered", F.lit(False))
    )

"""Queries over requests and replies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.catalog import sql
from tokenloom.catalog.base import Entry, conversations, documents, joined, long
from tokenloom.fixtures import vocabulary_64
from tokenloom.functions.content import text_part, tokens_part
from tokenloom.functions.ids import PREVIEW_CHARS, preview_text
from tokenloom.operators.requests import (
    build_count_requests,
    build_requests,
    build_tokenize_requests,
    messages_in_order,
)
from tokenloom.operators.tokens import tokenize
from tokenloom.plans.workspace import new_path
from tokenloom.sources.replies import match_responses, parse_responses
from tokenloom.sources.sinks import write_requests

# Example request settings.
MODEL = 'model "A"\\1'
MAX_TOKENS = 32

_KEY = ["conv_id", "turn"]


def _turns(spark: SparkSession, folder: str) -> DataFrame:
    """(conv_id, turn, role, text, ids): every turn beside its ids."""
    return tokenize(conversations(spark, folder, ["role"]), vocabulary_64(spark), _KEY, keep=["role", "text"])


def _messages(spark: SparkSession, folder: str) -> DataFrame:
    """User turns carry text and ids; all others are one run of ids."""
    ids = tokens_part(F.col("ids"))
    parts = F.when(F.col("role") == "user", F.array(text_part(F.col("text")), ids)).otherwise(F.array(ids))
    return _turns(spark, folder).select(*_KEY, "role", parts.alias("parts"))


_TURNS_SQL = f"""{sql.rows_of_ids('conversations', 'conv_id, turn')},
    turns AS (SELECT * FROM conversations JOIN tok USING (conv_id, turn)),
    placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS place FROM turns)"""

_CONTENT = "array<struct<type: string, text: string, tokens: array<int>>>"


def request_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Bodies written as JSON lines, read back, one row per message."""
    path = new_path(spark, "requests")
    requests = build_requests(_messages(spark, folder), MODEL, MAX_TOKENS, 0.0, False)
    # Lines of a text file have no order, so each starts with its request id.
    write_requests(requests.select("request_id", F.concat(F.col("request_id").cast("string"), F.lit("\t"), "body").alias("body")), path)
    lines = F.split("value", "\t", 2)
    bodies = spark.read.text(path).select(lines[0].cast("bigint").alias("conv_id"), lines[1].alias("body"))
    parsed = F.from_json(
        "body",
        "model string, messages array<struct<role: string, content: string>>,"
        " max_tokens bigint, temperature double, stream boolean",
    )
    rows = bodies.select("conv_id", parsed.alias("b")).select(
        "conv_id", "b.model", "b.max_tokens", "b.temperature", "b.stream", F.posexplode("b.messages").alias("place", "m")
    )
    bare = F.from_json("m.content", "array<int>")
    parts = F.from_json("m.content", _CONTENT)
    has_parts = F.col("m.content").startswith("[{")
    return rows.select(
        "conv_id",
        long("place"),
        "model",
        "max_tokens",
        "temperature",
        "stream",
        F.col("m.role").alias("role"),
        F.when(has_parts, F.array_join(F.transform(parts, lambda p: p["type"]), "+")).otherwise("bare").alias("kind"),
        F.when(has_parts, parts[0]["text"]).alias("text"),
        F.when(has_parts, joined(F.try_element_at(parts, F.lit(2))["tokens"])).otherwise(joined(bare)).alias("ids"),
    )


REQUEST_MESSAGES_SQL = f"""WITH {_TURNS_SQL}
    SELECT conv_id, place::BIGINT AS place, {sql.quoted(MODEL)} AS model, {MAX_TOKENS}::BIGINT AS max_tokens,
      0.0::DOUBLE AS temperature, false AS stream, role,
      CASE WHEN role = 'user' THEN 'text+input_tokens' ELSE 'bare' END AS kind,
      CASE WHEN role = 'user' THEN text END AS text, ids FROM placed"""


def message_roles(spark: SparkSession, folder: str) -> DataFrame:
    """Roles of every conversation, in turn order."""
    rows = messages_in_order(_messages(spark, folder))
    return rows.select(
        "conv_id",
        F.size("messages").cast("bigint").alias("n_messages"),
        F.array_join(F.transform("messages", lambda m: m["role"]), ",").alias("roles"),
    )


def count_requests(spark: SparkSession, folder: str) -> DataFrame:
    bodies = build_count_requests(tokenize(documents(spark, folder), vocabulary_64(spark)), MODEL)
    parsed = bodies.select("request_id", F.from_json("body", "model string, input_tokens array<int>").alias("b"))
    return parsed.select("request_id", "b.model", joined(F.col("b.input_tokens")).alias("ids"))


def tokenize_requests(spark: SparkSession, folder: str) -> DataFrame:
    bodies = build_tokenize_requests(documents(spark, folder), add_special=True)
    parsed = bodies.select(
        "request_id", F.from_json("body", "content string, add_special boolean, parse_special boolean").alias("b")
    )
    return parsed.select("request_id", "b.*")


def _responses(spark: SparkSession, folder: str) -> DataFrame:
    """Replies as a server might send them.

    A conversation is answered when the assistant speaks in it: with tokens if
    it opens with the user, with a count if the turns are even, else with an error.
    """
    turns = _turns(spark, folder)
    whole = turns.groupBy("conv_id").agg(
        F.min_by("role", "turn").alias("first"),
        F.max_by("text", "turn").alias("last"),
        F.min_by("ids", "turn").alias("ids"),
        F.count("*").alias("n_turns"),
        F.bool_or(F.col("role") == "assistant").alias("answered"),
    )
    kind = F.when(F.col("first") == "user", "tokens").when(F.col("n_turns") % 2 == 0, "count").otherwise("error")
    body = (
        F.when(kind == "tokens", F.to_json(F.struct(F.col("ids").alias("tokens"))))
        .when(kind == "count", F.to_json(F.struct(F.size("ids").alias("input_tokens"))))
        .otherwise(F.col("last"))
    )
    return whole.where("answered").select(
        F.col("conv_id").alias("request_id"),
        F.when(kind == "error", 500).otherwise(200).alias("status"),
        body.alias("body"),
    )


_RESPONSES_SQL = f"""{_TURNS_SQL},
    whole AS (
      SELECT conv_id, arg_min(role, turn) AS first, arg_max(text, turn) AS last, arg_min(ids, turn) AS ids,
        arg_min(n_tokens, turn) AS n, count(*) AS n_turns, bool_or(role = 'assistant') AS answered
      FROM turns GROUP BY conv_id),
    responses AS (
      SELECT conv_id AS request_id, CASE WHEN first = 'user' THEN 'tokens' WHEN n_turns % 2 = 0 THEN 'count' ELSE 'error' END AS kind,
        * FROM whole WHERE answered)"""

_PARSED = """CASE WHEN kind = 'error' THEN 500 ELSE 200 END::BIGINT AS status,
      CASE WHEN kind = 'tokens' THEN ids END AS ids, CASE WHEN kind = 'count' THEN n END::BIGINT AS input_tokens,
      kind <> 'error' AS ok, CASE WHEN kind = 'error' THEN 'request returned 500: ' || last END AS error"""


def _parsed(spark: SparkSession, folder: str) -> DataFrame:
    return parse_responses(_responses(spark, folder)).select(
        "request_id", long("status"), joined(F.col("tokens")).alias("ids"), "input_tokens", "ok", "error"
    )


def parsed_replies(spark: SparkSession, folder: str) -> DataFrame:
    return _parsed(spark, folder)


def answered_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation beside its reply, if there is one."""
    requests = conversations(spark, folder).select(F.col("conv_id").alias("request_id")).distinct()
    return match_responses(requests, _parsed(spark, folder))


def reply_previews(spark: SparkSession, folder: str) -> DataFrame:
    """The start of every reply's body."""
    return _responses(spark, folder).select("request_id", preview_text(F.col("body")).alias("preview"))


ENTRIES: dict[str, Entry] = {
    "request_messages": Entry("SNK2, PRJ15, PRJ16", request_messages, REQUEST_MESSAGES_SQL),
    "message_roles": Entry(
        "AG8",
        message_roles,
        """SELECT conv_id, count(*)::BIGINT AS n_messages, string_agg(role, ',' ORDER BY turn) AS roles
        FROM conversations GROUP BY conv_id""",
    ),
    "count_requests": Entry(
        "SNK2", count_requests, f"WITH {sql.rows_of_ids('documents', 'doc_id')} SELECT doc_id AS request_id, {sql.quoted(MODEL)} AS model, ids FROM tok"
    ),
    "tokenize_requests": Entry(
        "SNK2",
        tokenize_requests,
        "SELECT doc_id AS request_id, text AS content, true AS add_special, true AS parse_special FROM documents",
    ),
    "parsed_replies": Entry("SRC6, PRJ17", parsed_replies, f"WITH {_RESPONSES_SQL} SELECT request_id, {_PARSED} FROM responses"),
    "answered_requests": Entry(
        "JN8",
        answered_requests,
        f"""WITH {_RESPONSES_SQL}, parsed AS (SELECT request_id, {_PARSED} FROM responses)
        SELECT w.conv_id AS request_id, status, p.ids, input_tokens, ok, error, p.request_id IS NOT NULL AS answered
        FROM whole w LEFT JOIN parsed p ON p.request_id = w.conv_id""",
    ),
    "reply_previews": Entry(
        "PRJ14",
        reply_previews,
        f"""WITH {_RESPONSES_SQL}, bodies AS (
          SELECT request_id, CASE kind WHEN 'tokens' THEN '{{"tokens":[' || replace(ids, ' ', ',') || ']}}'
            WHEN 'count' THEN '{{"input_tokens":' || n || '}}' ELSE last END AS body FROM responses)
        SELECT request_id, substr(body, 1, {PREVIEW_CHARS}) AS preview FROM bodies""",
    ),
}

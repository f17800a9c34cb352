"""Vocabulary tables: lookups, merge resolution, checks.

As in the sources, ``by`` holds the columns that name a model, and may be empty.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.alphabet import token_hex
from tokenloom.plans.workspace import written

# Source codes of normal and byte tokens, and the mapped codes.
SOURCE_NORMAL, SOURCE_BYTE = 1, 6
NORMAL, BYTE, SPECIAL = 0, 1, 2


def mapped_type(source_type: Column) -> Column:
    """Byte stays byte, normal stays normal, all else is special; missing is normal."""
    code = F.coalesce(source_type, F.lit(SOURCE_NORMAL))
    return F.when(code == SOURCE_BYTE, BYTE).when(code == SOURCE_NORMAL, NORMAL).otherwise(SPECIAL)


def token_table(tokens: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by.., id, token, tok_hex, token_type, score) from tokens with raw attributes."""
    kind = mapped_type(F.col("source_type"))
    return tokens.select(
        *by,
        "id",
        "token",
        token_hex(F.col("token"), kind == SPECIAL).alias("tok_hex"),
        kind.alias("token_type"),
        F.coalesce(F.col("score").cast("float"), F.lit(0.0).cast("float")).alias("score"),
    )


def first_ids(tokens: DataFrame, by: Sequence[str] = (), text: str = "tok_hex") -> DataFrame:
    """Token text to id; of several entries with one text the first wins."""
    return tokens.groupBy(*by, text).agg(F.min("id").alias("id"))


def ids_for_texts(
    rows: DataFrame, ids: DataFrame, by: Sequence[str] = (), text: str = "tok_hex"
) -> DataFrame:
    """Look texts up; rows whose text is no token keep a null id."""
    return rows.join(ids, [*by, text], "left")


def byte_tokens(tokens: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Tokens that are exactly one byte, as (by.., byte, id); the first id of a byte wins."""
    single = tokens.where(F.length("tok_hex") == 2)
    return single.groupBy(*by, F.conv("tok_hex", 16, 10).cast("int").alias("byte")).agg(
        F.min("id").alias("id")
    )


def ids_for_bytes(rows: DataFrame, bytes_to_id: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Look bytes up: id 0 and ``oov`` true where the vocabulary lacks the byte.

    The lookup side has at most 256 rows per model; only with a single model is
    that small enough to broadcast without asking.
    """
    lookup = bytes_to_id if by else F.broadcast(bytes_to_id)
    joined = rows.join(lookup, [*by, "byte"], "left")
    return joined.withColumn("oov", F.col("id").isNull()).withColumn("id", F.coalesce("id", F.lit(0)))


def _looked_up(merges: DataFrame, ids: DataFrame, by: Sequence[str], text: str) -> DataFrame:
    """Merges with left_id, right_id and merged_id, null where the text is no token."""
    sides = merges.withColumn("merged", F.concat("left", "right"))
    for side in ("left", "right", "merged"):
        lookup = ids.select(*by, F.col(text).alias(side), F.col("id").alias(f"{side}_id"))
        sides = sides.join(lookup, [*by, side], "left")
    return sides


def two_sided(merges: DataFrame) -> DataFrame:
    """Drop merges with an empty side."""
    return merges.where((F.col("left") != "") & (F.col("right") != ""))


def resolve_merges(
    merges: DataFrame, ids: DataFrame, by: Sequence[str] = (), text: str = "tok_hex"
) -> DataFrame:
    """Merges as ids (by.., rank, left_id, right_id, merged_id).

    ``left``, ``right`` and the token text must be in one spelling. Merges
    with an empty side or an unknown text are dropped; `unresolved_merges`
    lists them.
    """
    found = two_sided(merges).withColumn("merged", F.concat("left", "right"))
    for side in ("left", "right", "merged"):
        lookup = ids.select(*by, F.col(text).alias(side), F.col("id").alias(f"{side}_id"))
        found = found.join(lookup, [*by, side])
    return found.select(*by, "rank", "left_id", "right_id", "merged_id")


def _with_reason(
    merges: DataFrame, ids: DataFrame, by: Sequence[str], text: str
) -> DataFrame:
    """Merges with their ids and the first reason that keeps one from resolving."""
    reason = (
        F.when((F.col("left") == "") | (F.col("right") == ""), "empty side")
        .when(F.col("left_id").isNull(), "left")
        .when(F.col("right_id").isNull(), "right")
        .when(F.col("merged_id").isNull(), "merged")
    )
    return _looked_up(merges, ids, by, text).withColumn("reason", reason)


def unresolved_merges(
    merges: DataFrame, ids: DataFrame, by: Sequence[str] = (), text: str = "tok_hex"
) -> DataFrame:
    """What `resolve_merges` drops, with the first reason that applies."""
    return (
        _with_reason(merges, ids, by, text)
        .where(F.col("reason").isNotNull())
        .select(*by, "rank", "left", "right", "reason")
    )


def merge_order(merges: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Resolved merges with ``in_order``.

    A merge is in order when every merge that produces one of its sides ranks
    below it. If all are, one pass over the merges in rank order equals
    repeated lowest-rank merging.
    """
    made = merges.groupBy(*by, "merged_id").agg(F.max("rank").alias("made_by"))
    checked = merges
    for side in ("left", "right"):
        lookup = made.select(
            *by, F.col("merged_id").alias(f"{side}_id"), F.col("made_by").alias(f"{side}_made_by")
        )
        checked = checked.join(lookup, [*by, f"{side}_id"], "left")
    late = (F.coalesce("left_made_by", F.lit(-1)) >= F.col("rank")) | (
        F.coalesce("right_made_by", F.lit(-1)) >= F.col("rank")
    )
    return checked.select(*merges.columns, (~late).alias("in_order"))


def duplicate_merges(merges: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Pairs listed more than once, with the rank that counts."""
    return (
        merges.groupBy(*by, "left_id", "right_id")
        .agg(F.count("*").alias("listed"), F.min("rank").alias("rank"))
        .where("listed > 1")
    )


def concat_mismatches(merges: DataFrame, tokens: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Resolved merges whose left and right bytes do not give the merged token's bytes."""
    checked = merges
    for side in ("left", "right", "merged"):
        lookup = tokens.select(*by, F.col("id").alias(f"{side}_id"), F.col("tok_hex").alias(f"{side}_hex"))
        checked = checked.join(lookup, [*by, f"{side}_id"], "left")
    agrees = F.concat("left_hex", "right_hex").eqNullSafe(F.col("merged_hex"))
    return checked.where(~agrees).select(*merges.columns)


def validate_merges(
    raw: DataFrame, ids: DataFrame, by: Sequence[str] = (), text: str = "tok_hex"
) -> DataFrame:
    """Problems of a merge table as rows (by.., problem, rank).

    The lookups are done once and stored; every check starts from there.
    """
    checked = written(_with_reason(raw, ids, by, text), "checked-merges")
    failed = F.col("reason").isNotNull()
    resolved = checked.where(~failed).select(*by, "rank", "left_id", "right_id", "merged_id")
    missing = checked.where(failed).select(
        *by, F.concat(F.lit("unresolved: "), F.col("reason")).alias("problem"), "rank"
    )
    repeated = duplicate_merges(resolved, by).select(*by, F.lit("duplicate pair").alias("problem"), "rank")
    late = merge_order(resolved, by).where("not in_order").select(
        *by, F.lit("out of order").alias("problem"), "rank"
    )
    return missing.unionByName(repeated).unionByName(late)


def vocab_summary(tokens: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Vocabulary size and the number of tokens of each type."""
    kind = F.col("token_type")
    return tokens.groupBy(*by).agg(
        F.count("*").alias("vocab_size"),
        F.count_if(kind == NORMAL).alias("normal_tokens"),
        F.count_if(kind == BYTE).alias("byte_tokens"),
        F.count_if(kind == SPECIAL).alias("special_tokens"),
    )

"""Line deduplication with DataFrame functions only.

A line's key is the line stripped of space and \\t..\\r at both ends, A-Z lower-cased.
A key of at least ``min_chars`` code points found in at least ``min_docs`` documents
loses all its lines, except in the document with the largest id that holds it.

Texts are shuffled once, to be put together with their dropped positions; lines
travel as two 64-bit hashes. Counting a key combines in each task first, and hot
keys are looked up apart from the rest (``lookup.find``).

Nulls and odd input: a null or empty text is one empty line, which is never dropped.
Rows with one id are one document and each loses the same keys. A row with a null id
is no document that counts: it owns no line, and loses the lines that others share.
An empty table gives an empty one. Other columns stay as they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm.arrow import quoted
from tokenloom.llm.lookup import find
from tokenloom.plans.workspace import written

MIN_CHARS = 20
MIN_DOCS = 3

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLANK = " \t\n\x0b\x0c\r"


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else. ``lower`` is faster and the same where all characters are ASCII."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def split_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _keyed_lines(source: DataFrame, min_chars: int) -> DataFrame:
    """id, print, pos, h1, h2 of every line whose key is long enough."""
    lines = source.select("id", "print", F.posexplode(split_lines(ascii_lower(F.col("body")))).alias("pos", "line"))
    keys = lines.select("id", "print", "pos", F.btrim("line", F.lit(BLANK)).alias("key"))
    # The two hashes start from different seeds, so together they are one of 128 bits.
    return keys.where(F.length("key") >= min_chars).select(
        "id", "print", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2")
    )


def dropped_positions(source: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """id, print and the positions of the lines that go, for texts that lose any."""
    lines = _keyed_lines(source, min_chars)
    counted = lines.groupBy("h1", "h2").agg(F.countDistinct("id").alias("n"), F.max("id").alias("owner"))
    shared = written(counted.where(F.col("n") >= min_docs), "shared-lines")
    found = find(lines, shared, ["h1", "h2"], "n", "owner")
    gone = found.where(F.col("owner").isNotNull() & ~F.col("owner").eqNullSafe(F.col("id")))
    return gone.groupBy("id", "print").agg(F.collect_set("pos").alias("gone"))


def without_repeated_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS
) -> DataFrame:
    """``row`` (the other columns), ``id``, ``kept`` (the text that stays), ``n_lines`` and ``n_dropped``."""
    others = [c for c in docs.columns if c not in (key, text)]
    row = F.struct(*(quoted(c) for c in others)) if others else F.lit(None).cast("int")
    source = docs.select(row.alias("row"), quoted(key).alias("id"), F.coalesce(quoted(text), F.lit("")).alias("body"))
    source = source.withColumn("print", F.xxhash64("body"))
    gone = dropped_positions(source, min_chars, min_docs)
    gone = gone.select(F.col("id").alias("gone_id"), F.col("print").alias("gone_print"), "gone")
    found = source.join(
        gone, F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("print") == F.col("gone_print")), "left"
    ).select("row", "id", "body", "gone", split_lines(F.col("body")).alias("lines"))
    stays = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    kept = F.array_join(F.transform(stays, lambda i: F.get(F.col("lines"), i)), "\n")
    return found.select(
        "row",
        "id",
        F.when(F.col("gone").isNull(), F.col("body")).otherwise(kept).alias("kept"),
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
    )


def deduplicated_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The query: line counts of every document and a digest of the text that stays."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return without_repeated_lines(docs).select(
        F.col("id").alias("doc_id"), "n_lines", "n_dropped", F.sha2(F.encode("kept", "utf-8"), 256).alias("kept_sha256")
    )


def drop_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The pipeline's stage: every document, with what stays of its text and its new length."""
    result = without_repeated_lines(docs)
    made = {"doc_id": F.col("id"), "text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return result.select(*(made.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns))


SQL = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      '{UPPER}', '{UPPER.lower()}') AS key
  FROM lines),
shared AS (
  SELECT key, max(doc_id) AS owner FROM keyed WHERE length(key) >= {MIN_CHARS}
  GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCS}),
marked AS (
  SELECT doc_id, pos, line, s.key IS NOT NULL AND s.owner <> doc_id AS gone
  FROM keyed LEFT JOIN shared s USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

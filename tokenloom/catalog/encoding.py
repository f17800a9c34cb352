"""Queries over encoded text."""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.catalog import sql
from tokenloom.catalog.base import Entry, conversations, documents, joined, long
from tokenloom.fixtures import END_OF_TEXT, MERGES_64, USER, vocabulary_64
from tokenloom.functions.codes import ids_of_state
from tokenloom.functions.ids import PREVIEW_IDS, capped, ids_or_empty, preview_ids, with_bos
from tokenloom.operators.dictionary import build_dictionary, count_chunks, occurrences
from tokenloom.operators.encode import encode_chunks
from tokenloom.operators.parity import parity, parity_summary
from tokenloom.operators.tokens import (
    detokenize,
    encode_inline,
    oov_bytes,
    pair_counts,
    token_counts,
    tokenize,
)
from tokenloom.operators.vocab_tables import byte_tokens, ids_for_bytes
from tokenloom.operators.vocabulary import Vocabulary
from tokenloom.plans.parallel import wanted_partitions
from tokenloom.plans.workspace import new_path
from tokenloom.sources.corpus import stream_corpus
from tokenloom.sources.sinks import write_token_ids
from tokenloom.streaming.encode_stream import encode_batches

# A cap that many documents exceed, so that capping shows.
CAP = 256
# The smaller vocabulary the full one is compared with.
FEWER_MERGES = 32


def _as_text(tokens: DataFrame, *key: str) -> DataFrame:
    return tokens.select(*key, joined(F.col("ids")).alias("ids"), long("n_tokens"), "ok")


# -- corpus and chunks ------------------------------------------------------


def corpus(spark: SparkSession, folder: str) -> DataFrame:
    return documents(spark, folder).select("doc_id", "text", F.octet_length("text").cast("bigint").alias("n_bytes"))


def document_chunks(spark: SparkSession, folder: str) -> DataFrame:
    rows = occurrences(documents(spark, folder), ["doc_id"], vocabulary_64(spark))
    return rows.select("doc_id", long("pos"), "chunk")


def chunk_bytes(spark: SparkSession, folder: str) -> DataFrame:
    chunks = count_chunks(documents(spark, folder), vocabulary_64(spark))
    return chunks.select("chunk", F.hex(F.encode("chunk", "UTF-8")).alias("bytes"))


def chunk_frequencies(spark: SparkSession, folder: str) -> DataFrame:
    return count_chunks(documents(spark, folder), vocabulary_64(spark))


# -- encoding distinct chunks -----------------------------------------------


def _chunk_ids(spark: SparkSession, folder: str, vocab: Vocabulary) -> DataFrame:
    encoded = encode_chunks(count_chunks(documents(spark, folder), vocab), vocab)
    return encoded.select("chunk", joined(ids_of_state(F.col("state"))).alias("ids"), long("n_tokens"))


def chunk_ids_by_literal_sweep(spark: SparkSession, folder: str) -> DataFrame:
    return _chunk_ids(spark, folder, vocabulary_64(spark))


def chunk_ids_by_candidate_sweep(spark: SparkSession, folder: str) -> DataFrame:
    return _chunk_ids(spark, folder, _as_large(vocabulary_64(spark)))


def chunk_ids_by_candidate_search(spark: SparkSession, folder: str) -> DataFrame:
    vocab = dataclasses.replace(vocabulary_64(spark), literal_merges=None, in_order=False)
    return _chunk_ids(spark, folder, vocab)


CHUNK_IDS_SQL = f"""WITH {sql.vocab()}, {sql.occurrences('documents', 'doc_id')}, {sql.encoded()}
    SELECT chunk, ids, n AS n_tokens FROM enc"""


def first_merges(spark: SparkSession, folder: str) -> DataFrame:
    """The lowest-ranked merge each distinct chunk starts with."""
    vocab = vocabulary_64(spark)
    chunks = count_chunks(documents(spark, folder), vocab)
    start = vocab.start_state(F.col("chunk"))
    size = F.char_length("start")
    pairs = chunks.select("chunk", start.alias("start")).where(size > 1).select(
        "chunk", F.explode(F.transform(F.sequence(F.lit(1), size - 1), lambda i: F.substring("start", i, F.lit(2)))).alias("pattern")
    )
    ranked = pairs.join(vocab.hinted_merges("pattern", "rank"), "pattern")
    return ranked.groupBy("chunk").agg(F.min("rank").cast("bigint").alias("rank"))


FIRST_MERGES_SQL = f"""WITH {sql.merges()}, {sql.occurrences('documents', 'doc_id')},
    chunks AS (SELECT DISTINCT chunk, hex(chunk) AS h FROM occ),
    pairs AS (SELECT chunk, h, unnest(range(1, (length(h) // 2))) AS i FROM chunks)
    SELECT chunk, min(rank)::BIGINT AS rank FROM pairs
    JOIN merges ON substr(h, 2 * i - 1, 2) = l AND substr(h, 2 * i + 1, 2) = r GROUP BY chunk"""


# -- ids of rows ------------------------------------------------------------


def document_ids(spark: SparkSession, folder: str) -> DataFrame:
    return _as_text(tokenize(documents(spark, folder), vocabulary_64(spark)), "doc_id")


DOCUMENT_IDS_SQL = f"""WITH {sql.rows_of_ids('documents', 'doc_id')}
    SELECT doc_id, ids, n_tokens, true AS ok FROM tok"""


def document_ids_by_dictionary(spark: SparkSession, folder: str) -> DataFrame:
    """The plan for a vocabulary of any size."""
    return _as_text(tokenize(documents(spark, folder), _as_large(vocabulary_64(spark))), "doc_id")


def document_ids_with_shuffled_dictionary(spark: SparkSession, folder: str) -> DataFrame:
    """The plan for a dictionary too large to broadcast."""
    vocab, texts = _as_large(vocabulary_64(spark)), documents(spark, folder)
    limited = dataclasses.replace(build_dictionary(texts, vocab), broadcast_rows=1_000, frequent_share=1 / 1_000)
    return _as_text(tokenize(texts, vocab, dictionary=limited), "doc_id")


def conversation_ids(spark: SparkSession, folder: str) -> DataFrame:
    rows = conversations(spark, folder)
    return _as_text(tokenize(rows, vocabulary_64(spark), ["conv_id", "turn"]), "conv_id", "turn")


def stored_ids(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "ids")
    write_token_ids(tokenize(documents(spark, folder), vocabulary_64(spark)), path)
    return _as_text(spark.read.parquet(path), "doc_id")


def _chat_text():
    return F.concat(F.lit(USER[0]), F.col("text"), F.lit(END_OF_TEXT[0]))


def added_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Turns wrapped in added tokens, which stay whole."""
    vocab = vocabulary_64(spark, added=(END_OF_TEXT, USER))
    rows = conversations(spark, folder).withColumn("text", _chat_text())
    return _as_text(tokenize(rows, vocab, ["conv_id", "turn"]), "conv_id", "turn")


ADDED_TOKEN_IDS_SQL = f"""WITH {sql.rows_of_ids('conversations', 'conv_id, turn')}
    SELECT conv_id, turn, trim('{USER[1]} ' || ids) || ' {END_OF_TEXT[1]}' AS ids, n_tokens + 2 AS n_tokens, true AS ok
    FROM tok"""


def bos_ids(spark: SparkSession, folder: str) -> DataFrame:
    """The first turn of every conversation starts with the BOS id."""
    tokens = tokenize(conversations(spark, folder), vocabulary_64(spark), ["conv_id", "turn"])
    ids = with_bos(F.col("ids"), F.lit(END_OF_TEXT[1]), F.col("turn") == 0)
    return tokens.select("conv_id", "turn", joined(ids).alias("ids"), F.size(ids).cast("bigint").alias("n_tokens"))


BOS_IDS_SQL = f"""WITH {sql.rows_of_ids('conversations', 'conv_id, turn')}
    SELECT conv_id, turn, CASE WHEN turn = 0 THEN trim('{END_OF_TEXT[1]} ' || ids) ELSE ids END AS ids,
      n_tokens + (turn = 0)::BIGINT AS n_tokens FROM tok"""


def capped_ids(spark: SparkSession, folder: str) -> DataFrame:
    """At most CAP ids beside the full length."""
    tokens = tokenize(documents(spark, folder), vocabulary_64(spark))
    return tokens.select("doc_id", joined(capped(F.col("ids"), CAP)).alias("ids"), long("n_tokens"))


def previewed_ids(spark: SparkSession, folder: str) -> DataFrame:
    tokens = tokenize(documents(spark, folder), vocabulary_64(spark))
    return tokens.select("doc_id", joined(preview_ids(F.col("ids"))).alias("ids"), long("n_tokens"))


def preview_texts(spark: SparkSession, folder: str) -> DataFrame:
    """The text of each document's first ids; null where they end within a character."""
    vocab = vocabulary_64(spark)
    tokens = tokenize(documents(spark, folder), vocab)
    return detokenize(tokens.select("doc_id", preview_ids(F.col("ids")).alias("ids")), vocab)


_SPELLED = [f"{b:02X}" for b in range(256)] + [m.replace("+", "") for m in MERGES_64]
PREVIEW_TEXTS_SQL = f"""WITH {sql.rows_of_ids('documents', 'doc_id')},
    firsts AS (SELECT doc_id, list_slice(string_split(ids, ' '), 1, {PREVIEW_IDS}) AS ids FROM tok),
    spelled AS (SELECT doc_id, array_to_string(list_transform(list_filter(ids, lambda i: i <> ''),
      lambda i: string_split('{",".join(_SPELLED)}', ',')[i::BIGINT + 1]), '') AS hex FROM firsts)
    SELECT doc_id, TRY(decode(unhex(hex))) AS text FROM spelled"""


def _first_ids_sql(size: int) -> str:
    return f"""WITH {sql.rows_of_ids('documents', 'doc_id')}
    SELECT doc_id, array_to_string(list_slice(string_split(ids, ' '), 1, {size}), ' ') AS ids, n_tokens FROM tok"""


def failed_encodes(spark: SparkSession, folder: str) -> DataFrame:
    """Documents labelled toxic come without a text, and so without ids."""
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    texts = documents(spark, folder).join(labels, "doc_id", "left")
    texts = texts.withColumn("text", F.when(F.coalesce("toxic", F.lit(0)) == 0, F.col("text"))).drop("toxic")
    tokens = tokenize(texts, vocabulary_64(spark))
    return tokens.select("doc_id", F.size(ids_or_empty(F.col("ids"))).cast("bigint").alias("n_tokens"), "ok")


FAILED_ENCODES_SQL = f"""WITH {sql.rows_of_ids('documents', 'doc_id')}
    SELECT doc_id, CASE WHEN coalesce(toxic, 0) = 0 THEN n_tokens ELSE 0 END::BIGINT AS n_tokens,
      coalesce(toxic, 0) = 0 AS ok
    FROM tok LEFT JOIN labels USING (doc_id)"""


def round_trip(spark: SparkSession, folder: str) -> DataFrame:
    vocab, texts = vocabulary_64(spark), documents(spark, folder)
    return detokenize(tokenize(texts, vocab), vocab)


def round_trip_by_join(spark: SparkSession, folder: str) -> DataFrame:
    """The plan for a vocabulary of any size."""
    vocab = dataclasses.replace(_as_large(vocabulary_64(spark)), literal_tokens=None)
    texts = documents(spark, folder)
    return detokenize(tokenize(texts, vocab), vocab)


# -- counts -----------------------------------------------------------------


def tokens_by_lang(spark: SparkSession, folder: str) -> DataFrame:
    texts = documents(spark, folder, ["lang"])
    counts = token_counts(texts, vocabulary_64(spark), ["lang"], few_groups=True)
    return counts.select("lang", long("n_tokens"))


def _as_large(vocab: Vocabulary) -> Vocabulary:
    """The vocabulary as one with too many merges for a literal list."""
    return dataclasses.replace(vocab, literal_merges=None)


def tokens_by_lang_by_dictionary(spark: SparkSession, folder: str) -> DataFrame:
    """The plan for a vocabulary of any size and a grouping with few values."""
    vocab = _as_large(vocabulary_64(spark))
    counts = token_counts(documents(spark, folder, ["lang"]), vocab, ["lang"], few_groups=True)
    return counts.select("lang", long("n_tokens"))


def tokens_by_document_by_dictionary(spark: SparkSession, folder: str) -> DataFrame:
    """The plan for a vocabulary of any size and a grouping with many values."""
    vocab = _as_large(vocabulary_64(spark))
    counts = token_counts(documents(spark, folder), vocab, ["doc_id"])
    return counts.select("doc_id", long("n_tokens"))


def tokens_by_source(spark: SparkSession, folder: str) -> DataFrame:
    counts = token_counts(documents(spark, folder, ["lang", "source"]), vocabulary_64(spark), ["lang", "source"])
    return counts.select("lang", "source", long("n_tokens"))


def tokens_by_lang_and_source_with_totals(spark: SparkSession, folder: str) -> DataFrame:
    counts = token_counts(documents(spark, folder, ["lang", "source"]), vocabulary_64(spark), ["lang", "source"])
    return counts.rollup("lang", "source").agg(F.sum("n_tokens").cast("bigint").alias("n_tokens"))


def tokens_by_document(spark: SparkSession, folder: str) -> DataFrame:
    counts = token_counts(documents(spark, folder), vocabulary_64(spark), ["doc_id"])
    return counts.select("doc_id", long("n_tokens"))


def tokens_by_role(spark: SparkSession, folder: str) -> DataFrame:
    texts = conversations(spark, folder, ["role"])
    counts = token_counts(texts, vocabulary_64(spark), ["role"], few_groups=True)
    return counts.select("role", long("n_tokens"))


def tokens_by_conversation(spark: SparkSession, folder: str) -> DataFrame:
    counts = token_counts(conversations(spark, folder), vocabulary_64(spark), ["conv_id"])
    return counts.select("conv_id", long("n_tokens"))


def _counts_sql(table: str, by: str) -> str:
    return f"""WITH {sql.occurrences(table, by)}, {sql.counted()}
    SELECT {by}, sum(n)::BIGINT AS n_tokens FROM occ JOIN enc USING (chunk) GROUP BY {by}"""


def out_of_vocabulary_bytes(spark: SparkSession, folder: str) -> DataFrame:
    """Against a vocabulary with ASCII bytes only."""
    ascii_only = dataclasses.replace(vocabulary_64(spark), unknown_bytes=tuple(range(128, 256)))
    count = oov_bytes(F.col("text"), ascii_only).cast("bigint")
    return documents(spark, folder).select("doc_id", count.alias("oov_bytes"))


OOV_SQL = """SELECT doc_id, (len(list_filter(regexp_extract_all(hex(text), '..'), lambda b: b >= '80')))::BIGINT AS oov_bytes
    FROM documents"""


def byte_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes of the corpus with their frequency, looked up in an ASCII-only vocabulary."""
    vocab = vocabulary_64(spark)
    chunks = count_chunks(documents(spark, folder), vocab)
    codes = F.regexp_extract_all(F.hex(F.encode("chunk", "UTF-8")), F.lit(".."), F.lit(0))
    rows = chunks.select("n", F.explode(codes).alias("code")).groupBy("code").agg(F.sum("n").alias("n"))
    rows = rows.select(F.conv("code", 16, 10).cast("int").alias("byte"), "n")
    known = byte_tokens(vocab.tokens).where("byte < 128")
    return ids_for_bytes(rows, known).select(long("byte"), long("id"), "oov", "n")


BYTE_IDS_SQL = f"""WITH {sql.occurrences('documents', 'doc_id')},
    bytes AS (SELECT unnest(regexp_extract_all(hex(chunk), '..')) AS b FROM occ),
    {sql.vocab()}
    SELECT ('0x' || b)::BIGINT AS byte, CASE WHEN b < '80' THEN id ELSE 0 END::BIGINT AS id, b >= '80' AS oov,
      count(*)::BIGINT AS n
    FROM bytes LEFT JOIN vocab ON tok = b GROUP BY ALL"""


def neighbour_ids(spark: SparkSession, folder: str) -> DataFrame:
    counts = pair_counts(build_dictionary(documents(spark, folder), vocabulary_64(spark)))
    return counts.select(long("left_id"), long("right_id"), long("n"))


NEIGHBOUR_IDS_SQL = f"""WITH {sql.vocab()}, {sql.occurrences('documents', 'doc_id')},
    {sql.encoded()}, freq AS (SELECT chunk, count(*) AS f FROM occ GROUP BY chunk),
    pairs AS (
      SELECT chunk, id AS left_id, lead(id) OVER (PARTITION BY chunk ORDER BY i) AS right_id
      FROM enc_parts JOIN vocab USING (tok))
    SELECT left_id::BIGINT AS left_id, right_id::BIGINT AS right_id, sum(f)::BIGINT AS n
    FROM pairs JOIN freq USING (chunk) WHERE right_id IS NOT NULL GROUP BY ALL"""


# -- parity -----------------------------------------------------------------


def _compared(spark: SparkSession, folder: str) -> DataFrame:
    """All documents under the full vocabulary, labelled ones under a smaller one."""
    texts = documents(spark, folder)
    labelled = texts.join(spark.read.parquet(f"{folder}/labels.parquet").select("doc_id"), "doc_id", "left_semi")
    return parity(
        tokenize(texts, vocabulary_64(spark)), tokenize(labelled, vocabulary_64(spark, FEWER_MERGES))
    )


def compared_ids(spark: SparkSession, folder: str) -> DataFrame:
    return _compared(spark, folder).select(
        "doc_id", "equal", long("first_diff"), long("size_a"), long("size_b"), "side"
    )


def compared_ids_summary(spark: SparkSession, folder: str) -> DataFrame:
    return parity_summary(_compared(spark, folder))


_COMPARED_SQL = f"""WITH {sql.rows_of_ids('documents', 'doc_id', name='a')},
    {sql.rows_of_ids('documents', 'doc_id', n_merges=FEWER_MERGES, name='b')},
    compared AS (
      SELECT a.doc_id, string_split(a.ids, ' ') AS x, string_split(b.ids, ' ') AS y,
        a.n_tokens AS size_a, b.n_tokens AS size_b, labels.doc_id IS NOT NULL AS labelled
      FROM a JOIN b USING (doc_id) LEFT JOIN labels USING (doc_id)),
    result AS (
      SELECT doc_id, labelled AND x = y AS equal,
        CASE WHEN labelled THEN list_position(list_transform(range(1, greatest(len(x), len(y)) + 1),
          lambda i: x[i] IS DISTINCT FROM y[i]), true) END::BIGINT AS first_diff,
        size_a::BIGINT AS size_a, CASE WHEN labelled THEN size_b END::BIGINT AS size_b,
        CASE WHEN labelled THEN 'both' ELSE 'a' END AS side
      FROM compared)"""


# -- streams ----------------------------------------------------------------


def _stream(spark: SparkSession, folder: str) -> DataFrame:
    table = spark.read.parquet(f"{folder}/documents.parquet")
    # A stream source is a folder; the glob keeps it to this one table.
    path = f"{folder}/documents*.parquet"
    return stream_corpus(spark, path, table.schema, ["doc_id"], keep=["lang"], partitions=wanted_partitions(table))


def streamed_tokens_by_lang(spark: SparkSession, folder: str) -> DataFrame:
    """Encoded where the stream passes, written to files, counted from those."""
    path, state = new_path(spark, "stream-ids"), new_path(spark, "stream-state")
    encoded = encode_inline(_stream(spark, folder), vocabulary_64(spark), ["doc_id", "lang"])
    query = (
        encoded.writeStream.format("parquet")
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()
    rows = spark.read.schema(encoded.schema).parquet(path)
    return rows.groupBy("lang").agg(F.sum("n_tokens").cast("bigint").alias("n_tokens"))


def streamed_batches_by_lang(spark: SparkSession, folder: str) -> DataFrame:
    """The same with the dictionary plan in every micro-batch, as for a large vocabulary."""
    path, state = new_path(spark, "batch-ids"), new_path(spark, "batch-state")
    query = encode_batches(
        _stream(spark, folder), _as_large(vocabulary_64(spark)), path, state, ["doc_id", "lang"], available_now=True
    )
    query.awaitTermination()
    rows = spark.read.parquet(path)
    return rows.groupBy("lang").agg(F.sum("n_tokens").cast("bigint").alias("n_tokens"))


ENTRIES: dict[str, Entry] = {
    "corpus": Entry("SRC1", corpus, "SELECT doc_id, text, strlen(text)::BIGINT AS n_bytes FROM documents"),
    "document_chunks": Entry("PRJ9", document_chunks, f"WITH {sql.occurrences('documents', 'doc_id')} SELECT doc_id, pos, chunk FROM occ"),
    "chunk_bytes": Entry("PRJ10", chunk_bytes, f"WITH {sql.occurrences('documents', 'doc_id')} SELECT DISTINCT chunk, hex(chunk) AS bytes FROM occ"),
    "chunk_frequencies": Entry("AG6", chunk_frequencies, f"WITH {sql.occurrences('documents', 'doc_id')} SELECT chunk, count(*)::BIGINT AS n FROM occ GROUP BY chunk"),
    "chunk_ids_by_literal_sweep": Entry("JN4", chunk_ids_by_literal_sweep, CHUNK_IDS_SQL),
    "chunk_ids_by_candidate_sweep": Entry("JN4", chunk_ids_by_candidate_sweep, CHUNK_IDS_SQL),
    "chunk_ids_by_candidate_search": Entry("JN4, AG5", chunk_ids_by_candidate_search, CHUNK_IDS_SQL),
    "first_merges": Entry("AG5", first_merges, FIRST_MERGES_SQL),
    "document_ids": Entry("JN5, AG7", document_ids, DOCUMENT_IDS_SQL),
    "document_ids_by_dictionary": Entry("JN5, AG7", document_ids_by_dictionary, DOCUMENT_IDS_SQL),
    "document_ids_with_shuffled_dictionary": Entry("JN5, AG7", document_ids_with_shuffled_dictionary, DOCUMENT_IDS_SQL),
    "conversation_ids": Entry("JN5, AG7", conversation_ids, f"WITH {sql.rows_of_ids('conversations', 'conv_id, turn')} SELECT conv_id, turn, ids, n_tokens, true AS ok FROM tok"),
    "stored_ids": Entry("SNK1", stored_ids, DOCUMENT_IDS_SQL),
    "added_token_ids": Entry("PRJ11", added_token_ids, ADDED_TOKEN_IDS_SQL),
    "bos_ids": Entry("PRJ12", bos_ids, BOS_IDS_SQL),
    "capped_ids": Entry("PRJ13", capped_ids, _first_ids_sql(CAP)),
    "previewed_ids": Entry("PRJ14", previewed_ids, _first_ids_sql(PREVIEW_IDS)),
    "preview_texts": Entry("PRJ14, JN9", preview_texts, PREVIEW_TEXTS_SQL),
    "failed_encodes": Entry("PRJ19", failed_encodes, FAILED_ENCODES_SQL),
    "round_trip": Entry("JN9", round_trip, "SELECT doc_id, text FROM documents"),
    "round_trip_by_join": Entry("JN9", round_trip_by_join, "SELECT doc_id, text FROM documents"),
    "tokens_by_lang": Entry("AG3", tokens_by_lang, _counts_sql("documents", "lang")),
    "tokens_by_lang_by_dictionary": Entry("AG3", tokens_by_lang_by_dictionary, _counts_sql("documents", "lang")),
    "tokens_by_document_by_dictionary": Entry("AG3", tokens_by_document_by_dictionary, f"WITH {sql.rows_of_ids('documents', 'doc_id')} SELECT doc_id, n_tokens FROM tok"),
    "tokens_by_source": Entry("AG3", tokens_by_source, _counts_sql("documents", "lang, source")),
    "tokens_by_lang_and_source_with_totals": Entry(
        "AG3",
        tokens_by_lang_and_source_with_totals,
        f"""WITH {sql.occurrences('documents', 'lang, source')}, {sql.counted()}
        SELECT lang, source, sum(n)::BIGINT AS n_tokens FROM occ JOIN enc USING (chunk) GROUP BY ROLLUP (lang, source)""",
    ),
    "tokens_by_document": Entry("AG3", tokens_by_document, f"WITH {sql.rows_of_ids('documents', 'doc_id')} SELECT doc_id, n_tokens FROM tok"),
    "tokens_by_role": Entry("AG3", tokens_by_role, _counts_sql("conversations", "role")),
    "tokens_by_conversation": Entry("AG3", tokens_by_conversation, _counts_sql("conversations", "conv_id")),
    "out_of_vocabulary_bytes": Entry("AG4", out_of_vocabulary_bytes, OOV_SQL),
    "byte_ids": Entry("JN3", byte_ids, BYTE_IDS_SQL),
    "neighbour_ids": Entry("WN1", neighbour_ids, NEIGHBOUR_IDS_SQL),
    "compared_ids": Entry("JN7", compared_ids, _COMPARED_SQL + " SELECT * FROM result"),
    "compared_ids_summary": Entry(
        "JN7",
        compared_ids_summary,
        _COMPARED_SQL
        + """ SELECT count(*)::BIGINT AS keys, count_if(equal)::BIGINT AS equal,
        count_if(NOT equal AND side = 'both')::BIGINT AS different, count_if(side = 'a')::BIGINT AS only_a,
        0::BIGINT AS only_b FROM result""",
    ),
    "streamed_tokens_by_lang": Entry("ST1", streamed_tokens_by_lang, _counts_sql("documents", "lang")),
    "streamed_batches_by_lang": Entry("ST1", streamed_batches_by_lang, _counts_sql("documents", "lang")),
}

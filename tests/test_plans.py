"""Plans that must hold at scale: what is shuffled, broadcast and scanned."""

from __future__ import annotations

import dataclasses
import re

from pyspark.sql import functions as F

from tokenloom.fixtures import vocabulary_64
from tokenloom.operators.blocks import blocks
from tokenloom.operators.dictionary import build_dictionary, count_chunks, occurrences, with_codes
from tokenloom.operators.encode import candidate_sweep
from tokenloom.operators.tokens import detokenize, encode_inline, put_together, run_joiner, token_counts, tokenize
from tokenloom.plans.parallel import spread
from tokenloom.plans.sizes import BROADCAST_ROWS, hinted
from tokenloom.sources.corpus import read_corpus

DOCUMENTS = "/root/testdata/sf0.01/documents.parquet"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df) -> list[str]:
    return re.findall(r"(?<!Broadcast)Exchange (\w+)", plan(df))


def large(spark):
    return dataclasses.replace(vocabulary_64(spark), literal_merges=None)


def test_corpus_scan_reads_only_key_and_text(spark):
    text = plan(read_corpus(spark, DOCUMENTS))
    schema = re.search(r"ReadSchema: (\S+)", text).group(1)
    assert schema == "struct<doc_id:bigint,text:string>"


def test_filter_reaches_the_scan(spark):
    docs = read_corpus(spark, DOCUMENTS, keep=["lang"]).where("lang = 'de'")
    assert "EqualTo(lang,de)" in plan(docs)


def test_inline_encoding_shuffles_nothing(spark):
    docs = spark.read.parquet(DOCUMENTS)
    tokens = encode_inline(docs, vocabulary_64(spark))
    assert shuffles(tokens) == [] and "Python" not in plan(tokens)


def test_candidates_are_gathered_in_one_shuffle(spark):
    """One shuffle for the distinct chunks, which are stored, and one to gather each one's candidates."""
    docs = spark.read.parquet(DOCUMENTS)
    chunks = count_chunks(docs, large(spark))
    assert len(shuffles(chunks)) == 1
    encoded = candidate_sweep(chunks, large(spark))
    assert len(shuffles(encoded)) == 1 and "Python" not in plan(encoded)


def test_counts_by_language_shuffle_distinct_chunks_only(spark):
    docs = spark.read.parquet(DOCUMENTS)
    counts = token_counts(docs, large(spark), ["lang"], few_groups=True)
    assert len(shuffles(counts)) == 2
    # The stored chunks, the merges, and their beginnings twice; the documents were read once to store the chunks.
    assert plan(counts).count("Scan parquet") == 4 and plan(counts).count("documents.parquet") == 0


def test_small_dictionary_shuffles_no_occurrence(spark):
    docs = spark.read.parquet(DOCUMENTS).select("doc_id", "text")
    vocab = large(spark)
    dictionary = build_dictionary(docs, vocab)
    tokens = tokenize(docs, vocab, dictionary=dictionary)
    # Only the gather by key, after a partial gather in each task.
    assert len(shuffles(tokens)) == 1
    counts = token_counts(docs, vocab, ["doc_id"], dictionary)
    assert len(shuffles(counts)) == 1


def test_large_dictionary_broadcasts_frequent_chunks_only(spark):
    docs = spark.read.parquet(DOCUMENTS).select("doc_id", "text")
    vocab = large(spark)
    dictionary = dataclasses.replace(build_dictionary(docs, vocab), broadcast_rows=1_000)
    assert not dictionary.fits
    assert 0 < dictionary.frequent().count() <= 1_000
    rows = docs.select("doc_id", F.explode(F.split("text", " ")).alias("chunk"))
    assert rows.count() == with_codes(rows, dictionary, ["n_tokens"]).count()


def test_broadcast_hint_needs_a_small_table(spark):
    table = spark.range(10)
    assert "ResolvedHint" in hinted(table, 10, 100)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in hinted(table, BROADCAST_ROWS + 1, 100)._jdf.queryExecution().analyzed().toString()


def test_encoding_without_broadcasting_merges(spark):
    """A merge table past the bound goes through a shuffle join with the same result."""
    docs = spark.read.parquet(DOCUMENTS)
    vocab = dataclasses.replace(large(spark), n_merges=BROADCAST_ROWS + 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        chunks = count_chunks(docs, vocab)
        encoded = candidate_sweep(chunks, vocab)
        # Only the beginnings of tokens, whose number is checked, are broadcast.
        assert plan(encoded).count("BroadcastHashJoin") == 2 and "SortMergeJoin" in plan(encoded)
        total = encoded.agg(F.sum(F.col("n") * F.char_length("state"))).first()[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert total == 1_427_184


def test_bucketed_corpus_is_gathered_in_place(spark):
    docs = spark.read.parquet(DOCUMENTS).select("doc_id", "text")
    vocab = large(spark)
    dictionary = build_dictionary(docs, vocab)
    spark.sql("DROP TABLE IF EXISTS bucketed_documents")
    docs.write.bucketBy(4, "doc_id").sortBy("doc_id").saveAsTable("bucketed_documents")
    try:
        tokens = tokenize(spark.table("bucketed_documents"), vocab, dictionary=dictionary)
        assert shuffles(tokens) == []
        assert tokens.agg(F.sum("n_tokens")).first()[0] == 1_427_184
    finally:
        spark.sql("DROP TABLE IF EXISTS bucketed_documents")


def test_spread_leaves_well_split_inputs_alone(spark):
    many = spark.range(0, 1_000, numPartitions=spark.sparkContext.defaultParallelism)
    assert shuffles(spread(many)) == []
    assert len(shuffles(spread(spark.range(0, 1_000, numPartitions=1)))) == 1


def test_about_one_row_a_document_is_gathered(spark):
    """What is shuffled to gather ids, and to gather text from ids, grows with the documents, not with their chunks."""
    docs = spark.read.parquet(DOCUMENTS).select("doc_id", "text").repartition(3)
    vocab = dataclasses.replace(large(spark), literal_tokens=None)
    tokens = tokenize(docs, vocab, dictionary=build_dictionary(docs, vocab))
    for result in (tokens, detokenize(tokens, vocab)):
        result.collect()
        final = result._jdf.queryExecution().executedPlan().finalPhysicalPlan()
        assert "ArrowEvalPython" in final.toString()
    rows = occurrences(docs, ["doc_id"], vocab).withColumn("_content", F.lit(0)).withColumn("known", F.lit(True))
    runs = rows.select("doc_id", "pos", run_joiner()(F.xxhash64("doc_id"), "pos", "chunk").alias("run")).where("run IS NOT NULL")
    # A batch has 10,000 rows, so each ends one run more.
    assert runs.count() <= docs.count() + rows.count() / 10_000 + 3
    joined = put_together(rows, ["doc_id"], F.col("chunk"), F.col("known"))
    assert joined.join(docs.withColumnRenamed("text", "whole"), "doc_id").where("text <> whole").count() == 0


def test_rows_of_one_key_are_cut_anywhere(spark):
    """Equal rows of one key whose runs end at different places, and rows that come in no order."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        text = " ".join(f"word{i}" for i in range(50))
        docs = spark.createDataFrame([(1, text)] * 3 + [(1, "other text"), (1, None), (2, ""), (2, "")], "doc_id long, text string").repartition(2)
        vocab = large(spark)
        tokens = tokenize(docs, vocab)
        want = sorted(map(str, tokenize(docs, vocabulary_64(spark)).collect()))
        assert sorted(map(str, tokens.collect())) == want
        small = dataclasses.replace(build_dictionary(docs, vocab), broadcast_rows=3)
        assert sorted(map(str, tokenize(docs, vocab, dictionary=small).collect())) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_a_large_dictionary_meets_distinct_chunks_only(spark):
    """What is joined with a dictionary too large to broadcast is a row for each chunk of a block, not for each occurrence."""
    docs = spark.read.parquet(DOCUMENTS).select("doc_id", "text").repartition(3)
    vocab = large(spark)
    dictionary = dataclasses.replace(build_dictionary(docs, vocab), broadcast_rows=1_000, frequent_share=1 / 1_000)
    tokens = tokenize(docs, vocab, dictionary=dictionary)
    want = tokenize(docs, vocabulary_64(spark))
    assert tokens.exceptAll(want).count() == 0 and want.exceptAll(tokens).count() == 0
    shown = plan(tokens)
    # The documents were read once, to store their blocks.
    assert "documents.parquet" not in shown and "/blocks-" in shown
    rows = blocks(docs, vocab, ["doc_id"]).select("block", F.explode("chunks").alias("chunk"))
    assert rows.count() <= 3 * dictionary.rows < dictionary.occurrences / 2
    assert rows.distinct().count() == rows.count()

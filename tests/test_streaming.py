from __future__ import annotations

import dataclasses

from pyspark.sql import functions as F

from tokenloom.fixtures import vocabulary_64
from tokenloom.operators.tokens import encode_inline, tokenize
from tokenloom.sources.corpus import stream_corpus
from tokenloom.sources.sinks import write_token_ids
from tokenloom.streaming.encode_stream import encode_batches

DOCUMENTS = "/root/testdata/sf0.001/documents.parquet"
SCHEMA = "doc_id long, text string"


def stream(spark, path, files=3):
    docs = spark.read.parquet(DOCUMENTS).select("doc_id", "text")
    docs.repartition(files).write.parquet(path)
    return stream_corpus(spark, path, docs.schema, max_files_per_trigger=1)


def rows(df):
    return {r["doc_id"]: (r["ids"], r["n_tokens"], r["ok"]) for r in df.collect()}


def test_inline_stream_equals_batch(spark, tmp_path):
    vocab = vocabulary_64(spark)
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    encoded = encode_inline(stream(spark, source), vocab)
    query = (
        encoded.writeStream.format("parquet").option("checkpointLocation", state).trigger(availableNow=True).start(out)
    )
    query.awaitTermination()
    found = rows(spark.read.schema(encoded.schema).parquet(out))
    assert found == rows(tokenize(spark.read.parquet(DOCUMENTS), vocab))
    assert sum(n for _, n, _ in found.values()) == 283_261


def test_batches_equal_batch_and_resume(spark, tmp_path):
    vocab = dataclasses.replace(vocabulary_64(spark), literal_merges=None)
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    encode_batches(stream(spark, source), vocab, out, state, available_now=True).awaitTermination()
    first = rows(spark.read.parquet(out))
    assert first == rows(tokenize(spark.read.parquet(DOCUMENTS), vocab))
    # New files arrive; the restarted query adds only those.
    more = spark.createDataFrame([(1_000_000, "the the")], SCHEMA)
    more.coalesce(1).write.mode("append").parquet(source)
    again = stream_corpus(spark, source, more.schema)
    encode_batches(again, vocab, out, state, available_now=True).awaitTermination()
    assert rows(spark.read.parquet(out)) == {**first, 1_000_000: ([256, 101, 273], 3, True)}


def test_token_sink(spark, tmp_path):
    tokens = tokenize(spark.read.parquet(DOCUMENTS), vocabulary_64(spark))
    write_token_ids(tokens, str(tmp_path / "ids"))
    stored = spark.read.parquet(str(tmp_path / "ids"))
    assert stored.columns == ["doc_id", "ids", "n_tokens", "ok"]
    assert stored.where(F.size("ids") != F.col("n_tokens")).count() == 0
    assert rows(stored) == rows(tokens)

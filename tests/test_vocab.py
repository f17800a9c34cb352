from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tokenloom.fixtures import MERGES_64, model_arrays, spelled, vocabulary_64
from tokenloom.functions.alphabet import byte_alphabet, char_to_byte, token_hex
from tokenloom.functions.chunks import (
    INLINE_CONTRACTIONS,
    SPELLED_OUT_CONTRACTIONS,
    normalize_pattern,
)
from tokenloom.operators.vocab_tables import (
    byte_tokens,
    concat_mismatches,
    duplicate_merges,
    first_ids,
    ids_for_bytes,
    ids_for_texts,
    mapped_type,
    merge_order,
    resolve_merges,
    token_table,
    two_sided,
    unresolved_merges,
    validate_merges,
    vocab_summary,
)
from tokenloom.operators.vocabulary import validate_vocabulary
from tokenloom.sources.vocab import (
    attributes_from_arrays,
    merges_from_arrays,
    named_empty,
    parse_tokenizer_json,
    select_metadata,
    split_merge,
    tokens_from_arrays,
    tokens_from_json,
    typed_tokens_from_arrays,
    with_attributes,
)


def values(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_split_merge(spark):
    rows = spark.createDataFrame([("a b",), (" x y",), ("ab",), ("a b c",)], "m string")
    left, right = split_merge(F.col("m"))
    assert [tuple(r) for r in rows.select(left, right).collect()] == [("a", "b"), (" x", "y"), ("ab", ""), ("a", "b c")]


def test_empty_token_is_named(spark):
    rows = spark.createDataFrame([(7, ""), (8, "x")], "id int, token string")
    assert [r[0] for r in rows.select(named_empty(F.col("token"), F.col("id"))).collect()] == ["[EMPTY_7]", "x"]


def test_type_map(spark):
    rows = spark.createDataFrame([(1,), (6,), (3,), (None,), (2,)], "t int")
    assert [r[0] for r in rows.select(mapped_type(F.col("t"))).collect()] == [0, 1, 2, 0, 2]


def test_byte_alphabet(spark):
    table = {r["code_point"]: r["byte"] for r in byte_alphabet(spark).collect()}
    assert len(table) == 256 and sorted(table.values()) == list(range(256))
    assert all(ord(spelled(bytes([b]))) == p for p, b in table.items())
    chars = ["Ġ", "A", "Ń", "ń", "é", "Ā", "ab", ""]
    rows = spark.createDataFrame([(c,) for c in chars], "c string")
    assert [r[0] for r in rows.select(char_to_byte(F.col("c"))).collect()] == [32, 65, 173, None, 233, 0, None, None]


def test_token_hex(spark):
    every = bytes(range(256))
    rows = spark.createDataFrame(
        [(spelled(every), False), ("Ġ日", False), ("Ġ", True), ("", False)], "t string, special boolean"
    )
    found = [r[0] for r in rows.select(token_hex(F.col("t"), F.col("special"))).collect()]
    assert found == [every.hex().upper(), "Ġ日".encode().hex().upper(), "Ġ".encode().hex().upper(), ""]


def test_duplicate_text_takes_first_id(spark):
    rows = spark.createDataFrame([(9, "x"), (4, "x"), (5, "y")], "id int, tok_hex string")
    assert values(first_ids(rows)) == [("x", 4), ("y", 5)]
    wanted = spark.createDataFrame([("x",), ("z",)], "tok_hex string")
    assert values(ids_for_texts(wanted, first_ids(rows))) == [("x", 4), ("z", None)]


def test_models_are_kept_apart(spark):
    rows = spark.createDataFrame([("m", 9, "x"), ("m", 4, "x"), ("n", 5, "x")], "model string, id int, tok_hex string")
    assert values(first_ids(rows, ["model"])) == [("m", "x", 4), ("n", "x", 5)]


@pytest.fixture(scope="module")
def bad_merges(spark):
    ids = spark.createDataFrame(
        [("61", 0), ("62", 1), ("63", 2), ("6162", 3), ("616263", 4)], "tok_hex string, id int"
    )
    merges = spark.createDataFrame(
        [(0, "6162", "63"), (1, "61", "62"), (2, "61", "62"), (3, "61", ""), (4, "62", "63"), (5, "7A", "61"), (6, "61", "7A")],
        "rank int, left string, right string",
    )
    return merges, ids


def test_merge_resolution(bad_merges):
    merges, ids = bad_merges
    resolved = resolve_merges(merges, ids)
    assert values(resolved) == [(0, 3, 2, 4), (1, 0, 1, 3), (2, 0, 1, 3)]
    assert two_sided(merges).count() == 6
    assert [(r["rank"], r["reason"]) for r in unresolved_merges(merges, ids).orderBy("rank").collect()] == [
        (3, "empty side"), (4, "merged"), (5, "left"), (6, "right"),
    ]
    assert {r["rank"]: r["in_order"] for r in merge_order(resolved).collect()} == {0: False, 1: True, 2: True}
    assert values(duplicate_merges(resolved)) == [(0, 1, 2, 1)]
    problems = values(validate_merges(merges, ids).select("problem", "rank"))
    assert problems == sorted(
        [("unresolved: empty side", 3), ("unresolved: merged", 4), ("unresolved: left", 5), ("unresolved: right", 6),
         ("duplicate pair", 1), ("out of order", 0)], key=repr,
    )


def test_vocabulary_problems(spark):
    schema = "m string, id int, token string, source_type int, score float"
    tokens = spark.createDataFrame(
        [("p", 0, "a", 1, None), ("p", 1, "a", 1, None), ("p", 2, "b", 1, None), ("q", 0, "a", 1, None)], schema
    )
    merges = spark.createDataFrame([("p", 0, "a", "b"), ("q", 5, "a", "")], "m string, rank int, left string, right string")
    assert values(validate_vocabulary(tokens, merges, ["m"])) == [
        ("p", "repeated token", 0), ("p", "unresolved: merged", 0), ("q", "unresolved: empty side", 5),
    ]


def test_concat_check(spark):
    tokens = spark.createDataFrame([(0, "61"), (1, "62"), (2, "6162"), (3, "63")], "id int, tok_hex string")
    merges = spark.createDataFrame([(0, 0, 1, 2), (1, 0, 1, 3)], "rank int, left_id int, right_id int, merged_id int")
    assert values(concat_mismatches(merges, tokens)) == [(1, 0, 1, 3)]


def test_byte_lookup(spark):
    tokens = spark.createDataFrame([(5, "61"), (9, "61"), (7, "6162")], "id int, tok_hex string")
    known = byte_tokens(tokens)
    assert values(known) == [(97, 5)]
    rows = spark.createDataFrame([(97,), (98,)], "byte int")
    assert values(ids_for_bytes(rows, known)) == [(97, 5, False), (98, 0, True)]


def test_attributes(spark):
    arrays = spark.createDataFrame(
        [(["a", "", "c"], [6, 3], [0.5, 1.5, 2.5, 3.5])], "tokens array<string>, token_types array<int>, scores array<float>"
    )
    expected = [(0, "a", "61", 1, 0.5), (1, "[EMPTY_1]", "5B454D5054595F315D", 2, 1.5), (2, "c", "63", 0, 2.5)]
    assert values(token_table(typed_tokens_from_arrays(arrays))) == expected
    joined = with_attributes(tokens_from_arrays(arrays), attributes_from_arrays(arrays))
    assert values(token_table(joined)) == expected
    bare = arrays.select("tokens", F.lit(None).cast("array<int>").alias("token_types"), F.lit(None).cast("array<float>").alias("scores"))
    assert [r["score"] for r in token_table(typed_tokens_from_arrays(bare)).collect()] == [0.0] * 3
    assert values(vocab_summary(token_table(typed_tokens_from_arrays(arrays)))) == [(3, 1, 1, 1)]


def test_small_vocabulary(spark):
    vocab = vocabulary_64(spark)
    assert (vocab.n_merges, vocab.in_order, vocab.max_span) == (64, True, 5)
    assert vocab.byte_ids == tuple(range(256)) and vocab.unknown_bytes == ()
    rows = vocab.tokens.where("id >= 256").orderBy("id").collect()
    assert [r["tok_hex"] for r in rows] == [m.replace("+", "") for m in MERGES_64]
    merges = merges_from_arrays(model_arrays(spark))
    assert merges.count() == 64


def test_metadata(spark):
    rows = [
        (1, "tokenizer.ggml.model", '"gpt2"'),
        (1, "tokenizer.ggml.bos_token_id", "7"),
        (1, "tokenizer.ggml.add_bos_token", "true"),
        (1, "tokenizer.ggml.tokens", '["a","b"]'),
        (1, "tokenizer.ggml.token_type", "[1,6]"),
        (1, "general.size", "[[1]]"),
        (2, "tokenizer.ggml.pre", '"x"'),
    ]
    kv = spark.createDataFrame(rows, "m int, key string, j string").select("m", "key", F.parse_json("j").alias("value"))
    found = {r["m"]: r for r in select_metadata(kv, ["m"]).collect()}
    one, two = found[1], found[2]
    assert (one["model"], one["bos_id"], one["eos_id"], one["add_bos"]) == ("gpt2", 7, None, True)
    assert (one["tokens"], one["token_types"], one["scores"]) == (["a", "b"], [1, 6], None)
    assert (two["model"], two["pre"], two["add_bos"], two["tokens"]) == (None, "x", False, None)


def test_malformed_tokenizer_json(spark):
    rows = spark.createDataFrame([("a", "not json"), ("b", '{"model":{"type":"BPE","vocab":{"x":0},"merges":[]}}')], "p string, value string")
    found = {r["p"]: (r["vocab"], r["error"]) for r in parse_tokenizer_json(rows, ["p"]).collect()}
    assert found == {"a": (None, "not a byte-level BPE model: no type"), "b": ({"x": 0}, None)}


def test_pattern_spelling(spark):
    rows = spark.createDataFrame([(SPELLED_OUT_CONTRACTIONS + "| x",), ("other",)], "p string")
    assert [r[0] for r in rows.select(normalize_pattern(F.col("p"))).collect()] == [INLINE_CONTRACTIONS + "| x", "other"]


def test_tokens_of_json_files_are_read_in_place(spark):
    """No shuffle, and no text parsed twice; a model of several rows gives each id once."""

    def file(name, vocab, added):
        return (name, json.dumps({"model": {"type": "BPE", "vocab": vocab, "merges": []}, "added_tokens": added}))

    end = {"id": 1, "content": "<end>", "special": True}
    rows = [file("a", {"x": 0, "y": 1, "": 2}, [end]), file(None, {"z": 5}, []), file("empty", {}, [])]
    files = spark.createDataFrame(rows, "model string, value string")
    tokens = tokens_from_json(parse_tokenizer_json(files, ["model"]), ["model"])
    text = tokens._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Aggregate") == 0 and text.count("from_json(") <= 1
    want = {("a", 0, "x", 1), ("a", 1, "<end>", 3), ("a", 2, "[EMPTY_2]", 1), (None, 5, "z", 1)}
    got = [(r.model, r.id, r.token, r.source_type) for r in tokens.collect()]
    assert len(got) == len(want) and set(got) == want

    twice = files.union(files).union(spark.createDataFrame([file("a", {"y": 1, "w": 7}, [])], files.schema))
    got = [(r.model, r.id, r.token, r.source_type) for r in tokens_from_json(parse_tokenizer_json(twice, ["model"]), ["model"]).collect()]
    assert len(got) == 5 and set(got) == want | {("a", 7, "w", 1)}

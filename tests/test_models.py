"""Many models in one job."""

from __future__ import annotations

import json

import plain
import pytest
from pyspark.sql import functions as F

from tokenloom.fixtures import MERGES_64, spelled
from tokenloom.operators.models import MODEL, PRE_PATTERNS, models_from_metadata, tokenize_by_model

BYTES = [spelled(bytes([b])) for b in range(256)]


def entries(name, merges=(), pre="default", control=(), **scalars):
    """Metadata rows of one model."""
    pairs = [m.split("+") for m in merges]
    made = [spelled(bytes.fromhex("".join(p))) for p in pairs]
    tokens = [*BYTES, *made, *control]
    values = {
        "tokenizer.ggml.tokens": tokens,
        "tokenizer.ggml.merges": [" ".join(spelled(bytes.fromhex(side)) for side in p) for p in pairs],
        "tokenizer.ggml.token_type": [1] * (256 + len(made)) + [3] * len(control),
        "general.other": "ignored",
        **({"tokenizer.ggml.pre": pre} if pre else {}),
        **{f"tokenizer.ggml.{k}": v for k, v in scalars.items()},
    }
    return [(name, k, json.dumps(v)) for k, v in values.items()]


def table(spark, rows):
    return spark.createDataFrame(rows, f"{MODEL} string, key string, json string").select(MODEL, "key", F.parse_json("json").alias("value"))


@pytest.fixture(scope="module")
def models(spark):
    rows = [
        *entries("full", MERGES_64, control=("<s>", "<s>>", "\\E.", "é!"), bos_token_id=320, add_bos_token=True),
        *entries("short", MERGES_64[:8], pre=None, bos_token_id=3, add_bos_token=False),
        *entries("unordered", ["2074+68", "20+74", "74+68"], control=("the",)),
        *entries("numbers", MERGES_64, pre="qwen2"),
        *entries("strange", MERGES_64, pre="never heard of"),
        ("empty", "tokenizer.ggml.pre", '"default"'),
    ]
    return models_from_metadata(table(spark, rows))


def result(spark, models, rows):
    corpus = spark.createDataFrame(rows, f"doc_id long, {MODEL} string, text string")
    return {r.doc_id: (r.ids, r.n_tokens, r.ok) for r in tokenize_by_model(corpus, models).collect()}


def ids_of(text, merges):
    ranks = {tuple(bytes.fromhex(s) for s in m.split("+")): n for n, m in enumerate(merges)}
    ids = {bytes([b]): b for b in range(256)} | {a + b: 256 + n for (a, b), n in ranks.items()}
    return [i for chunk in plain.split(text) for i in plain.encode(chunk, ranks, ids)]


def test_each_row_uses_its_model(spark, models):
    text = "the tion on 12 and the"
    got = result(spark, models, [(1, "full", text), (2, "short", text), (3, "full", ""), (4, "short", "x " * 2000 + "y" * 2000)])
    assert got[1][0] == [320, *ids_of(text, MERGES_64)]
    assert got[2][0] == ids_of(text, MERGES_64[:8])
    assert got[3] == ([320], 1, True)
    assert got[4][0] == ids_of("x " * 2000 + "y" * 2000, MERGES_64[:8])


def test_unordered_merges_and_control_tokens(spark, models):
    got = result(spark, models, [(1, "unordered", " th the th"), (2, "full", "<s>>the<s>\\E.é!"), (3, "full", "<s")])
    assert got[1][0] == [256, 32, 259, 256]
    assert got[2][0] == [320, 321, *ids_of("the", MERGES_64), 320, 322, 323]
    assert got[3][0] == [320, *ids_of("<s", MERGES_64)]


def test_the_pre_tokenizer_picks_the_pattern(spark, models):
    assert "qwen2" in PRE_PATTERNS
    got = result(spark, models, [(1, "numbers", "a 12\n\nthe"), (2, "full", "a 12\n\nthe")])
    assert got[1][0] == [97, 32, 49, 50, 10, 10, *ids_of("the", MERGES_64)]
    assert got[2][0] == [320, *ids_of("a 12\n\nthe", MERGES_64)]


def test_rows_without_a_usable_model_or_text(spark, models):
    rows = [(1, "strange", "a"), (2, "empty", "a"), (3, "unknown", "a"), (4, None, "a"), (5, "full", None)]
    assert result(spark, models, rows) == {n: ([], 0, False) for n in range(1, 6)}
    errors = {r[MODEL]: r.error for r in models.facts.collect()}
    assert errors["full"] is None and errors["strange"].endswith("never heard of") and errors["empty"] == "no tokens"
    assert result(spark, models_from_metadata(table(spark, [])), rows) == {n: ([], 0, False) for n in range(1, 6)}
    assert result(spark, models, []) == {}

from __future__ import annotations

import json

from pyspark.sql import functions as F

from tokenloom.functions.content import content_json, text_part, tokens_part
from tokenloom.functions.ids import capped, first_difference, ids_or_empty, preview_text, with_bos
from tokenloom.operators.parity import parity, parity_summary
from tokenloom.operators.requests import build_count_requests, build_requests, build_tokenize_requests
from tokenloom.sources.replies import match_responses, parse_responses
from tokenloom.sources.sinks import save_token_table, write_requests


def test_content_forms(spark):
    row = spark.range(1).select(
        content_json(F.array(tokens_part(F.lit([1, 2])))).alias("lone"),
        content_json(F.array(text_part(F.lit('x"\n\u0001é')), tokens_part(F.lit([3])))).alias("mixed"),
        content_json(F.array(text_part(F.lit("x")))).alias("text"),
        content_json(F.array(tokens_part(F.array().cast("array<int>")))).alias("empty"),
    ).first()
    assert json.loads(row["lone"]) == [1, 2]
    assert json.loads(row["mixed"]) == [{"type": "text", "text": 'x"\n\u0001é'}, {"type": "input_tokens", "tokens": [3]}]
    assert json.loads(row["text"]) == [{"type": "text", "text": "x"}]
    assert json.loads(row["empty"]) == []


def test_request_bodies(spark, tmp_path):
    rows = spark.createDataFrame(
        [(1, 1, "assistant", "b", [4]), (1, 0, "user", 'a "q"', [3]), (2, 0, "user", "c", [])],
        "conv_id long, turn long, role string, text string, ids array<int>",
    )
    parts = F.when(F.col("turn") == 0, F.array(text_part(F.col("text")), tokens_part(F.col("ids")))).otherwise(
        F.array(tokens_part(F.col("ids")))
    )
    requests = build_requests(rows.withColumn("parts", parts), 'm"x', 8, 0.5, True)
    bodies = {r["request_id"]: json.loads(r["body"]) for r in requests.collect()}
    assert bodies[1] == {
        "model": 'm"x',
        "messages": [
            {"role": "user", "content": [{"type": "text", "text": 'a "q"'}, {"type": "input_tokens", "tokens": [3]}]},
            {"role": "assistant", "content": [4]},
        ],
        "max_tokens": 8,
        "temperature": 0.5,
        "stream": True,
    }
    write_requests(requests, str(tmp_path / "out"))
    lines = [json.loads(r[0]) for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert sorted(map(json.dumps, lines)) == sorted(map(json.dumps, bodies.values()))
    counts = build_count_requests(rows.where("turn = 0"), "m", "conv_id")
    assert {r["request_id"]: json.loads(r["body"]) for r in counts.collect()}[1] == {"model": "m", "input_tokens": [3]}
    asks = build_tokenize_requests(rows.where("turn = 0"), True, "conv_id")
    assert {r["request_id"]: json.loads(r["body"]) for r in asks.collect()}[2] == {
        "content": "c", "add_special": True, "parse_special": True,
    }


def test_replies(spark):
    rows = [
        (1, 200, '{"tokens":[9419, 11]}'),
        (2, 200, '{"tokens":[]}'),
        (3, 200, '{"input_tokens": 7}'),
        (4, 500, "x"),
        (5, 200, "broken"),
        (6, 500, None),
        (7, None, "y"),
    ]
    responses = spark.createDataFrame(rows, "request_id long, status int, body string")
    found = {r["request_id"]: r for r in parse_responses(responses, "tokenize").collect()}
    assert found[1]["tokens"] == [9419, 11] and found[2]["tokens"] == [] and found[3]["input_tokens"] == 7
    assert [found[i]["ok"] for i in range(1, 8)] == [True, True, True, False, False, False, False]
    assert found[4]["error"] == "tokenize returned 500: x" and found[5]["error"] is None
    assert found[6]["error"] == "tokenize returned 500: no body" and found[7]["error"] == "tokenize returned no status: y"
    requests = spark.createDataFrame([(1,), (9,)], "request_id long")
    matched = {r["request_id"]: r["answered"] for r in match_responses(requests, responses).collect()}
    assert matched == {1: True, 9: False}


def test_id_functions(spark):
    ids = F.lit([5, 6, 7])
    row = spark.range(1).select(
        with_bos(ids, F.lit(1), F.lit(True)).alias("bos"),
        with_bos(ids, F.lit(None).cast("int"), F.lit(True)).alias("no_id"),
        with_bos(ids, F.lit(1), F.lit(None).cast("boolean")).alias("unset"),
        capped(ids, 2).alias("capped"),
        ids_or_empty(F.lit(None).cast("array<int>")).alias("none"),
        preview_text(F.repeat(F.lit("é"), F.lit(400))).alias("preview"),
        first_difference(F.lit([1, 2, 3]), F.lit([1, 5])).alias("differs"),
        first_difference(F.lit([1, 2, 3]), F.lit([1, 2])).alias("shorter"),
        first_difference(F.lit([1]), F.lit([1])).alias("same"),
    ).first()
    assert row["bos"] == [1, 5, 6, 7] and row["no_id"] == row["unset"] == [5, 6, 7]
    assert row["capped"] == [5, 6] and row["none"] == [] and row["preview"] == "é" * 300
    assert (row["differs"], row["shorter"], row["same"]) == (2, 3, None)


def test_parity_finds_planted_differences(spark):
    schema = "doc_id long, ids array<int>"
    a = spark.createDataFrame([(1, [1, 2, 3]), (2, [1]), (3, []), (4, [9])], schema)
    b = spark.createDataFrame([(1, [1, 5]), (2, [1]), (3, []), (5, [9])], schema)
    found = {r["doc_id"]: tuple(r)[1:] for r in parity(a, b).collect()}
    assert found == {
        1: (False, 2, 3, 2, "both"),
        2: (True, None, 1, 1, "both"),
        3: (True, None, 0, 0, "both"),
        4: (False, None, 1, None, "a"),
        5: (False, None, None, 1, "b"),
    }
    assert tuple(parity_summary(parity(a, b)).first()) == (5, 2, 1, 1, 1)


def test_bucketed_tables_compare_without_a_shuffle(spark, tmp_path):
    tokens = spark.range(100).select(
        F.col("id").alias("doc_id"), F.array(F.col("id").cast("int")).alias("ids"), F.lit(1).alias("n_tokens"), F.lit(True).alias("ok")
    )
    for table in ("bucketed_a", "bucketed_b"):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        save_token_table(tokens, table, ["doc_id"], 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        compared = parity(spark.table("bucketed_a"), spark.table("bucketed_b"))
        plan = compared._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
        assert compared.where("equal").count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for table in ("bucketed_a", "bucketed_b"):
            spark.sql(f"DROP TABLE IF EXISTS {table}")

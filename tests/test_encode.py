from __future__ import annotations

import dataclasses
import json
import random

import pandas as pd
import plain
import pytest
from pyspark.sql import functions as F

from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from tokenloom.fixtures import END_OF_TEXT, MERGES_64, USER, large_file, spelled, vocabulary_64, vocabulary_of_file
from tokenloom.functions.chunks import chunk_array, cut_added
from tokenloom.functions.codes import MAX_ID, char_of_id, id_char, id_of_char, ids_of_state
from tokenloom.operators.dictionary import build_dictionary, count_chunks
from tokenloom.operators.encode import encode_chunks, literal_sweep, spans
from tokenloom.operators.merging import rank_merger
from tokenloom.operators.tokens import (
    detokenize,
    encode_inline,
    oov_bytes,
    pair_counts,
    token_counts,
    tokenize,
)
from tokenloom.operators.vocabulary import build_vocabulary, load_vocabulary

# Texts with their ids under the 64-merge vocabulary.
GOLDENS = {
    "Hello, world!": "72 101 108 108 111 44 32 119 283 108 100 33",
    "Hello!": "72 101 108 108 111 33",
    "The quick brown fox.": "84 264 32 113 117 105 99 107 32 98 114 111 119 110 32 102 111 120 46",
    "tokenization correctness check 123": "116 111 107 270 105 122 97 276 32 99 283 261 99 116 110 290 115 32 99 264 99 107 32 49 50 51",
    "Summarize: ": "83 117 109 109 97 114 105 122 101 58 32",
    "the the": "256 101 273",
    "!!!!!": "314 314 33",
    "It's là": "73 116 39 115 311 195 160",
    "a  b\n": "97 32 32 98 10",
    "日": "230 151 165",
    "": "",
}

ODD_TEXTS = ["\0 nul \0\0", "\U0010ffff end", "tab\tand\r\n", "ÿþ \x7f", "🙂🙂 the", "  ", "'S 'LL don'T", "the" * 700]


ONE_CHUNK = r"[\s\S]+"


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def ids_by_doc(tokens):
    return {r["doc_id"]: list(r["ids"]) for r in tokens.collect()}


def variants(vocab):
    large = dataclasses.replace(vocab, literal_merges=None)
    return {"literal": vocab, "sweep": large, "search": dataclasses.replace(large, in_order=False)}


def plain_ids(texts, merges_hex=MERGES_64):
    merges = [tuple(bytes.fromhex(s) for s in m.split("+")) for m in merges_hex]
    ids = {bytes([b]): b for b in range(256)} | {a + b: 256 + r for r, (a, b) in enumerate(merges)}
    ranks = plain.ranked(merges)
    return {
        i: [x for chunk in plain.split(t) for x in plain.encode(chunk, ranks, ids)] for i, t in enumerate(texts)
    }


@pytest.mark.parametrize("plan", ["literal", "sweep", "search"])
def test_goldens_and_odd_texts(spark, plan):
    vocab = variants(vocabulary_64(spark))[plan]
    texts = [*GOLDENS, *ODD_TEXTS]
    found = ids_by_doc(tokenize(frame(spark, texts), vocab))
    for i, text in enumerate(GOLDENS):
        assert found[i] == [int(x) for x in GOLDENS[text].split()], text
    assert found == plain_ids(texts)


@pytest.mark.parametrize("plan", ["literal", "sweep"])
def test_null_text_is_not_ok(spark, plan):
    vocab = variants(vocabulary_64(spark))[plan]
    rows = {r["doc_id"]: r for r in tokenize(frame(spark, ["the", None, ""]), vocab).collect()}
    assert [rows[i]["ok"] for i in range(3)] == [True, False, True]
    assert [rows[i]["ids"] for i in range(3)] == [[256, 101], [], []]
    assert [rows[i]["n_tokens"] for i in range(3)] == [2, 0, 0]


def random_vocabulary(spark, seed, size=400, alphabet="abcd é"):
    """Merges of earlier tokens in shuffled order, so ranks follow no order."""
    rng = random.Random(seed)
    tokens = [bytes([b]) for b in range(256)]
    letters = [bytes([b]) for b in sorted(set(alphabet.encode()))]
    pool, merges = list(letters), []
    while len(merges) < size:
        left, right = rng.choice(pool), rng.choice(pool)
        if len(left + right) <= 9 and (left, right) not in merges:
            merges.append((left, right))
            if left + right not in tokens:
                tokens.append(left + right)
                pool.append(left + right)
    rng.shuffle(merges)
    ids = {t: i for i, t in enumerate(tokens)}
    raw_tokens = spark.createDataFrame(
        [(i, spelled(t), 1, None) for t, i in ids.items()], "id int, token string, source_type int, score float"
    )
    raw_merges = spark.createDataFrame(
        [(r, spelled(a), spelled(b)) for r, (a, b) in enumerate(merges)], "rank int, left string, right string"
    )
    return build_vocabulary(raw_tokens, raw_merges), merges, ids


def test_unordered_merges_equal_plain_search(spark):
    vocab, merges, ids = random_vocabulary(spark, 7)
    assert not vocab.in_order and vocab.literal_merges is None
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcd é") for _ in range(rng.randint(0, 60))) for _ in range(150)]
    # Chunks too long for the search plan.
    texts += ["".join(rng.choice("abcd") for _ in range(n)) for n in (511, 512, 513, 1500)]
    ranks = plain.ranked(merges)
    expected = {i: [x for c in plain.split(t) for x in plain.encode(c, ranks, ids)] for i, t in enumerate(texts)}
    assert ids_by_doc(tokenize(frame(spark, texts), vocab)) == expected


def test_long_chunks_by_sweep(spark):
    vocab = dataclasses.replace(vocabulary_64(spark), literal_merges=None)
    rng = random.Random(5)
    words = ["the", "tion", "an", "en", "ch", "qu", "x", "ó"]
    texts = ["".join(rng.choice(words) for _ in range(n)) for n in (170, 171, 172, 400, 3000)]
    assert ids_by_doc(tokenize(frame(spark, texts), vocab)) == plain_ids(texts)


@pytest.mark.parametrize("in_order", [True, False])
def test_very_long_chunks_of_a_large_vocabulary(spark, in_order):
    """Random letters in one chunk; the time of both plans grows with n log n, so a megabyte takes seconds."""
    library = Tokenizer.from_file(large_file())
    vocab = vocabulary_of_file(spark, large_file(), ONE_CHUNK)
    assert vocab.in_order and vocab.n_merges == 50_000
    rng = random.Random(8)
    texts = ["".join(rng.choices("etaoinshrdlu", k=n)) for n in (16_000, 1_000_000)] + ["", "é" * 700]
    library.pre_tokenizer = ByteLevel(add_prefix_space=False, use_regex=False)
    want = {i: library.encode(t, add_special_tokens=False).ids for i, t in enumerate(texts)}
    assert ids_by_doc(tokenize(frame(spark, texts), dataclasses.replace(vocab, in_order=in_order))) == want


def test_few_spans_are_looked_up(spark):
    """Per byte of distinct chunks, under 50,000 merges."""
    vocab = vocabulary_of_file(spark, large_file())
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    chunks = count_chunks(docs, vocab).select("chunk")
    rows = chunks.select("chunk", vocab.start_state(F.col("chunk")).alias("part"))
    rows = rows.withColumn("starts", F.greatest(F.char_length("part") - 1, F.lit(1)))
    looked_up = spans(rows, vocab, ["chunk"]).count()
    size = chunks.agg(F.sum(F.octet_length("chunk"))).first()[0]
    assert looked_up / size < 2.5


def test_long_tokens_reach_over_windows(spark):
    rng = random.Random(9)
    tokens, merges, made = [(n, c) for n, c in enumerate("ab")], [], "a"
    while len(made) < 1200:
        side = rng.choice("ab")
        merges.append((len(merges), made, side))
        made += side
        tokens.append((len(tokens), made))
    raw = spark.createDataFrame([(i, t, 1, None) for i, t in tokens], "id int, token string, source_type int, score float")
    vocab = dataclasses.replace(build_vocabulary(raw, spark.createDataFrame(merges, "rank int, left string, right string"), ONE_CHUNK), literal_merges=None)
    texts = ["bb" + made + "a" + made[:900] + made + "bab"]
    ids, ranks = {t: i for i, t in tokens}, {(left, right): r for r, left, right in merges}
    want = [ids[t] for t in rank_merger()(list(texts[0]), {p: (r, p[0] + p[1]) for p, r in ranks.items()})]
    assert ids_by_doc(tokenize(frame(spark, texts), vocab)) == {0: want}


def test_heap_merging_equals_plain_merging():
    rng, merge = random.Random(4), rank_merger()
    for _ in range(3000):
        known, ranks = list("abc"), {}
        for rank in rng.sample(range(20), rng.randint(1, 8)):
            pair = rng.choice(known), rng.choice(known)
            if pair not in ranks:
                ranks[pair] = (rank, pair[0] + pair[1])
                known.append(pair[0] + pair[1])
        ids = rng.choices("abc", k=rng.randint(0, 14))
        want = list(ids)
        while pairs := [p for p in zip(want, want[1:]) if p in ranks]:
            pair, out = min(pairs, key=lambda p: ranks[p][0]), []
            while want:
                if len(want) > 1 and (want[0], want[1]) == pair:
                    out.append(ranks[pair][1])
                    del want[:2]
                else:
                    out.append(want.pop(0))
            want = out
        assert merge(ids, ranks) == want


def test_order_matters(spark):
    """Rank 0 joins ab and c, rank 1 makes ab: searching gives abc, one pass would not."""
    tokens = [(0, "a"), (1, "b"), (2, "c"), (3, "ab"), (4, "abc")]
    raw = spark.createDataFrame([(i, t, 1, None) for i, t in tokens], "id int, token string, source_type int, score float")
    merges = spark.createDataFrame([(0, "ab", "c"), (1, "a", "b")], "rank int, left string, right string")
    vocab = build_vocabulary(raw, merges)
    assert not vocab.in_order
    assert ids_by_doc(tokenize(frame(spark, ["abc", "abcab"]), vocab)) == {0: [4], 1: [4, 3]}


def test_local_minimum_is_not_enough(spark):
    tokens = [(0, "a"), (1, "b"), (2, "c"), (3, "d"), (4, "ab"), (5, "abc"), (6, "cd")]
    raw = spark.createDataFrame([(i, t, 1, None) for i, t in tokens], "id int, token string, source_type int, score float")
    merges = spark.createDataFrame(
        [(1, "a", "b"), (2, "ab", "c"), (3, "c", "d")], "rank int, left string, right string"
    )
    for vocab in variants(build_vocabulary(raw, merges)).values():
        assert ids_by_doc(tokenize(frame(spark, ["abcd"]), vocab)) == {0: [5, 3]}


def test_unknown_bytes_take_id_zero(spark):
    raw = spark.createDataFrame([(0, "z", 1, None), (1, "a", 1, None)], "id int, token string, source_type int, score float")
    merges = spark.createDataFrame([], "rank int, left string, right string")
    vocab = build_vocabulary(raw, merges)
    texts = frame(spark, ["abéa"])
    assert ids_by_doc(tokenize(texts, vocab)) == {0: [1, 0, 0, 0, 1]}
    assert texts.select(oov_bytes(F.col("text"), vocab)).first()[0] == 3


@pytest.mark.parametrize("plan", ["literal", "sweep", "search"])
def test_added_tokens(spark, plan):
    vocab = variants(vocabulary_64(spark, added=(END_OF_TEXT, USER)))[plan]
    texts = ["!<|user|>the<|endoftext|>", "<|user|><|user|>", "<|user>the", "the<|endoftext|> the", None]
    found = ids_by_doc(tokenize(frame(spark, texts), vocab))
    assert found == {
        0: [33, 321, 256, 101, 320],
        1: [321, 321],
        2: plain_ids([texts[2]])[0],
        3: [256, 101, 320, 273],
        4: [],
    }


def plainly_cut(text, added, longest):
    """(part, token) pairs: at each place from the left the longest added token, or the next place."""
    pieces, start, at = [], 0, 0
    while at < len(text):
        token = next((text[at : at + n] for n in range(longest, 0, -1) if text[at : at + n] in added), None)
        if token:
            pieces.append((text[start:at], token))
            start = at = at + len(token)
        else:
            at += 1
    return [*pieces, (text[start:], None)]


def test_cutting_out_added_tokens(spark):
    rng = random.Random(3)
    letters = "ab<|é日👍.-]^$\\"
    added = {"".join(rng.choices(letters, k=rng.randint(1, 5))) for _ in range(300)}
    texts = ["".join(rng.choices(letters + "xyz\n", k=rng.randint(0, 60))) for _ in range(200)]
    added |= {"q" * n for n in range(2, 200, 3)}
    texts += ["q" * n for n in range(1, 400, 7)] + ["", "q" * 100_000]
    found = frame(spark, texts).select("doc_id", cut_added(F.col("text"), sorted(added)).alias("p")).collect()
    for r in found:
        got = [(p.part, p.token) for p in r.p]
        want = plainly_cut(texts[r.doc_id], added, 200)
        # After the last token an empty rest may be listed or not.
        assert [p for p in got if any(p)] == [p for p in want if any(p)]
    assert frame(spark, [None]).select(cut_added(F.col("text"), ["a"])).first()[0] is None


def test_a_hundred_thousand_added_tokens(spark):
    rng = random.Random(5)
    added = sorted({"".join(rng.choices("abcdefghijklmnopqrstuvwxyz日本é", k=rng.randint(4, 9))) for _ in range(101_000)})[:100_000]
    vocab = vocabulary_64(spark)
    vocab = dataclasses.replace(vocab, literal_merges=None, added=tuple((t, 1000 + n) for n, t in enumerate(added)))
    texts = [" ".join(rng.choices(added, k=300)) + " \u00df" for _ in range(50)] + ["!" * 1000, ""]
    ids = {r["doc_id"]: r["ids"] for r in tokenize(frame(spark, texts), vocab).collect()}
    number, longest = {t: 1000 + n for n, t in enumerate(added)}, max(map(len, added))
    for n, text in enumerate(texts):
        want = [number[t] for _, t in plainly_cut(text, number, longest) if t]
        assert [i for i in ids[n] if i >= 1000] == want


def test_dictionary_too_large_to_broadcast(spark):
    vocab = dataclasses.replace(vocabulary_64(spark), literal_merges=None)
    rng = random.Random(11)
    # One chunk makes up a third of all; blank and null texts are common.
    texts = [" the" * 300 + " ".join(f"w{rng.randint(0, 999)}" for _ in range(50)) for _ in range(40)]
    texts += ["", None] * 20
    docs = frame(spark, texts)
    dictionary = build_dictionary(docs, vocab)
    assert dictionary.fits
    small = dataclasses.replace(dictionary, broadcast_rows=5, frequent_share=1 / 100)
    assert not small.fits and 0 < small.frequent().count() <= 5
    whole = {r["doc_id"]: (r["ids"], r["n_tokens"], r["ok"]) for r in tokenize(docs, vocab, dictionary=dictionary).collect()}
    split = {r["doc_id"]: (r["ids"], r["n_tokens"], r["ok"]) for r in tokenize(docs, vocab, dictionary=small).collect()}
    assert whole == split and len(whole) == len(texts)
    counts = {r["doc_id"]: r["n_tokens"] for r in token_counts(docs, vocab, ["doc_id"], small).collect()}
    assert counts == {i: n for i, (_, n, _) in whole.items()}


def test_chunk_missing_from_dictionary_is_not_ok(spark):
    vocab = vocabulary_64(spark)
    dictionary = build_dictionary(frame(spark, ["the"]), vocab)
    rows = {r["doc_id"]: r for r in tokenize(frame(spark, ["the", "the other"]), vocab, dictionary=dictionary).collect()}
    assert (rows[0]["ok"], rows[1]["ok"]) == (True, False)
    assert rows[1]["ids"] == []


@pytest.mark.parametrize("plan", ["literal", "sweep", "search"])
def test_rows_of_one_key(spark, plan):
    """Every row counts, whether or not another has its key, on every plan and on the way back."""
    vocab = variants(vocabulary_64(spark))[plan]
    texts = ["the", "an", "the", "", None, "the and the", None]
    rows = [(key, text, n) for key in (1, None) for n, text in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int")
    want = sorted(((k, n, list(plain_ids([t or ""])[0]), t is not None) for k, t, n in rows), key=str)
    with_n = tokenize(docs, vocab, keep=["n"])
    assert sorted(((r.doc_id, r.n, r.ids, r.ok) for r in with_n.collect()), key=str) == want
    found = tokenize(docs, vocab)
    assert sorted(((r.doc_id, r.ids, r.ok) for r in found.collect()), key=str) == sorted(((k, i, ok) for k, _, i, ok in want), key=str)
    back = detokenize(found, dataclasses.replace(vocab, literal_tokens=None))
    assert sorted(((r.doc_id, r.text) for r in back.collect()), key=str) == sorted(((k, t or "") for k, t, _ in rows), key=str)


@pytest.mark.parametrize("plan", ["literal", "sweep"])
@pytest.mark.parametrize("few", [True, False])
def test_counts_equal_ids(spark, plan, few):
    vocab = variants(vocabulary_64(spark))[plan]
    rows = [("a", "the the"), ("a", ""), ("b", ""), ("c", None), ("d", "日 and")]
    texts = spark.createDataFrame(rows, "lang string, text string")
    counts = {r["lang"]: r["n_tokens"] for r in token_counts(texts, vocab, ["lang"], few_groups=few).collect()}
    assert counts == {"a": 3, "b": 0, "c": 0, "d": sum(map(len, plain_ids(["日 and"]).values()))}


@pytest.mark.parametrize("small", [True, False])
def test_round_trip_and_chunks_rejoin(spark, small):
    vocab = vocabulary_64(spark)
    vocab = vocab if small else dataclasses.replace(vocab, literal_tokens=None)
    texts = [*GOLDENS, *ODD_TEXTS]
    docs = frame(spark, texts)
    back = {r["doc_id"]: r["text"] for r in detokenize(tokenize(docs, vocab), vocab).collect()}
    assert back == dict(enumerate(texts))
    joined = docs.select("doc_id", F.array_join(chunk_array(F.col("text")), "").alias("t"))
    assert {r["doc_id"]: r["t"] for r in joined.collect()} == dict(enumerate(texts))


@pytest.mark.parametrize("small", [True, False])
def test_detokenize_unknown_id_is_null(spark, small):
    vocab = vocabulary_64(spark)
    vocab = vocab if small else dataclasses.replace(vocab, literal_tokens=None)
    rows = [(1, [72, 99_999]), (2, [72]), (3, [-1]), (4, []), (5, None), (6, [72, None])]
    ids = spark.createDataFrame(rows, "doc_id long, ids array<int>")
    back = {r["doc_id"]: r["text"] for r in detokenize(ids, vocab).collect()}
    assert back == {1: None, 2: "H", 3: None, 4: "", 5: "", 6: None}


def test_pair_counts(spark):
    docs = frame(spark, ["the the", "the"])
    found = {(r["left_id"], r["right_id"]): r["n"] for r in pair_counts(build_dictionary(docs, vocabulary_64(spark))).collect()}
    assert found == {(256, 101): 2}


def test_id_coding_round_trip(spark):
    ids = [0, 1, 126, 127, 254, 255, 0xD7FE, 0xD7FF, 0xD800, 0xFFFF, 100_000, MAX_ID]
    rows = spark.createDataFrame([(i,) for i in ids], "id int")
    back = rows.select("id", char_of_id(F.col("id")).alias("c")).select("id", "c", id_of_char(F.col("c")).alias("b"))
    for r in back.collect():
        assert r["id"] == r["b"] and r["c"] == id_char(r["id"])
    state = "".join(map(id_char, ids))
    assert spark.range(1).select(ids_of_state(F.lit(state))).first()[0] == ids
    with pytest.raises(ValueError):
        id_char(MAX_ID + 1)


def test_inline_needs_a_literal_vocabulary(spark):
    with pytest.raises(ValueError):
        encode_inline(frame(spark, ["a"]), dataclasses.replace(vocabulary_64(spark), literal_merges=None))


def test_corpus_totals(spark):
    """Known totals of the given tables."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("lang", "text")
    vocab = dataclasses.replace(vocabulary_64(spark), literal_merges=None)
    counts = {r["lang"]: r["n_tokens"] for r in token_counts(docs, vocab, ["lang"], few_groups=True).collect()}
    assert counts == {"de": 243_297, "en": 759_274, "es": 183_898, "fr": 240_715}


@pytest.mark.parametrize("pairs", [True, False])
def test_tokenizer_json_file(spark, tmp_path, pairs):
    merges = [[spelled(bytes.fromhex(s)) for s in m.split("+")] for m in MERGES_64]
    vocab = {spelled(bytes([b])): b for b in range(256)}
    vocab |= {"".join(m): 256 + r for r, m in enumerate(merges)}
    body = {
        "model": {"type": "BPE", "vocab": vocab, "merges": merges if pairs else [" ".join(m) for m in merges]},
        "added_tokens": [{"id": 320, "content": "<|endoftext|>", "special": True}],
    }
    path = tmp_path / "tokenizer.json"
    path.write_text(json.dumps(body, indent=1, ensure_ascii=False))
    loaded = load_vocabulary(spark, str(path))
    assert (loaded.n_merges, loaded.in_order, loaded.added) == (64, True, (("<|endoftext|>", 320),))
    texts = ["the là<|endoftext|>"]
    assert ids_by_doc(tokenize(frame(spark, texts), loaded)) == {0: [256, 101, 311, 195, 160, 320]}


def test_pattern_of_the_file(spark, tmp_path):
    """The file's pattern is used, and text it does not match is kept."""
    body = {
        "model": {"type": "BPE", "vocab": {spelled(bytes([b])): b for b in range(256)}, "merges": []},
        "pre_tokenizer": {"type": "Sequence", "pretokenizers": [{"type": "Split", "pattern": {"Regex": "\\d+|\\s"}}]},
    }
    path = tmp_path / "tokenizer.json"
    path.write_text(json.dumps(body))
    loaded = load_vocabulary(spark, str(path))
    assert loaded.pattern == "(?U)\\d+|\\s"
    text = "ab12 c\u00a0d٣4\n\nx"
    row = spark.range(1).select(chunk_array(F.lit(text), loaded.pattern)).first()
    assert row[0] == ["ab", "12", " ", "c", "\u00a0", "d", "٣4", "\n", "\n", "x"]
    assert ids_by_doc(tokenize(frame(spark, [text]), loaded)) == {0: list(text.encode())}


BYTES_ONLY = {"type": "BPE", "vocab": {spelled(bytes([b])): b for b in range(256)}, "merges": []}


def test_byte_level_files_have_the_published_pattern(spark, tmp_path):
    path = tmp_path / "tokenizer.json"
    path.write_text(json.dumps({"model": BYTES_ONLY, "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False}}))
    loaded = load_vocabulary(spark, str(path))
    row = spark.range(1).select(chunk_array(F.lit("I'll be  there, 12\n"), loaded.pattern)).first()
    assert row[0] == ["I", "'ll", " be", " ", " there", ",", " 12", "\n"]


@pytest.mark.parametrize(
    "changed, reason",
    [
        ({"normalizer": {"type": "NFC"}}, "normalizer"),
        ({"model": BYTES_ONLY | {"ignore_merges": True}}, "ignore_merges"),
        ({"model": BYTES_ONLY | {"end_of_word_suffix": "</w>"}}, "end_of_word_suffix"),
        ({"pre_tokenizer": {"type": "Whitespace"}}, "pre_tokenizer"),
        ({"pre_tokenizer": {"type": "Split", "pattern": {"String": " "}}}, "pre_tokenizer"),
    ],
)
def test_files_that_ask_for_more_are_refused(spark, tmp_path, changed, reason):
    path = tmp_path / "tokenizer.json"
    path.write_text(json.dumps({"model": BYTES_ONLY} | changed))
    with pytest.raises(ValueError, match=reason):
        load_vocabulary(spark, str(path))


def test_fields_that_change_nothing_are_accepted(spark, tmp_path):
    idle = {"ignore_merges": False, "continuing_subword_prefix": "", "end_of_word_suffix": None, "byte_fallback": False}
    path = tmp_path / "tokenizer.json"
    path.write_text(json.dumps({"model": BYTES_ONLY | idle, "normalizer": None, "pre_tokenizer": None}))
    assert load_vocabulary(spark, str(path)).n_merges == 0


def test_null_keys_are_kept(spark):
    rows = spark.createDataFrame([(1, "the", "a"), (None, "an", "b")], "doc_id long, text string, lang string")
    for vocab in variants(vocabulary_64(spark)).values():
        found = tokenize(rows, vocab, keep=["lang"]).collect()
        assert sorted((r["lang"], r["doc_id"]) for r in found) == [("a", 1), ("b", None)]


def test_cut_characters_lose_only_their_row(spark):
    rows = spark.createDataFrame([(1, [195]), (2, [195, 169]), (3, [9999])], "doc_id long, ids array<int>")
    for vocab in variants(vocabulary_64(spark)).values():
        assert dict(detokenize(rows, vocab).collect()) == {1: None, 2: "é", 3: None}


def test_a_repeated_candidate_counts_once(spark):
    vocab = variants(vocabulary_64(spark))
    chunks = spark.createDataFrame([("!" * 5000,)], "chunk string")
    for kind in vocab.values():
        assert encode_chunks(chunks, kind).first()["n_tokens"] == 2500


def test_kept_columns(spark):
    for vocab in variants(vocabulary_64(spark)).values():
        rows = frame(spark, ["the", None]).withColumn("role", F.lit("user"))
        found = tokenize(rows, vocab, keep=["role", "text"])
        assert found.columns == ["doc_id", "role", "text", "ids", "n_tokens", "ok"]
        assert sorted((r["doc_id"], r["role"], r["text"], r["n_tokens"]) for r in found.collect()) == [
            (0, "user", "the", 2), (1, "user", None, 0),
        ]


def corpus_vocabulary(spark, texts):
    """A vocabulary of all chunk prefixes of some texts, shortest first: tens of thousands of merges."""
    prefixes = {c.encode()[:n] for t in texts for c in plain.split(t) for n in range(2, len(c.encode()) + 1)}
    merges = [(p[:-1], p[-1:]) for p in sorted(prefixes, key=lambda p: (len(p), p))]
    ids = {bytes([b]): b for b in range(256)} | {a + b: 256 + r for r, (a, b) in enumerate(merges)}
    tokens = pd.DataFrame({"id": list(ids.values()), "token": [spelled(t) for t in ids]})
    raw = spark.createDataFrame(tokens, "id int, token string").select(
        "id", "token", F.lit(1).alias("source_type"), F.lit(None).cast("float").alias("score")
    )
    pairs = pd.DataFrame(
        {"rank": range(len(merges)), "left": [spelled(a) for a, _ in merges], "right": [spelled(b) for _, b in merges]}
    )
    return build_vocabulary(raw, spark.createDataFrame(pairs, "rank int, left string, right string")), merges, ids


def test_vocabulary_of_real_size(spark):
    """Tens of thousands of merges over all documents of the smallest tables."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    vocab, merges, ids = corpus_vocabulary(spark, texts.values())
    assert vocab.in_order and vocab.n_merges == len(merges) > 20_000
    ranks = plain.ranked(merges)
    known: dict[str, list[int]] = {}
    expected = {}
    for doc, text in texts.items():
        expected[doc] = []
        for chunk in plain.split(text):
            if chunk not in known:
                known[chunk] = plain.encode(chunk, ranks, ids)
            expected[doc] += known[chunk]
    assert ids_by_doc(tokenize(docs, vocab)) == expected
    searched = dataclasses.replace(vocab, in_order=False)
    assert ids_by_doc(tokenize(docs, searched)) == expected


def test_other_model_types_are_rejected(spark, tmp_path):
    path = tmp_path / "tokenizer.json"
    path.write_text(json.dumps({"model": {"type": "Unigram", "vocab": []}}))
    with pytest.raises(ValueError, match="Unigram"):
        load_vocabulary(spark, str(path))


def test_encode_keeps_other_columns(spark):
    chunks = spark.createDataFrame([("the", 3), ("x", 1)], "chunk string, n int")
    for vocab in variants(vocabulary_64(spark)).values():
        rows = {r["chunk"]: (r["n"], r["n_tokens"]) for r in encode_chunks(chunks, vocab).collect()}
        assert rows == {"the": (3, 2), "x": (1, 1)}


def test_literal_sweep_is_one_expression(spark):
    row = spark.range(1).select(ids_of_state(literal_sweep(vocabulary_64(spark), F.lit("the")))).first()
    assert row[0] == [256, 101]


def test_equal_beginnings_are_looked_up_once(spark):
    """A chunk that repeats itself has as few spans as one round of it, and ends as by plain merging."""
    vocab = dataclasses.replace(vocabulary_64(spark), literal_merges=None)
    round_of = "the other and then there "
    rows = spark.createDataFrame([(1, round_of * 20, 480)], "number long, part string, starts int")
    state = vocab.start_state(F.col("part"))
    found = spans(rows.withColumn("part", state), vocab, ["number"])
    assert 0 < found.count() <= 2 * len(round_of)
    texts = [round_of * 400, "x" * 2000 + round_of * 50, "été que " * 300]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    whole = dataclasses.replace(vocab, pattern=r"[\s\S]+")
    want = tokenize(docs, dataclasses.replace(vocabulary_64(spark), pattern=r"[\s\S]+"))
    assert sorted(map(str, tokenize(docs, whole).collect())) == sorted(map(str, want.collect()))


# -- chunks found and merged in batches -------------------------------------

PIECES = ["a", "é", "日", "Z", "1", "²", "Ⅷ", " ", "  ", "\t", "\n", "\r", " ", " ", "\f", "'", "'s", "'LL", "'re", "'ſ", "re", "!", ".", "🙂", "\U0001d400", "\0", "́", "s", "l", "v", "e"]


def test_chunks_of_batches_equal_the_pattern(spark):
    """Chunks found by classes are those of the regular expression, also beside added tokens, and by another pattern."""
    rng = random.Random(29)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 30))) for _ in range(4_000)]
    # Every character between two others, and one text longer than a slice.
    texts += ["".join(f"x{chr(p)}1 {chr(p)}'{chr(p)}" for p in range(at, at + 4_096) if not 0xD800 <= p < 0xE000) for at in range(0, 0x20000, 4_096)]
    texts += ["", None, "'", " ", "it's <|user|>'s", "<|user|>", "word's " * 300_000]
    docs = frame(spark, texts).repartition(5)
    small = vocabulary_64(spark)
    for vocab in (small, dataclasses.replace(small, added=(USER,)), dataclasses.replace(small, pattern="[^ ]+")):
        chunks = F.explode(chunk_array(F.col("text"), vocab.pattern, vocab.added_texts)).alias("chunk")
        want = docs.select(chunks).groupBy("chunk").agg(F.count("*").alias("n"))
        found = count_chunks(docs, vocab)
        assert want.exceptAll(found).count() == 0 and found.exceptAll(want).count() == 0


@pytest.mark.parametrize("in_order", [True, False])
def test_rounds_equal_plain_merging(spark, in_order):
    if in_order:
        vocab = dataclasses.replace(vocabulary_64(spark), literal_merges=None)
    else:
        vocab, _, _ = random_vocabulary(spark, 8)
    rng = random.Random(9)
    texts = ["".join(rng.choice("abcd étheion!") for _ in range(rng.randint(0, 90))) for _ in range(600)]
    texts += ["a" * n for n in range(1, 70)] + ["!" * n for n in range(1, 70)] + ["abab" * 300, "tion" * 300]
    chunks = count_chunks(frame(spark, texts), vocab)
    rounds = encode_chunks(chunks, vocab, rounds=True)
    assert "Join" not in rounds._jdf.queryExecution().executedPlan().toString()
    want = {r.chunk: (r.n, r.state, r.n_tokens) for r in encode_chunks(chunks, vocab).collect()}
    assert {r.chunk: (r.n, r.state, r.n_tokens) for r in rounds.collect()} == want

"""Operators that work on each text by itself, against plain versions."""

from __future__ import annotations

import random
import re
import time
from collections import Counter

import brute
import numpy as np
import pyarrow as pa
import pytest
from conftest import SMALL, TEXTS
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tokenloom.llm import attribution, bpe, codec, fingerprints, pii, quality, secrets, trigrams
from tokenloom.llm.arrow import Texts, slices
from tokenloom.llm.catalog import ENTRIES
from tokenloom.llm.words import shingle_sets

PATH = bpe.default_path()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def documents(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    return sorted((r.doc_id, r.text) for r in rows)


def noise(seed: int, characters: list[str], count: int, longest: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choices(characters, k=rng.randint(0, longest))) for _ in range(count)]


def test_slices_cover_every_row_once():
    batch = pa.RecordBatch.from_pydict({"n": list(range(9)), "text": ["x" * n for n in (5, 0, 9, 30, 1, 1, 0, 50, 2)]})
    for source in (batch, batch.slice(2, 6)):
        parts = list(slices(source, "text", 10))
        assert [n for p in parts for n in p.column("n").to_pylist()] == source.column("n").to_pylist()
        assert all(p.num_rows == 1 or sum(map(len, p.column("text").to_pylist())) <= 10 for p in parts)


def test_shingles():
    texts = [t or "" for _, t in TEXTS] + noise(5, ["a", "B", " ", "\n", "é "], 300, 40)
    sets = shingle_sets(Texts(pa.array(texts)))
    assert [len(s) for s in sets] == [len(brute.shingles(t)) for t in texts]
    spelt = [frozenset(brute.shingles(t)) for t in texts]
    hashed = [frozenset(s.tolist()) for s in sets]
    assert all((spelt[i] == spelt[j]) == (hashed[i] == hashed[j]) for i in range(len(texts)) for j in range(0, i, 7))


def test_encoding_equals_the_library(library):
    characters = list(" \t\n\r\x0b\x1c\x85\xa0 　​'aAbtsvmldreL01²½.,!-_$é日ß👍🏽") + ["  ", "'ll", "<|endoftext|>", "<|endo", " the"]
    texts = [*noise(1, characters, 3000, 50), "", "a" * 5000, " " * 3000, *(t or "" for _, t in TEXTS)]
    coder = codec.codec(PATH)
    ids, counts = coder.encode(texts)
    parts = np.split(ids, np.cumsum(counts)[:-1])
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [p.tolist() for p in parts] == want
    assert coder.decode(ids, counts) == [library.decode(w, skip_special_tokens=False) for w in want]
    fast = bpe.fast_encoding(PATH)
    assert [fast.encode(t, allowed_special="all") for t in texts] == want


HUGE = {
    "spaces": "a" + " " * 2_000_000 + "b",
    "new lines": "\n" * 2_000_000,
    "one letter": "a" * 2_000_000,
    "letters": "".join(random.Random(2).choices("abcdefghijklmnop", k=500_000)),
}


@pytest.mark.parametrize("kind", HUGE)
def test_very_long_texts(library, kind):
    text = HUGE[kind]
    want = library.encode(text, add_special_tokens=False).ids
    assert bpe.encode(PATH, text) == want
    ids, counts = codec.codec(PATH).encode(["x", text, "y z"])
    assert ids[counts[0] : counts[0] + counts[1]].tolist() == want
    starts, ends = attribution.token_spans(text, PATH, attribution._token_sizes(PATH))
    assert len(starts) == len(want) and ends[-1] == len(text)


def test_decoding_cut_and_unknown_ids(library):
    coder = codec.codec(PATH)
    cut = library.encode("日", add_special_tokens=False).ids[:1]
    assert coder.decode(np.array([*cut, 10**6, -1]), np.array([1, 2])) == [library.decode(cut), ""]


def test_the_codec_forgets(monkeypatch, library):
    monkeypatch.setattr(codec, "AT_HAND", 5)
    coder = codec.Codec(bpe.read_byte_bpe(PATH))
    for text in ["one two three four five six seven", "one nine ten", "y" * 100 + " one"] * 2:
        assert coder.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids
        assert all(len(p) <= codec.LONGEST_AT_HAND for p in coder.known)


def test_encoded_tables(spark, texts, nothing, full):
    encoded = codec.encode_texts(full, PATH, ["doc_id", "id"])
    back = {r.doc_id: r.text for r in codec.decode_ids(encoded, PATH, ["doc_id"]).collect()}
    assert {i: t or "" for i, t in TEXTS} == {i: t for i, t in back.items() if i}
    rows = {r.doc_id: r for r in codec.round_trips(texts, PATH).collect()}
    assert all(rows[i].decoded_sha256 == brute.sha(t or "") for i, t in TEXTS)
    assert codec.round_trips(nothing, PATH).count() == 0


def test_unknown_vocabulary_features_are_refused(tmp_path):
    import json

    content = json.loads(open(PATH, encoding="utf-8").read())
    content["normalizer"] = {"type": "NFC"}
    other = tmp_path / "t.json"
    other.write_text(json.dumps(content))
    with pytest.raises(ValueError):
        bpe.read_byte_bpe(str(other))


@pytest.mark.parametrize("rule", attribution.RULES)
def test_allocation(rule):
    sizes = attribution._token_sizes(PATH)
    rng = random.Random(7)
    for text in noise(2, [*"ab \n\n\né日👍🏽the'", "\n\n\n\n", "the "], 400, 30):
        tokens = attribution.token_spans(text, PATH, sizes)
        cuts = sorted(tuple(sorted((rng.randint(0, len(text)), rng.randint(0, len(text))))) for _ in range(4))
        for sections in (attribution.line_sections(text), (np.array([a for a, _ in cuts]), np.array([b for _, b in cuts]))):
            counts, crossing = attribution.allocate(tokens, sections, rule)
            for n, (s, e) in enumerate(zip(*sections, strict=True)):
                met = [(a, b) for a, b in zip(*tokens, strict=True) if min(b, e) > max(a, s)]
                share = {
                    "first": [s <= a for a, _ in met],
                    "last": [b <= e for _, b in met],
                    "share": [(min(b, e) - max(a, s)) / (b - a) for a, b in met],
                }[rule]
                assert counts[n] == pytest.approx(sum(share))
                assert crossing[n] == sum(not (s <= a and b <= e) for a, b in met)
        assert attribution.allocate(tokens, attribution.line_sections(text), rule)[0].sum() == pytest.approx(len(tokens[0]))


def test_attribution_tables(spark, texts, nothing, full, library):
    counted = attribution.attribute_tokens(full, PATH, ["doc_id", "found"]).where("doc_id IS NOT NULL")
    sums = {r.doc_id: r.n for r in counted.groupBy("doc_id").agg(F.sum("n_tokens").alias("n")).collect()}
    assert sums == {i: len(library.encode(t or "", add_special_tokens=False).ids) for i, t in TEXTS}
    assert attribution.attribute_tokens(nothing, PATH, ["doc_id"]).count() == 0
    text, spans = attribution.joined_fields([F.col("source"), F.col("text"), F.col("lang")])
    fields = full.where("doc_id IN (4, 5, 10)").select("doc_id", text.alias("text"), spans.alias("fields"))
    rows = attribution.attribute_tokens(fields, PATH, ["doc_id"], sections="fields").orderBy("doc_id", "section").collect()
    assert [(r.doc_id, r.section) for r in rows] == [(i, k) for i in (4, 5, 10) for k in range(3)]
    assert [(r.start, r.end) for r in rows[:3]] == [(0, 2), (2, 10), (10, 10)]


def test_quality_counts(documents):
    rows = [*TEXTS, *documents[:80], *enumerate(noise(3, ["a", "b", " ", "\n", "é", "# ", "a b c d e "], 400, 60))]
    counts = quality.base_counts(Texts(pa.array([t or "" for _, t in rows])))
    got = list(zip(*(c.tolist() for c in counts.values()), strict=True))
    assert got == [brute.quality(t)[:5] for _, t in rows]


def test_quality_distance():
    counts = np.array([[5, 5], [0, 10], [0, 0]])
    even = np.array([[0.5, 0.5]])
    assert quality.nearest_distance(counts, even) == pytest.approx([0, 0.5579230, 0], abs=1e-6)
    assert quality.nearest_distance(counts, np.zeros((0, 2))).tolist() == [0, 0, 0]


def test_quality_tables(spark, texts, nothing, full):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    references = quality.fit_references(docs, labels)
    assert "en" in references.languages
    junk = ["THE!! AND!! WAS!! " * 40, "word*** other### more$$$ " * 40]
    rows = {r.doc_id: r for r in quality.judge(texts, references, ["doc_id"]).collect()}
    assert [rows[i].base_failed for i, _ in TEXTS] == [brute.quality(t)[5] for _, t in TEXTS]
    assert rows[10].kept and rows[11].kept and not rows[2].kept
    table = spark.createDataFrame([(n, " ".join(f"{w}{k}" for k, w in enumerate(t.split()))) for n, t in enumerate(junk)], "doc_id long, text string")
    assert not quality.judge(table, references, ["doc_id"]).where("kept OR base_failed").count()
    assert quality.judge(nothing, references, ["doc_id"]).count() == 0
    empty = quality.fit_references(docs, labels.limit(0))
    assert quality.judge(texts, empty, ["doc_id"]).where("NOT kept AND NOT base_failed").count() == 0
    kept = quality.keep_good(spark, full, SMALL)
    assert kept.columns == full.columns and {r.doc_id for r in kept.collect()} >= {10, 11, 12}


def jensen_shannon(p, q):
    def part(a):
        return sum(x * np.log2(2 * x / (x + y)) for x, y in zip(a, q if a is p else p, strict=True) if x)

    return np.sqrt(max(0.0, (part(p) + part(q)) / 2))


def test_quality_references_cover_every_labelled_document(spark):
    texts = [f"word{n % 7} ist " + "!" * (n % 5) for n in range(2500)]
    docs = spark.createDataFrame([(n, t, "xo") for n, t in enumerate(texts)], "doc_id long, text string, lang string")
    references = quality.fit_references(docs, docs.selectExpr("doc_id", "1 AS quality"))
    counts = Counter(w[:-1] if len(w) > 1 and w[-1] == "!" else w for t in texts for w in t.split())
    want = sorted(c / sum(counts.values()) for c in counts.values())
    assert sorted(references.words[0, :-1]) == pytest.approx(want, abs=1e-12)
    marks = sum(t.count("!") for t in texts)
    kinds = Counter(k for t in texts for k in (("space" if c == " " else "mark" if c == "!" else "lower") for c in t if not c.isdigit()))
    assert references.classes[0, quality.CLASSES.index("mark")] == pytest.approx(marks / sum(kinds.values()), abs=1e-12)


def test_quality_verdicts_against_a_plain_version(spark):
    """Bounds from the labelled documents: unknown words go, other scripts and languages without a reference stay."""
    rng = random.Random(12)
    common = {lang: [f"{lang}{k}" for k in "abcdefghij"] for lang in ("xo", "yu")}

    def prose(lang, count):
        return " ".join(rng.choice(common[lang]) if rng.random() < 0.5 else "".join(rng.choices("aeioulmnrst", k=5)) for _ in range(count))

    def gibberish(count):
        return " ".join("".join(rng.choices("aeioulmnrst", k=5)) for _ in range(count))

    good = [(n, prose(lang, rng.choice([50, 100, 250, 600])), lang) for n, lang in enumerate(["xo", "yu"] * 200)]
    other = [(1000 + n, gibberish(300), "xo") for n in range(10)]
    other += [(1100 + n, " ".join("".join(rng.choices("абвгдежз", k=6)) for _ in range(100)), "ru") for n in range(3)]
    other += [(1200, "слово " + " ".join("".join(rng.choices("абвгдежз", k=6)) for _ in range(100)), None), (1300, prose("yu", 300), "xo")]
    other += [(1400, " ".join("".join(rng.choices("абвгдежз", k=6)) for _ in range(100)), "xo"), (1500, gibberish(30), "xo")]
    docs = spark.createDataFrame([*good, *other], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i, _, _ in good] + [(1100, 1)], "doc_id long, quality int")
    references = quality.fit_references(docs, labels)
    assert references.languages == ("xo", "yu")

    def words(text):
        return brute.words(brute.ascii_lower(text))

    counts = {lang: Counter(w for _, t, own in good if own == lang for w in words(t)) for lang in common}
    vocabulary = sorted({w for c in counts.values() for w, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[: quality.TOP_WORDS]})

    def shares(counter):
        total = sum(counter.values())
        known = [counter[w] / total for w in vocabulary]
        return [*known, 1 - sum(known)]

    reference = [shares(c) for c in counts.values()]

    def distance(text):
        return min(jensen_shannon(shares(Counter(words(text))), q) for q in reference)

    near = {}
    for _, text, _ in good:
        near.setdefault(len(words(text)).bit_length() - 1, []).append(distance(text))
    unknown = min(jensen_shannon([0] * len(vocabulary) + [1], q) for q in reference)
    rows = {r.doc_id: r for r in quality.judge(docs, references, ["doc_id"]).collect()}
    for i, text, lang in [*good, *other]:
        assert rows[i].word_distance == pytest.approx(distance(text))
        n = len(words(text))
        if rows[i].base_failed or n < quality.MIN_WORDS or lang not in ("xo", "yu"):
            assert rows[i].kept != rows[i].base_failed
            continue
        own = sorted(near[max(k for k in near if k <= n.bit_length() - 1 and len(near[k]) >= quality.LEAST_IN_OCTAVE)])
        upper = own[int(np.ceil(quality.QUANTILE * len(own))) - 1]
        far = rows[i].class_distance > quality.MAX_CLASS_DISTANCE or rows[i].word_distance > (upper + unknown) / 2
        assert rows[i].kept == (not far)
    kept = {i for i, r in rows.items() if r.kept}
    assert {i for i, _, _ in good} <= kept and {1100, 1101, 1102, 1200, 1300, 1500} <= kept
    assert not kept & {1400, *range(1000, 1010)}


def test_quality_keeps_labelled_good_documents(spark):
    judged = ENTRIES["op10_quality_rules"].run(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("quality = 1")
    rows = judged.where("NOT base_failed").join(labels, "doc_id").select("kept").collect()
    assert len(rows) > 100 and all(r.kept for r in rows)


def test_personal_data(documents):
    characters = [*"ab1239045.@-+ ()%_0\n", "255", "4111111111111111", "a@b.c", "1.2.3.4"]
    texts = [*(t or "" for _, t in TEXTS), *(t for _, t in documents), *noise(4, characters, 5000, 25)]
    assert [pii.base_spans(t) for t in texts] == [brute.personal_data(t) for t in texts]


def test_the_field_learns_its_table_and_adds_spans():
    model = pii.default_model()
    held_out = {
        "please call 555-0188 about it": ("phone", 12, 20),
        "her ssn 123-45-6789 is known": ("id", 8, 19),
        "email bob.ray@intranet today": ("email", 6, 22),
    }
    for text, span in held_out.items():
        assert pii.all_spans([text], model)[1][0] == [span]
    plain = ["In 1987 there were 33 of them", "no numbers here", "", "a 1\n" * 50]
    assert pii.all_spans(plain, model)[1] == [[]] * 4


def test_viterbi_and_likelihood_against_enumeration():
    import itertools

    from tokenloom.llm import crf
    from tokenloom.llm.words import Words

    rng = np.random.default_rng(0)
    scores, real = rng.normal(size=(1, 4, 3)), np.ones((1, 4), bool)
    moves = rng.normal(size=(3, 3))
    paths = list(itertools.product(range(3), repeat=4))
    value = np.array([sum(scores[0, t, p[t]] for t in range(4)) + sum(moves[p[t], p[t + 1]] for t in range(3)) for p in paths])
    share = np.exp(value) / np.exp(value).sum()
    got, between = crf._expected(scores, real, moves)
    assert got[0, 2, 1] == pytest.approx(sum(s for s, p in zip(share, paths, strict=True) if p[2] == 1))
    assert between[0, 2] == pytest.approx(sum(s * sum(p[t] == 0 and p[t + 1] == 2 for t in range(3)) for s, p in zip(share, paths, strict=True)))
    model = pii.default_model()
    line = Texts(pa.array(["call 555-0123 or 7 now", "x"]))
    own = Words(line)
    numbers, _ = crf.features(line, own, model.keywords)
    emission = model.weights[numbers].sum(1)[:5]
    kinds = range(len(model.labels))
    best = max(itertools.product(kinds, repeat=5), key=lambda p: sum(emission[t, p[t]] for t in range(5)) + sum(model.moves[p[t], p[t + 1]] for t in range(4)))
    assert crf.decode(model, line, own)[:5].tolist() == list(best)


def test_personal_data_tables(spark, texts, nothing, full):
    rows = {r.doc_id: r for r in pii.find_personal_data(texts, ["doc_id"]).collect()}
    assert all(rows[i].base_sha256 == brute.sha(pii.spelt(brute.personal_data(t))) for i, t in TEXTS)
    assert (rows[15].n_email, rows[15].n_ip, rows[15].n_card, rows[15].n_phone) == (1, 1, 1, 1)
    assert pii.find_personal_data(nothing, ["doc_id"]).count() == 0
    clean = pii.redact_documents(spark, full, SMALL)
    assert clean.columns == full.columns
    found = {r.doc_id: r for r in clean.collect()}
    assert found[1].text is None and found[1].n_chars is None and found[10].text == dict(TEXTS)[10]
    assert "<EMAIL>, <IP> <PHONE>; card <CARD>" in found[15].text and found[15].n_chars == len(found[15].text)
    assert pii.redacted("abcdef", [("ip", 1, 3), ("card", 2, 5)]) == "a<IP>f"


def test_trigram_queries():
    assert trigrams.trigram_query("AKIA[A-Z0-9]+") == [frozenset({"aki", "kia"})]
    assert trigrams.trigram_query("[0-9a-f]+") is None
    assert trigrams.trigram_query("(abc|xy)d*") is None
    assert trigrams.trigram_query("(abcd|xyz)+q?") == [frozenset({"abc", "bcd"}), frozenset({"xyz"})]
    assert trigrams.trigram_query("x[ab]yz") == [frozenset({"ayz", "xay"}), frozenset({"byz", "xby"})]


def test_secrets(spark, documents):
    pieces = ["token", "API_KEY", "apikey", "AKIA", "ABCDEF0123456789", "0123456789abcdef", "=", ":", '"', " ", "secret", "é", "\n", "x"]
    rows = [*TEXTS, *((100 + n, t) for n, t in enumerate(noise(6, pieces, 300, 14)))]
    found = secrets.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    base = {r.id: [(s.kind, s.start, s.end) for s in r.spans if s.order < 3] for r in found}
    assert base == {i: brute.secrets(t) for i, t in rows}


def test_added_secret_kinds_and_odd_rows(spark, nothing):
    samples = [
        ("github", "ghp_" + "a1B2" * 9),
        ("slack", "xoxb-1234567890-abc"),
        ("google", "AIza" + "x" * 35),
        ("stripe", "sk_live_" + "9" * 16),
        ("key_block", "-----BEGIN RSA PRIVATE KEY-----"),
        ("jwt", "eyJhbGci.eyJzdWIi.abc-_"),
        ("bearer", "Bearer " + "t." * 10),
    ]
    rows = [(None, f"é {s} end") for _, s in samples] * 2 + [(1, None), (1, "")]
    found = secrets.scan(spark.createDataFrame(rows, "doc_id long, text string"))
    kinds = sorted(s.kind for r in found.collect() for s in r.spans if s.order > 2)
    assert kinds == sorted(2 * [k for k, _ in samples]) and found.count() == len(rows)
    assert secrets.scan(nothing).count() == 0


def test_token_runs_that_lead_to_no_match(spark):
    """The faster expression finds what the plain one does."""
    plain = {r.kind: r.pattern for r in secrets.RULES}["jwt"]
    rng = random.Random(9)
    texts = ["".join(rng.choices(["eyJ", "eyJa", ".eyJb", ".c", "_", " ", "é"], k=rng.randint(1, 30))) for _ in range(400)]
    found = secrets.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    got = {r.id: [(s.start, s.end) for s in r.spans if s.kind == "jwt"] for r in found.collect()}
    want = {n: [m.span() for m in re.finditer(plain, t)] for n, t in enumerate(texts)}
    assert got == want and sum(map(len, want.values())) > 20


LONG_RUNS = ["eyJ", "token ", "secret=", "AKIA", "0123456789abcde ", "ghp_", "xoxb-", "AIza", "sk_live_", "-----BEGIN ", "-----BEGIN RSA PRIVATE KEY", "Bearer ", " ", "password:" + " " * 50, '"']


def test_a_megabyte_of_each_rules_beginning(spark):
    rows = [(n, piece * (1_000_000 // len(piece)) + (" .eyJ" if piece == "eyJ" else "")) for n, piece in enumerate(LONG_RUNS)]
    started = time.monotonic()
    found = secrets.scan(spark.createDataFrame(rows, "doc_id long, text string").repartition(8))
    counts = {r.id: len(r.spans) for r in found.collect()}
    assert time.monotonic() - started < 60 and counts[0] == 0 and len(counts) == len(rows)


def test_running_sums(spark):
    for n in (0, 1, 255, 256, 257, 70_000):
        row = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(max(n, 1))), lambda x: (x % 7).cast("int")).alias("a"))
        row = row if n else row.select(F.array().cast("array<int>").alias("a"))
        got = row.select("a", secrets.running_sums(F.col("a")).alias("s")).first()
        assert got.s == np.cumsum(got.a).tolist()


def test_fingerprints(spark, texts, nothing, documents):
    for rows in (TEXTS, documents):
        table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
        found = {r.id: r for r in fingerprints.fingerprint_pairs(table).collect()}
        assert len(found) == len(rows)
        for n, (i, text) in enumerate(rows):
            text, following = text or "", rows[(n + 1) % len(rows)][1] or ""
            half = len(text) // 2
            changed = text[: len(text) - half] + following[:half]
            assert (found[i].n_chars, found[i].edited_sha256) == (len(text), brute.sha(changed))
            own = brute.shingles(text)
            assert found[i].near_next == pytest.approx(brute.jaccard(own, brute.shingles(following)), abs=0.2)
            assert found[i].near_edited == pytest.approx(brute.jaccard(own, brute.shingles(changed)), abs=0.2)
        by_text = {}
        for i, text in rows:
            assert by_text.setdefault(text or "", found[i].fingerprint) == found[i].fingerprint
    assert fingerprints.fingerprint_pairs(nothing).count() == 0


def test_fingerprint_order_with_ties_and_nulls(spark):
    rows = [(None, "b c d"), (None, "a"), (5, "x y"), (5, "x y"), (5, None), (7, "z")]
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want = []
    for n, (i, text) in enumerate(order):
        text, following = text or "", order[(n + 1) % len(order)][1] or ""
        want.append((i, brute.sha(text[: len(text) - len(text) // 2] + following[: len(text) // 2])))
    got = fingerprints.fingerprint_pairs(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted(((r.id, r.edited_sha256) for r in got), key=str) == sorted(want, key=str)
    one = fingerprints.fingerprint_pairs(spark.createDataFrame([(9, "ab")], "doc_id long, text string")).first()
    assert (one.near_next, one.edited_sha256) == (1.0, brute.sha("aa"))


def test_similar_documents_by_bands(spark, documents):
    rows = [*documents, *((1000 + n, documents[n][1]) for n in range(5))]
    pairs = {(r.a, r.b) for r in fingerprints.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = {i: brute.shingles(t) for i, t in rows}
    assert all(brute.jaccard(sets[a], sets[b]) >= 0.75 for a, b in pairs)
    for n in range(5):
        assert any(1000 + n in p for p in pairs) or not sets[1000 + n]


def test_similar_documents_of_one_template(spark):
    """Sixty documents on one template, 0.7 alike and so no pairs, and thirty that are 0.77 alike with one of them."""
    rng = random.Random(12)

    def words(n):
        return [f"w{rng.randrange(10**9)}" for _ in range(n)]

    template = words(280)
    first = [template + words(60) for _ in range(60)]
    second = [d[:-22] + words(22) for d in first[30:]]
    rows = [(n, " ".join(d)) for n, d in enumerate(first + second)]
    rows += [(200, None), (201, ""), (202, rows[0][1]), (None, rows[0][1])]
    links = {(r.a, r.b) for r in fingerprints.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = {i: brute.shingles(t or "") for i, t in rows if i is not None}
    close = {(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and brute.jaccard(sets[a], sets[b]) >= 0.75}
    assert links == close and len(close) == 31

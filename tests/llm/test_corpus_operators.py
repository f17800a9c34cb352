"""Operators that work across documents, and the pipeline, against plain versions."""

from __future__ import annotations

import itertools
import random
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from compare import connect, spark_rows, sql_rows
from conftest import SMALL, TEXTS
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tokenloom.llm import bpe, lines, lookup, near, packing, pii, quality, urls
from tokenloom.llm.catalog import ENTRIES
from tokenloom.llm.components import components

PATH = bpe.default_path()


@pytest.fixture(scope="module")
def documents(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    return sorted((r.doc_id, r.text) for r in rows)


@pytest.mark.parametrize("name", [n for n, e in ENTRIES.items() if e.sql])
def test_query_equals_sql(spark, name):
    assert spark_rows(ENTRIES[name].run(spark, SMALL)) == sql_rows(connect(SMALL), ENTRIES[name].sql)


@pytest.mark.parametrize("name", [n for n, e in ENTRIES.items() if not e.sql])
def test_query_has_every_row(spark, name):
    table = "pages" if name.startswith("op1_") else "documents"
    key = "page_id" if table == "pages" else "doc_id"
    want = {r[0] for r in spark.read.parquet(f"{SMALL}/{table}.parquet").select(key).collect()}
    assert {r[0] for r in ENTRIES[name].run(spark, SMALL).select(key).collect()} == want


def test_lookup_of_heavy_and_light_keys(spark, monkeypatch):
    monkeypatch.setattr(lookup, "HEAVY", 3)
    rows = spark.createDataFrame([(n, k) for n, k in enumerate("aaaaaaaabbc")] + [(99, None), (100, "z")], "n long, k string")
    table = spark.createDataFrame([("a", 8, "A"), ("b", 2, "B"), ("c", 1, "C")], "k string, w long, v string")
    got = {r.n: r.v for r in lookup.find(rows, table, ["k"], "w", "v").collect()}
    assert got == {**{n: k.upper() for n, k in enumerate("aaaaaaaabbc")}, 99: None, 100: None}


def test_components_of_chains_stars_and_rings(spark):
    chain = [(n, n + 1) for n in range(100, 160)]
    random.Random(1).shuffle(chain)
    links = [*chain, *((7, n) for n in range(200, 260)), (1, 2), (2, 3), (3, 1), (9, 9), (5, 4), (4, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {n: 100 for n in range(100, 161)} | {n: 7 for n in (7, *range(200, 260))} | {1: 1, 2: 1, 3: 1, 4: 4, 5: 4}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_line_dedup(spark, texts, nothing, documents):
    for rows in (TEXTS, documents):
        got = lines.without_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"))
        assert {r.id: (r.n_lines, r.n_dropped, r.kept) for r in got.collect()} == brute.kept_lines(rows)
    assert lines.without_repeated_lines(nothing).count() == 0


def test_line_dedup_of_repeated_and_null_ids(spark):
    line = "a line that is long enough"
    rows = [(1, line), (1, line), (2, f"x\n{line}\n{line}"), (3, line), (3, line), (None, f"{line}\ny"), (4, None)]
    got = lines.without_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    kept = sorted(((r.id, r.kept) for r in got), key=str)
    assert kept == sorted([(1, ""), (1, ""), (2, "x"), (3, line), (3, line), (None, "y"), (4, "")], key=str)


def near_result(df):
    return {r.id: (r.n_shingles, r.component_id, r.kept) for r in near.near_duplicates(df).collect()}


def expected_near(rows):
    groups = brute.near_groups(rows)
    return {i: (len(brute.shingles(t)), groups[i], groups[i] == i) for i, t in rows}


def edits(base: list[str], count: int, rng: random.Random) -> str:
    own = list(base)
    for at in rng.sample(range(len(own)), count):
        own[at] = f"w{rng.random():.9f}"
    return " ".join(own)


def test_near_duplicates(spark, nothing, documents):
    for rows in (TEXTS, documents):
        assert near_result(spark.createDataFrame(rows, "doc_id long, text string")) == expected_near(rows)
    assert near.near_duplicates(nothing).count() == 0


@pytest.mark.parametrize("hot", [2, near.HOT])
def test_large_groups_of_near_copies(spark, monkeypatch, hot):
    """Copies with few to many changes, so that some reach the group through others and some not at all."""
    monkeypatch.setattr(near, "HOT", hot)
    rng = random.Random(11)
    rows, number = [], 0
    passage = [f"p{n}" for n in range(60)]
    for size in (40, 90, 300):
        base = [f"b{size}x{n}" for n in range(size)]
        for share in (0.004, 0.01, 0.02, 0.03, 0.05, 0.1):
            for _ in range(12):
                rows.append((number := number + 1, edits(base, max(1, round(share * size)), rng)))
        rows += [(number := number + 1, " ".join(base))] * 1
        chain = base
        for _ in range(10):  # each is close to the one before
            chain = edits(chain, max(1, size // 40), rng).split(" ")
            rows.append((number := number + 1, " ".join(chain)))
    for n in range(60):  # unrelated texts that share a long passage
        own = [f"u{n}x{k}" for k in range(rng.choice([5, 15, 30, 80]))]
        rows.append((number := number + 1, " ".join([*own, *passage])))
    rng.shuffle(rows)
    assert near_result(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)) == expected_near(rows)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_families_whose_members_lie_around_the_threshold(spark, monkeypatch, seed):
    """Words are changed, dropped, added or taken from few others, so that members are from 60 to 90 % alike."""
    monkeypatch.setattr(near, "HOT", 3)
    monkeypatch.setattr(near, "MEMBERS", 7)
    rng = random.Random(seed)
    rows = []
    for family, size in enumerate((60, 60, 150)):
        base = [f"f{family if seed > 1 else min(family, 1)}w{n}" for n in range(size)]
        for _ in range(60):
            own = list(base[: rng.choice([size, size, size - size // 8])])
            for _ in range(rng.randint(0, size // 20)):
                at = rng.randrange(len(own))
                match rng.randrange(4):
                    case 0:
                        own[at] = rng.choice(["x", "y"])
                    case 1:
                        own[at] = f"n{rng.random()}"
                    case 2:
                        del own[at]
                    case 3:
                        own.insert(at, rng.choice(["x", "y", f"n{rng.random()}"]))
            own += [f"t{k}" for k in range(rng.choice([0, 0, 0, size // 6]))]
            rows.append((len(rows) + 1, " ".join(own)))
    rng.shuffle(rows)
    assert near_result(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)) == expected_near(rows)


def test_near_duplicates_with_repeated_and_null_ids(spark):
    text = " ".join(f"w{n}" for n in range(50))
    rows = [(4, text), (4, text), (9, text), (None, text), (None, None), (5, None), (6, "")]
    got = near.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = [(4, 46, 4, True)] * 2 + [(9, 46, 4, False), (None, 46, None, True), (None, 0, None, True), (5, 0, 5, True), (6, 0, 6, True)]
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)


def test_packing_places_every_token(spark, nothing, documents):
    library = Tokenizer.from_file(PATH)
    for rows in (TEXTS, documents):
        table = spark.createDataFrame(rows, "doc_id long, text string")
        pieces = packing.written(packing.cut_pieces(table, PATH), "pieces")
        packed = packing.pack(pieces)
        found = defaultdict(list)
        places = defaultdict(list)
        for r in packed.collect():
            found[r.id].append(r)
            places[r.sequence_id].append((r.offset, r.length))
        for i, text in rows:
            ids = [*library.encode(text or "", add_special_tokens=False).ids, packing.END_ID]
            own = sorted(found[i], key=lambda r: r.piece)
            assert [t for r in own for t in r.ids] == ids
            assert [r.piece for r in own] == list(range(len(own)))
            assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and r.length == len(r.ids) for r in own)
            assert [r.length for r in own[1:]] == [packing.MAX_LENGTH] * (len(own) - 1)
        for parts in places.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= packing.MAX_LENGTH
        total = sum(n for parts in places.values() for _, n in parts)
        halves = sum(2 * n > packing.MAX_LENGTH for parts in places.values() for _, n in parts)
        assert len(places) <= max(halves, 1.02 * total / packing.MAX_LENGTH + 1)
        joined = {r.sequence_id: r for r in packing.sequences(packed).collect()}
        assert all(len(joined[s].ids) == sum(n for _, n in parts) for s, parts in places.items())
    assert packing.pack(packing.written(packing.cut_pieces(nothing, PATH), "pieces")).count() == 0


def test_packing_of_very_long_white_space(spark):
    rows = [(1, "a" + " " * 2_000_000 + "b"), (2, "c")]
    pieces = packing.written(packing.cut_pieces(spark.createDataFrame(rows, "doc_id long, text string"), PATH, with_ids=False), "pieces")
    want = [len(Tokenizer.from_file(PATH).encode(t, add_special_tokens=False).ids) + 1 for _, t in rows]
    got = Counter()
    for r in packing.pack(pieces).collect():
        got[r.id] += r.length
    assert [got[1], got[2]] == want


def test_piece_bounds():
    assert packing.piece_bounds(5, 4) == [(0, 1), (1, 4)]
    assert packing.piece_bounds(8, 4) == [(0, 4), (4, 4)]
    assert packing.piece_bounds(4, 4) == [(0, 4)]
    assert packing.piece_bounds(1, 4) == [(0, 1)]


@pytest.mark.parametrize("seed", range(8))
def test_plans_use_every_length_exactly_and_few_sequences(seed):
    rng = np.random.default_rng(seed)
    longest = [8, 16, 64, 64, 100, 64, 64, 10][seed]
    histogram = np.bincount(rng.integers(1, longest + 1, [0, 1, 50, 5000, 300, 20, 700, 9][seed]), minlength=longest + 1)
    if seed == 6:
        histogram[longest // 2] += 100_000
    plan = packing.plan_packing(histogram, longest)
    used = np.zeros(plan.sequences, np.int64)
    for n in range(1, longest + 1):
        own = np.flatnonzero(plan.length == n)
        ends = [*plan.first[own][1:], histogram[n]][: len(own)]
        assert len(own) or not histogram[n]
        for k, end in zip(own, ends, strict=True):
            repeat = end - plan.first[k]
            at = slice(plan.sequence[k], plan.sequence[k] + repeat)
            used[at] += n
    assert used.sum() == (np.arange(longest + 1) * histogram).sum() and (used <= longest).all()
    halves = histogram[longest // 2 + 1 :].sum()
    assert plan.sequences <= max(halves, np.ceil(used.sum() / longest) * 1.1 + 1)


def test_least_squares_fit_reaches_an_exact_solution():
    patterns = packing.full_patterns(np.array([1, 2, 3, 5]), 8)
    assert {tuple(sorted(p)) for p in patterns.tolist()} == {(1, 2, 5), (2, 3, 3), (0, 3, 5)}
    counts = np.zeros(9)
    for p in patterns:
        for n in p:
            counts[n] += 10 * (n > 0)
    assert packing.fit_counts(patterns, counts) == pytest.approx([10] * 3, abs=0.01)


def brute_rules(labelled: list[tuple[list[str], bool]], least: int, sure: float) -> dict[tuple, tuple[float, int]]:
    """Rules over all combinations of the items of each URL; an item is all tokens that the same URLs have."""
    having, blocked = {}, Counter()
    for n, (tokens, block) in enumerate(labelled):
        for t in tokens:
            having.setdefault(t, set()).add(n)
            blocked[t] += block
    members = {}
    for t, rows in having.items():
        if blocked[t] >= least:
            members.setdefault(frozenset(rows), []).append(t)
    item_of = {t: min(own) for own in members.values() for t in own}
    members = {min(own): own for own in members.values()}
    seen, hits = Counter(), Counter()
    for tokens, block in labelled:
        items = sorted({item_of[t] for t in tokens if t in item_of})
        for size in range(1, len(items) + 1):
            for own in itertools.combinations(items, size):
                seen[own] += 1
                hits[own] += block
    z = 1.96
    good = {}
    for own, n in hits.items():
        share, count = n / seen[own], seen[own]
        bound = (share + z * z / (2 * count) - z * ((share * (1 - share) / count + z * z / (4 * count * count)) ** 0.5)) / (1 + z * z / count)
        if n >= least and bound >= sure:
            good[own] = (share, n)
    left = {o: v for o, v in good.items() if not any(set(p) < set(o) and w[0] >= v[0] for p, w in good.items())}
    return {tuple(sorted(t for item in o for t in members[item])): v for o, v in left.items()}


@pytest.fixture(scope="module")
def labelled_pages(spark):
    rng = random.Random(4)
    pages, labels = [], []
    for n in range(400):
        host = rng.choice(["casino.example.com", "news.example.com", "shop.example.org"])
        path = rng.choice(["/win/1", "/a/2.html", "/win/b"])
        name = rng.choice(["", "?ref=x", "?page=1&ref=y"])
        pages.append((n, f"https://{host}{path}{name}"))
        bad = ("casino" in host and "win" in path) if rng.random() < 0.95 else rng.random() < 0.5
        labels.append((n, 0 if bad else 1, 0))
    odd = [(900, None), (901, "no scheme"), (902, ""), (903, "http://"), (904, "x://HOST.Net?q/en/"), (None, "https://casino.example.com/win/7"), (0, pages[0][1])]
    schema = "page_id long, url string"
    return spark.createDataFrame(pages + odd, schema), spark.createDataFrame([*labels, (None, 0, 1), (0, None, None)], "doc_id long, quality int, toxic int")


def test_mined_rules(spark, labelled_pages):
    pages, labels = labelled_pages
    labelled = urls.labelled_urls(pages, labels).cache()
    rules = urls.mine_rules(labelled, min_count=8, min_confidence=0.6, most_items=16)
    plain = [(r.tokens, r.block) for r in labelled.collect()]
    want = brute_rules(plain, 8, 0.6)
    got = {tuple(sorted(r.tokens)): (r.confidence, r.support) for r in rules.collect()}
    assert want and got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k]) for k in want)
    judged = urls.judge_urls(pages, rules)
    for r, tokens in ((r, set(r.tokens)) for r in pages.withColumn("tokens", urls.tokens_of(F.col("url"))).collect()):
        matches = any(set(o) <= tokens for o in want)
        found = judged.where(F.col("page_id").eqNullSafe(F.lit(r.page_id))).select("rule", "verdict").distinct().collect() if r.page_id in (None, 0, 1, 2, 900, 902) else []
        assert all(f.verdict == ("block" if matches else "allow") for f in found if f.rule is None)
    assert judged.count() == pages.count()
    by_id = {r.page_id: r for r in judged.collect()}
    assert (by_id[904].host, by_id[904].path, by_id[904].rule) == ("host.net", "", None)
    assert [(by_id[n].host, by_id[n].path, by_id[n].verdict) for n in (900, 901, 902, 903)] == [("", "", "allow")] * 4


def test_a_rare_bad_host_by_default_parameters(spark):
    rng = random.Random(8)
    pages = [f"https://site{rng.randrange(300)}.example.com/{rng.choice('abcdefgh')}/{rng.choice('xyz')}" for _ in range(5000)]
    pages += [f"https://rare.bad.example/{rng.choice('abcdefgh')}/{rng.choice('xyz')}" for _ in range(12)]
    plain = [(u, n >= 5000 or rng.random() < 0.05) for n, u in enumerate(pages)]
    labelled = spark.createDataFrame(plain, "url string, block boolean").select(urls.tokens_of(F.col("url")).alias("tokens"), "block")
    rules = urls.mine_rules(labelled)
    want = brute_rules([(r.tokens, r.block) for r in labelled.collect()], urls.MIN_COUNT, urls.MIN_CONFIDENCE)
    got = {tuple(sorted(r.tokens)): (r.confidence, r.support) for r in rules.collect()}
    assert got.keys() == want.keys() and any("host=rare.bad.example" in tokens for tokens in got)
    judged = urls.judge_urls(spark.createDataFrame(list(enumerate(pages)), "page_id long, url string"), rules)
    assert {r.page_id for r in judged.where("verdict = 'block'").collect()} == set(range(5000, 5012))


def test_long_templates_are_mined(spark):
    """Forty words in every URL, and forty of which each URL lacks another one."""
    words = [f"w{'abcdefghij'[n // 10]}{'abcdefghij'[n % 10]}" for n in range(40)]
    whole = ["https://t.example.com/" + "/".join(words)] * 200
    gaps = ["https://u.example.com/" + "/".join("v" + w for n, w in enumerate(words) if n != k % 40) for k in range(400)]
    clean = [f"https://c.example.com/{n % 7}" for n in range(1500)]
    plain = [(u, n < 600) for n, u in enumerate(whole + gaps + clean)]
    labelled = spark.createDataFrame(plain, "url string, block boolean").select(urls.tokens_of(F.col("url")).alias("tokens"), "block")
    rules = urls.mine_rules(labelled)
    assert 2 <= rules.count() <= 2 ** urls.MOST_ITEMS * 41
    pages = spark.createDataFrame([(n, u) for n, (u, _) in enumerate(plain)], "page_id long, url string")
    assert {r.page_id for r in urls.judge_urls(pages, rules).where("verdict = 'block'").collect()} == set(range(600))
    # Many tokens in one URL: a page is compared with a rule only under the rule's key.
    long = spark.createDataFrame([(1, "https://t.example.com/" + "/".join(f"p{n:x}q".translate(str.maketrans("0123456789", "ghijklmnop")) for n in range(100_000)))], "page_id long, url string")
    assert urls.judge_urls(long, rules).first().verdict == "allow"


@pytest.mark.parametrize("most_items, run_items", [(urls.MOST_ITEMS, urls.RUN_ITEMS), (3, 200)])
def test_rules_of_any_tokens_of_a_long_url(spark, monkeypatch, most_items, run_items):
    """Up to twelve mixed tokens in a URL, of which the least sure ones make a rule together."""
    monkeypatch.setattr(urls, "RUN_ITEMS", run_items)
    rng = random.Random(12)
    plain = []
    for _ in range(400):
        tokens = [f"path=common{n}" for n in range(9) if rng.random() < 0.85]
        rare = [t for t in ("path=x", "path=y", "path=z") if rng.random() < 0.5]
        plain.append((tokens + rare, rng.random() < (0.95 if len(rare) == 3 else 0.35 - 0.1 * len(rare))))
    want = brute_rules(plain, urls.MIN_COUNT, urls.MIN_CONFIDENCE)
    assert any({"path=x", "path=y", "path=z"} <= set(tokens) for tokens in want)
    rules = urls.mine_rules(spark.createDataFrame(plain, "tokens array<string>, block boolean"), most_items=most_items)
    got = {tuple(sorted(r.tokens)): (r.confidence, r.support) for r in rules.collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


def test_a_rule_beside_millions_of_blocked_urls(spark):
    """Ten blocked URLs with a rare pair, beside copies of one blocked URL."""
    many = spark.range(2_000_000).select(F.array(F.lit("path=a"), F.lit("path=b")).alias("tokens"), F.lit(True).alias("block"))
    few = [(["path=x", "path=y"], True)] * 10 + [(["path=x"], False), (["path=y"], False)] * 40 + [(["path=a"], False)]
    rules = urls.mine_rules(many.unionByName(spark.createDataFrame(few, "tokens array<string>, block boolean")))
    got = {tuple(r.tokens): (r.confidence, r.support) for r in rules.collect()}
    assert got == {("path=x", "path=y"): (1.0, 10), ("path=a",): (2_000_000 / 2_000_001, 2_000_000), ("path=b",): (1.0, 2_000_000)}


def test_mining_nothing(spark, labelled_pages):
    pages, labels = labelled_pages
    rules = urls.mine_rules(urls.labelled_urls(pages, labels.limit(0)))
    assert rules.count() == 0 and urls.judge_urls(pages, rules).where("rule IS NULL AND verdict = 'block'").count() == 0
    assert urls.judge_urls(pages.limit(0), rules).count() == 0


def test_given_rules(spark):
    cases = {
        "http://a.example.net/en/x": ("example.net/en/", "allow"),
        "http://EXAMPLE.NET/de/": ("net/", "block"),
        "http://example.com/de/1?x": ("example.com/de/", "block"),
        "http://badexample.com/de/1": (None, "allow"),
        "http://x.org/fr/": ("org/fr/", "allow"),
        "http://x.org/fr": (None, "allow"),
        "http://net": (None, "allow"),
        "http://a.net/#/en/": ("net/", "block"),
    }
    pages = spark.createDataFrame(list(enumerate(cases)), "page_id long, url string")
    rules = spark.createDataFrame([], urls.RULES)
    got = {r.page_id: (r.rule, r.verdict) for r in urls.judge_urls(pages, rules).collect()}
    assert [got[n] for n in range(len(cases))] == list(cases.values())


def test_stages_take_odd_tables(spark, full):
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "near dedup", "pii", "best-fit packing"]
    for docs in (full, full.limit(0)):
        for name, stage in stages.items():
            result = stage(spark, docs, SMALL)
            if name != "best-fit packing":
                assert result.columns == docs.columns
            ids = [r.doc_id for r in result.collect()]
            if name in ("line dedup", "pii", "best-fit packing"):
                assert set(ids) == {r.doc_id for r in docs.collect()}


def test_the_pipeline_equals_its_plain_version(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    references = quality.fit_references(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    good = {r.doc_id for r in quality.judge(docs, references, ["doc_id"]).where("kept").collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in good]
    rows = [(i, k[2]) for i, k in brute.kept_lines(rows).items()]
    groups = brute.near_groups(rows)
    rows = [(i, t) for i, t in rows if groups[i] == i]
    library = Tokenizer.from_file(PATH)
    want = {}
    for i, text in rows:
        clean = pii.redacted(text, pii.all_spans([text], pii.default_model())[1][0])
        want[i] = [*library.encode(clean, add_special_tokens=False).ids, packing.END_ID]
    result = corpus_pipeline.run(spark, SMALL).collect()
    got = {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in result}
    pieces = {
        (i, n): (a, size, zlib.crc32(np.array(ids[a : a + size], "<u4").tobytes()))
        for i, ids in want.items()
        for n, (a, size) in enumerate(packing.piece_bounds(len(ids), packing.MAX_LENGTH))
    }
    assert got == pieces
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in result)

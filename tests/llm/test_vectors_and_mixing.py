"""Mixing, clustering and vector codes against plain versions."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from conftest import SMALL

from tokenloom.llm import centroids, mixing, quantizer
from tokenloom.llm.vectors import squared_distances

WORDS = " \t-\r"


def plain_targets(words: dict[str | None, int]) -> dict[str | None, Fraction]:
    names = sorted((s for s in words if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in words if s is None]
    weight = {s: (5, 2, 1)[n % 3] for n, s in enumerate(names)}
    target = {s: Fraction(sum(words.values()) * weight[s], sum(weight.values())) for s in names}
    while above := [s for s in names if target[s] > 3 * words[s]]:
        excess = sum(target[s] - 3 * words[s] for s in above)
        for s in above:
            target[s] = Fraction(3 * words[s])
        room = [s for s in names if target[s] < 3 * words[s]]
        for s in room:
            target[s] += excess * weight[s] / sum(weight[r] for r in room)
    return target


def check_mix(rows, got):
    sizes = Counter()
    words = defaultdict(int)
    for i, t, s in rows:
        n = len((t or "").split())
        sizes[i, n, s] += 1
        words[s] += n
    targets = plain_targets(dict(words))
    source = {i: s for i, _, s in rows}
    assert Counter((r.id, r.size, source[r.id]) for r in got) == sizes
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == words[source[r.id]]
        assert math.isclose(r.target, targets[source[r.id]], rel_tol=1e-9, abs_tol=1e-9)
        assert 0 <= r.copies <= 3
        taken[source[r.id]] += r.size * r.copies
    return {s: (taken[s], targets[s]) for s in words}


def test_mixing_of_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "source").collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df).collect()
    for taken, target in check_mix(rows, got).values():
        assert abs(taken - target) <= 0.02 * target + 1
    again = mixing.mix(df.repartition(5)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_mixing_of_odd_rows(spark):
    rng = random.Random(3)
    rows = [(n, "w " * rng.randint(0, 30), rng.choice(["a", "b", "B", "é", "", None, "~", "z"])) for n in range(300)]
    rows += [(n, None, "a") for n in range(400, 410)] + [(500, "same words here", "hot")] * 200 + [(600, "", "empty only"), (None, "x y z", "n")]
    schema = "doc_id long, text string, source string, size long, copies long, hash long"
    got = mixing.mix(spark.createDataFrame([(*r, None, 7, 8) for r in rows], schema)).collect()
    for s, (taken, target) in check_mix(rows, got).items():
        assert abs(taken - target) <= 3, s
    assert mixing.mix(spark.createDataFrame([], schema)).count() == 0
    nothing = mixing.mix(spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")).collect()
    assert {(r.id, r.size, r.target, r.copies) for r in nothing} == {(1, 0, 0.0, 0), (2, 0, 0.0, 0)}


def test_the_mix_itself(spark):
    docs = spark.createDataFrame([(n, "word " * n, "abc"[n % 3]) for n in range(1, 40)], "doc_id long, text string, source string")
    mixed = mixing.mix(docs)
    copies = {r.id: r.copies for r in mixed.collect()}
    got = Counter(r.doc_id for r in mixing.copied(docs, mixed).collect())
    assert got == {i: c for i, c in copies.items() if c}


def test_subset_sums_are_nearest():
    rng = random.Random(5)
    for _ in range(200):
        lengths = np.array(rng.sample(range(1, 40), rng.randint(1, 4)))
        spare = np.array([rng.randint(0, 4) for _ in lengths])
        budget = rng.randint(0, 150)
        taken = mixing.fill(lengths, spare, budget)
        assert (taken <= spare).all() and (taken >= 0).all()
        sums = [int(np.dot(c, lengths)) for c in itertools.product(*(range(s + 1) for s in spare))]
        assert abs(int(np.dot(taken, lengths)) - budget) == min(abs(s - budget) for s in sums)


def test_budgets_beyond_the_dynamic_programme():
    lengths, counts = np.array([1, 7, 500, 90_000]), np.array([5, 10_000, 20_000, 50])
    total = int((lengths * counts).sum())
    for target in (0.0, 0.37 * total, 1.0 * total, 2.5 * total, 3.0 * total):
        full, extra = mixing.chosen_counts(lengths, counts, target, left=1000)
        assert (0 <= extra).all() and (extra <= counts).all() and full <= 3
        assert abs(full * total + int((lengths * extra).sum()) - target) <= 1


def vectors(count: int, seed: int, spread: float = 1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(9, 64))
    return (centres[rng.integers(0, 9, count)] + spread * rng.normal(size=(count, 64))).astype(np.float32)


ODD = [
    (900, None, 1),
    (901, [0.5] * 63, 1),
    (902, [0.5] * 63 + [None], 1),
    (903, [0.5] * 63 + [float("nan")], None),
    (904, [float("-inf")] + [0.5] * 63, 2),
    (905, [], 2),
]
SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, code int"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], k, "c", 1) for i, v, k in rows], SCHEMA)


def whole_rows(count: int, seed: int):
    rows = [(n, v, None if n % 7 == 0 else int(n % 3)) for n, v in enumerate(vectors(count, seed))]
    return [*rows, rows[0], rows[0], (None, rows[1][1], None), (700, rows[2][1], 5)]


def integers(rows, scale):
    kept = [(i, v, k) for i, v, k in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    return [(i, [math.floor(scale * float(x)) for x in v], k) for i, v, k in kept]


def lloyd(points, centres, rounds):
    def assign():
        found = []
        for p in points:
            d = [sum((a - b) ** 2 for a, b in zip(p, c, strict=True)) for c in centres]
            found.append((d.index(min(d)), min(d)))
        return found

    for _ in range(rounds):
        owner = [k for k, _ in assign()]
        for k in range(len(centres)):
            own = [p for p, o in zip(points, owner, strict=True) if o == k]
            if own:
                centres[k] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    return assign(), centres


@pytest.mark.parametrize("count", [120, 5, 0])
def test_clustering(spark, count):
    rows = whole_rows(count, 1) + ODD if count else ODD
    kept = integers(rows, 64)
    order = sorted((i is None, "" if i is None else hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v, _ in kept)
    assigned, centres = lloyd([v for _, v, _ in kept], [list(v) for _, _, v in order[:16]], 3)
    state, found, inertias = centroids.clustered(table(spark, rows).repartition(3))
    want = Counter((i, k, d) for (i, _, _), (k, d) in zip(kept, assigned, strict=True))
    assert Counter((r.vec_id, r.cluster, r.distance) for r in state.collect()) == want
    assert found.tolist() == centres
    assert inertias.tolist() == [sum(d for k, d in assigned if k == c) for c in range(len(centres))]


def test_bounds_are_loosened_by_enough_and_by_less_than_the_drift():
    rng = np.random.default_rng(4)
    less = 0
    for _ in range(300):
        centre, old = rng.normal(size=(2, 6)) * 5
        new = old + rng.normal(size=6) * rng.choice([0, 0.1, 2])
        radius = float(rng.choice([0.1, 1, 6]))
        inside = rng.normal(size=(400, 6))
        inside *= (radius * rng.random((400, 1)) ** 0.2) / np.linalg.norm(inside, axis=1, keepdims=True)
        x = centre + inside
        allowed = centroids.loosening(centre, radius, old[None], new[None])[0]
        assert (np.linalg.norm(x - old, axis=1) - np.linalg.norm(x - new, axis=1)).max() <= allowed + 1e-12
        less += allowed < 0.99 * np.linalg.norm(new - old)
    assert less > 100


def test_most_vectors_keep_their_cluster_without_a_scan():
    points = np.floor(64 * vectors(3000, 2, spread=0.3)).astype(np.int64)
    old = points[:9].copy()
    own, distance, bound = centroids.nearest(points, old)
    for _ in range(3):
        new = np.stack([points[own == k].sum(0) // max(1, (own == k).sum()) if (own == k).any() else old[k] for k in range(9)])
        radii = np.array([np.sqrt(distance[own == k].max(initial=0)) for k in range(9)])
        bound = bound - centroids.loosened_by(old, new, radii)[own]
        distance = ((points - new[own]) ** 2).sum(1)
        clear = np.sqrt(distance) < bound
        own, distance, bound = centroids.nearest(points, new)
        old = new
    assert clear.mean() > 0.5


def test_large_components_stay_exact():
    points = np.array([[2**26, -(2**26)], [2**26 - 1, 2**26]])
    want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(p, q, strict=True)) for q in points] for p in points]
    assert squared_distances(points, points).tolist() == want


@pytest.mark.parametrize("count", [150, 6, 0])
def test_vector_codes(spark, count):
    rows = whole_rows(count, 3) + ODD if count else ODD
    kept = integers(rows, 4096)
    first = sorted(((i is None, i or 0, v) for i, v, _ in kept))[:16]
    parts = [lloyd([v[p * 8 : p * 8 + 8] for _, v, _ in kept], [list(v[p * 8 : p * 8 + 8]) for _, _, v in first], 6) for p in range(8)]
    coded, books = quantizer.compressed(table(spark, rows).repartition(3))
    want, errors = [], Counter()
    for n, (i, _, k) in enumerate(kept):
        error = sum(parts[p][0][n][1] for p in range(8))
        want.append((i, k, "".join(f"{parts[p][0][n][0]:02x}" for p in range(8)), error))
        errors[k] += error
    got = quantizer.with_label_errors(coded).collect()
    assert Counter((r.vec_id, r.label, r.code, r.error) for r in got) == Counter(want)
    assert {r.label: r.label_error for r in got} == dict(errors)
    if kept:
        assert books.tolist() == [c for _, c in parts]
        read = {r.vec_id: r.vector for r in quantizer.decoded(coded, books).collect()}
        code = {i: c for i, _, c, _ in want}
        assert read[3] == [x / 4096 for p in range(8) for x in parts[p][1][int(code[3][2 * p : 2 * p + 2], 16)]]


def test_hilbert_keys_follow_a_curve():
    grid = np.array(list(itertools.product(range(16), repeat=2)))
    for points in (grid, np.array(list(itertools.product(range(4), repeat=3)))):
        # Spread out, so that every coordinate's leading bits are used.
        keys = quantizer.hilbert_keys(points << 20)
        assert len(set(keys.tolist())) == len(points)
        walk = points[np.argsort(keys)]
        assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_shortlists_hold_the_nearest_entries():
    rng = np.random.default_rng(8)
    points = rng.integers(-50, 50, (500, 3))
    entries = np.concatenate([rng.integers(-50, 50, (6, 3)), [[400, 400, 400]]])
    blocks = quantizer.Blocks.sorted(points, 8)
    listed = quantizer.shortlists(blocks, entries)
    nearest = squared_distances(blocks.points, entries).argmin(1)
    assert listed[np.arange(500) // 8, nearest].all()
    assert not listed[:, -1].any()
    sums, counts = np.zeros((7, 3), np.int64), np.zeros(7, np.int64)
    quantizer.add_to_sums(blocks, entries, sums, counts)
    assert counts.tolist() == np.bincount(nearest, minlength=7).tolist()
    assert sums.tolist() == [blocks.points[nearest == k].sum(0).tolist() for k in range(7)]

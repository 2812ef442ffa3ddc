from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import TESTDATA
from millrace.llm.bisector import BisectorClusters, Tournament
from millrace.llm.one_bit import OneBitIndex, encoded, estimates, in_order, rotated
from millrace.llm.queries import QUERIES

NAN, INF = float("nan"), float("inf")


def vectors(spark, rows, kind="double"):
    """Rows with columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, 5, "x", 1.0) for r in rows], f"vec_id long, embedding array<{kind}>, q int, code string, level double")


def odd_rows(dim):
    return [
        (3000, None), (3001, []), (3002, [NAN] * dim), (3003, [1.0] * (dim - 1) + [INF]), (3004, [1.0] * (dim - 1) + [None]), (3005, [1.0] * (dim + 1)),
        (3050, [0.5] * (dim - 1)), (None, [1.0] * dim), (3100, [1e30] * dim), (3101, [-1e300] + [0.0] * (dim - 1)), (3150, [1e-200] * dim),
    ]


def brute_clusters(rows, k, rounds, dim, scale, seed):
    kept = [(i, [math.floor(scale * v) if abs(v) < 2**53 else int(v) * scale for v in x], x) for i, x in rows if x is not None and len(x) == dim and None not in x and np.isfinite(x).all()]
    digest = lambda i: hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()
    order = sorted((r for r in kept if r[0] is not None), key=lambda r: (digest(r[0]), r[2])) + sorted((r for r in kept if r[0] is None), key=lambda r: r[2])
    centroids = [r[1] for r in order[:k]]
    far = lambda x, c: sum((a - b) ** 2 for a, b in zip(x, c, strict=True))
    nearest = lambda x: min(range(len(centroids)), key=lambda c: (far(x, centroids[c]), c))
    for _ in range(rounds):
        mine = [nearest(x) for _, x, _ in kept]
        for c in range(len(centroids)):
            if own := [x for (_, x, _), m in zip(kept, mine, strict=True) if m == c]:
                centroids[c] = [sum(column) // len(own) for column in zip(*own, strict=True)]
    most = 2**63 - 1
    out = [(i, nearest(x), min(most, far(x, centroids[nearest(x)]))) for i, x, _ in kept]
    total = lambda c: min(most, sum(d for _, m, d in out if c in (m, None)))
    return sorted(((i, c, d, total(c), total(None), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for i, c, d in out), key=str)


@pytest.mark.parametrize(("n", "k", "odd"), [(200, 7, False), (60, 5, True), (3, 5, False), (0, 4, False)])
def test_clusters_equal_brute_force(spark, n, k, odd):
    rng = np.random.default_rng(n)
    rows = [(i, [float(v) for v in rng.normal(size=6).round(1)]) for i in range(n)]
    rows += rows[:3] + [(0, [0.5] * 6), (0, [0.25] * 6)] * (n > 3)
    rows += odd_rows(6) if odd else []
    got = BisectorClusters(vectors(spark, rows), k=k, rounds=3, dim=6, scale=8, seed=1).clusters().collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_clusters(rows, k, 3, 6, 8, 1)


def test_clusters_of_equal_vectors_take_the_smaller_number(spark):
    got = BisectorClusters(vectors(spark, [(i, [1.0, 2.0]) for i in range(40)]), k=4, dim=2).clusters().collect()
    assert {(r["cluster"], r["distance"], r["inertia"]) for r in got} == {(0, 0, 0)} and len(got) == 40


@settings(max_examples=100)
@given(st.integers(1, 7), st.sampled_from([3, 2**40]), st.randoms(use_true_random=False))
def test_tournament_finds_the_nearest(k, most, rng):
    draw = lambda: [rng.randint(-most, most) for _ in range(4)]
    centroids, x = [draw() for _ in range(k)], [draw() for _ in range(20)]
    tournament = Tournament(centroids)
    winners = tournament.winners(np.array(x, dtype=np.int64 if most == 3 else object))
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c, strict=True))
    assert winners.tolist() == [min(range(k), key=lambda c: (far(v, centroids[c]), c)) for v in x]


def test_too_many_normals_are_refused():
    with pytest.raises(ValueError):
        Tournament([[0] * 4096] * 1000)


def cosine(a, b):
    scale = lambda v: np.ldexp(np.array(v, float), -int(np.frexp(np.abs(v).max())[1]))
    a, b = scale(a), scale(b)
    total = lambda v: float(in_order(v[None, :])[0])
    return total(a * b) / (math.sqrt(total(a * a)) * math.sqrt(total(b * b)))


def brute_nearest(rows, wanted, k):
    usable = [(i, x) for i, x in rows if i is not None and x and None not in x and np.isfinite(x).all() and np.any(x)]
    out = []
    for q, y in usable:
        if wanted(q):
            scored = sorted(((cosine(y, x), i) for i, x in usable if i != q and len(x) == len(y)), key=lambda s: (-s[0], s[1]))
            out += [(q, rank, i, score) for rank, (score, i) in enumerate(scored[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("kind", ["double", "float"])
def test_nearest_equal_brute_force(spark, monkeypatch, kind):
    monkeypatch.setattr("millrace.llm.one_bit.FIRST_LEVEL", 60)
    monkeypatch.setattr("millrace.llm.one_bit.LEVEL_GROWTH", 3)
    monkeypatch.setattr("millrace.llm.one_bit.BLOCK_QUERIES", 9)
    rng = np.random.default_rng(4)
    rows = [(i, [float(v) for v in np.float32(rng.normal(size=12) + 0.3)]) for i in range(400)]
    rows += [(500 + i, rows[5][1]) for i in range(20)] + [rows[50], rows[50], (50, rows[7][1])]
    rows += odd_rows(12) if kind == "double" else odd_rows(12)[:8]
    index = OneBitIndex(vectors(spark, rows, kind))
    assert index.levels == 3
    got = index.search(vectors(spark, [r for r in rows if r[0] is not None and r[0] % 50 == 0], kind), k=5).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_nearest(rows, lambda q: q % 50 == 0, 5)


def test_few_or_no_candidates(spark):
    empty, few = vectors(spark, []), vectors(spark, [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.0, 1.0]), (3, [1.0])])
    assert OneBitIndex(empty).search(few).collect() == [] and OneBitIndex(few).search(empty).collect() == []
    got = OneBitIndex(few).search(few.where("vec_id in (0, 3)"), k=5).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got) == [(0, 1, 1), (0, 2, 2)]


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(6)
    unit = lambda x: x / np.sqrt((x * x).sum(1, keepdims=True))
    x, y = unit(rng.normal(size=(2000, 64))), unit(rng.normal(size=(50, 64)))
    assert np.abs((rotated(x) ** 2).sum(1) - 1).max() < 1e-5
    est, error = estimates(*encoded(x), rotated(y))
    off = (est - x @ y.T) / error[:, None]
    assert abs(off.mean()) < 0.05 and 0.8 < off.std() < 1.2 and (np.abs(off) > 4).mean() < 1e-3


def test_registered_recall(spark):
    rows = [(r["vec_id"], list(r["embedding"])) for r in spark.read.parquet(f"{TESTDATA}/embeddings.parquet").collect()]
    random.Random(1).shuffle(rows)
    got = {tuple(r) for r in QUERIES["op11_one_bit_neighbours"](spark, TESTDATA).select("query_id", "rank", "vec_id").collect()}
    want = {r[:3] for r in brute_nearest(rows, lambda q: q % 50 == 0, 5)}
    assert len(got & want) >= 0.99 * len(want) and len(got) == len(want)

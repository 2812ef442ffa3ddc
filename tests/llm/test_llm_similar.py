from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from conftest import plan_of
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import edge_docs, edge_rows, no_docs, prose
from millrace.llm import ngram_join
from millrace.llm.components import components
from millrace.llm.multi_index import Forest, Grid, VectorLinks
from millrace.llm.ngram_join import NgramJaccardJoin, heads, prefix_length, shingle_set


def least(links, nodes):
    """Smallest reachable node of each."""
    found = {n: n for n in nodes}
    while True:
        before = dict(found)
        for a, b in links:
            found[a] = found[b] = min(found[a], found[b])
        if found == before:
            return found


@pytest.mark.parametrize("links", [[], [(3, 3)], [(2, 1), (3, 2), (4, 3), (5, 4), (9, 8), (7, 9)], [(k, k + 1) for k in range(40)], [(0, k) for k in range(1, 30)]])
def test_components(spark, links):
    got = dict(tuple(r) for r in components(spark.createDataFrame(links, "a long, b long")).collect())
    ends = {n for a, b in links if a != b for n in (a, b)}
    assert got == least([(a, b) for a, b in links if a != b], ends)


def test_components_of_many_links_equal_those_of_one_task(spark):
    rng = random.Random(3)
    links = [(rng.randrange(-50, 400), rng.randrange(-50, 400)) for _ in range(250)] + [(k, k + 1) for k in range(1000, 1040)]
    frame = spark.createDataFrame([*links, (None, 1), (7, 7)], "a long, b long")
    got = [dict(tuple(r) for r in components(frame, most).collect()) for most in (0, 1000)]
    ends = {n for a, b in links if a != b for n in (a, b)}
    assert got == [least([(a, b) for a, b in links if a != b], ends)] * 2


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[k:k + size]) for k in range(max(1, len(words) - size + 1))) if words else frozenset()


def brute(rows, size, percent):
    sets = defaultdict(set)
    for doc, text in rows:
        if doc is not None:
            sets[doc].add(shingles(text, size))
    links = [
        (a, b) for a, b in combinations(sets, 2)
        if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b])
    ]
    found = least(links, sets)
    return sorted(((doc, len(shingles(text, size)), found.get(doc)) for doc, text in rows), key=str)


def family(n, edits, seed):
    rng = random.Random(seed)
    base = prose(120, seed).split()
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def test_a_passage_of_unlike_documents_takes_no_further_round(spark, monkeypatch):
    passage = prose(60, 99)
    texts = family(60, 1, 1) + [f"{passage} {prose(12, 200 + k)}" for k in range(120)]
    rows = list(enumerate(texts))
    labels = []
    monkeypatch.setattr(ngram_join, "written", lambda df, label, plain=ngram_join.written: labels.append(label) or plain(df, label))
    got = NgramJaccardJoin(spark.createDataFrame(rows, "doc_id long, text string"), size=3, percent=90).documents().collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, 3, 90)
    assert labels.count("pairs") == 2  # one round, then all that is left


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80), (1, 50)])
def test_links_equal_brute_force(spark, size, percent):
    texts = family(25, 4, 1) + family(25, 9, 2) + [prose(100, k) for k in range(30)] + ["a b", "A B", "a b c", "", None, "a b c d e f g h i", "a b c d e f g h i j"]
    shared = prose(60, 99)
    texts += [f"{shared} {prose(20, 200 + k)}" for k in range(20)] + [shared] * 5
    random.Random(7).shuffle(texts)
    rows = list(enumerate(texts))
    got = NgramJaccardJoin(spark.createDataFrame(rows, "doc_id long, text string"), size=size, percent=percent).documents().collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, size, percent)


def test_hot_tokens_and_copies_take_their_own_way(spark, monkeypatch):
    passage = prose(80, 3)
    texts = [f"{passage} {prose(12, 300 + k)}" for k in range(12)] + [f"{passage} {prose(12, 300)}"] * 9 + family(12, 3, 8) + [prose(40, k) for k in range(8)]
    rows = [*enumerate(texts), (5, texts[5]), (None, texts[5])]
    for name, value in {"LOOK": 1, "HOT_IN_LOOK": 3, "MANY_COPIES": 2}.items():
        monkeypatch.setattr(ngram_join, name, value)
    got = NgramJaccardJoin(spark.createDataFrame(rows, "doc_id long, text string"), size=3, percent=80).documents().collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, 3, 80)


def test_tokens_of_one_document_come_first(spark):
    """Passages of up to 40 % of a text, shared by all, hold no prefix token; the rarest of the band do."""
    passage = prose(80, 3)
    rows = [(k, f"{passage} {prose(120, 400 + k)}") for k in range(40)]
    assert NgramJaccardJoin(spark.createDataFrame(rows, "doc_id long, text string"), size=5, percent=90).shared.count() < 200


def test_edge_documents(spark):
    rows = [(r[0], r[1]) for r in edge_rows()]
    got = NgramJaccardJoin(edge_docs(spark), size=5, percent=80).documents().collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, 5, 80)
    assert NgramJaccardJoin(no_docs(spark)).documents().collect() == []


def test_a_large_group_of_near_copies_needs_few_pairs(spark):
    texts = [f"{prose(200, 5)} tail{k}" for k in range(400)]
    join = NgramJaccardJoin(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert join.links.count() < 17 * len(texts)
    assert {r["component_id"] for r in join.documents().collect()} == {0}


def test_texts_that_share_tokens_by_chance_do_not_meet(spark):
    """Every shingle is in some ten of the texts; only the four near copies share signatures."""
    rng = random.Random(11)
    texts = [" ".join(f"w{rng.randrange(12)}" for _ in range(60)) for _ in range(300)]
    texts += [f"{texts[k]} tail" for k in range(4)]
    join = NgramJaccardJoin(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), size=3, percent=90)
    assert join.shared.count() < 100
    assert sorted((tuple(r) for r in join.documents().collect()), key=str) == brute(list(enumerate(texts)), 3, 90)


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 400), st.sampled_from([50, 67, 80, 90, 97]), st.data())
def test_similar_sets_share_a_signature(n, percent, data):
    rng = np.random.default_rng(data.draw(st.integers(0, 1000)))
    tokens = np.unique(rng.integers(0, 1 << 64, 2 * n, np.uint64))
    rng.shuffle(tokens)
    one, rest = tokens[:n], tokens[n:]
    lost = data.draw(st.integers(0, min(n - 1, n * (100 - percent) // 100)))  # union n + gained
    gained = data.draw(st.integers(0, min(len(rest), 100 * (n - lost) // percent - n)))
    other = np.concatenate([one[lost:], rest[:gained]])
    assert 100 * (n - lost) >= percent * (n + gained)
    if lost or gained:
        assert np.intersect1d(heads(np.sort(one), percent), heads(np.sort(other), percent)).size


@given(st.integers(1, 300), st.integers(50, 100))
def test_prefix_leaves_less_than_the_needed_overlap(n, percent):
    assert 100 * (n - prefix_length(n, percent)) < percent * n <= 100 * (n - prefix_length(n, percent) + 1)


def test_shingles_lower_ascii_letters_only():
    assert shingle_set("A B C", 3).tolist() == shingle_set("a\tb\x0bc", 3).tolist()
    assert shingle_set("É B C", 3).tolist() != shingle_set("é b c", 3).tolist()
    assert shingle_set("a b\x1cc", 2).tolist() != shingle_set("a b c", 2).tolist()


def brute_vectors(rows, threshold=0.93):
    usable = [(k, i, label, np.array(v, float)) for k, (i, v, label) in enumerate(rows) if i is not None and label is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    n, links = Counter(), []
    for (k, i, a, x), (m, j, b, y) in combinations(usable, 2):
        if a == b and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
            n[k] += 1
            n[m] += 1
            links.append((i, j))
    found = least(links, {i for _, i, _, _ in usable})
    return sorted(((i, n[k], found.get(i, i), None if i is None else found.get(i, i) == i) for k, (i, _, _) in enumerate(rows)), key=str)


def vectors(spark, rows):
    return spark.createDataFrame([(*r, 5, "x") for r in rows], "vec_id long, embedding array<float>, label int, n int, unit string")


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = []
    for _ in range(12):
        center = rng.normal(size=16)
        for _ in range(rng.integers(1, 25)):
            rows.append((len(rows), [float(v) for v in np.float32(center + rng.normal(size=16) * rng.choice([0.05, 0.2, 0.3]))], int(rng.integers(0, 2))))
    rows += [(1000 + k, rows[3][1], 0) for k in range(30)] + [(2000 + k, [2 * v for v in rows[3][1]], 0) for k in range(3)]
    nan, inf = float("nan"), float("inf")
    rows += [(3000, None, 0), (3001, [], 0), (3002, [0.0] * 16, 0), (3003, [nan] * 16, 0), (3004, [1.0, inf], 0), (3005, [1.0, None], 0), (3006, rows[3][1], None), (None, rows[3][1], 0)]
    rows += [(4000, [1.0], 0), (4001, [2.0], 0), (4002, [-1.0], 0), (4003, [1.0, 0.1], 0), (4004, [1.0, 0.2], 0), (4003, [1.0, 0.1], 0), (4005, [3e38, 3e38], 0), (4006, [1e-30, 1e-30], 0)]
    got = VectorLinks(vectors(spark, rows)).vectors().collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_vectors([(i, v and [None if x is None else float(np.float32(x)) for x in v], l) for i, v, l in rows])


def test_vectors_in_small_chunks(spark, monkeypatch):
    monkeypatch.setattr("millrace.llm.multi_index.CHUNK_ROWS", 5)
    monkeypatch.setattr("millrace.llm.multi_index.VISITORS", 3)
    rng = np.random.default_rng(2)
    rows = [(k, [float(v) for v in np.float32(np.ones(8) + rng.normal(size=8) * 0.25)], 1) for k in range(60)]
    assert sorted((tuple(r) for r in VectorLinks(vectors(spark, rows)).vectors().collect()), key=str) == brute_vectors(rows)
    assert VectorLinks(vectors(spark, [])).vectors().collect() == []


def test_recall_at_the_threshold():
    rng = np.random.default_rng(3)
    unit = lambda x: x / np.sqrt((x * x).sum(1, keepdims=True))
    x = unit(rng.normal(size=(4000, 32)))
    grid = Grid(x[:2000], 8, 0.93, 0.999)
    noise = rng.normal(size=x.shape)
    noise = unit(noise - (noise * x).sum(1, keepdims=True) * x)
    y = 0.93 * x + np.sqrt(1 - 0.93**2) * noise
    ex, ey = grid.excess(x), grid.excess(y)
    met = np.minimum(grid.cost(ex, grid.cells(ey)), grid.cost(ey, grid.cells(ex))) <= grid.margin
    assert met.mean() > 0.99
    row, i, j = grid.visits(ex)
    assert sorted(zip(row, i, j, strict=True)) == sorted(zip(*np.nonzero(ex[0][:, :, None] + ex[1][:, None, :] <= grid.margin), strict=True))


@settings(max_examples=50)
@given(st.lists(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 11)), min_size=1, max_size=8), max_size=6))
def test_forest_joins_residents_of_one_visitor(batches):
    forest, links = Forest(12), []
    for k, batch in enumerate(batches):
        forest.join(np.array([v for v, _ in batch]), np.array([r for _, r in batch]))
        links += [(100 + 10 * k + v, r) for v, r in batch]
    want = least(links, {*range(12), *(a for a, _ in links)})
    assert forest.roots().tolist() == [want[r] for r in range(12)]


def test_join_starts_no_second_kind_of_workers(spark):
    assert "ExistingRDD" not in plan_of(NgramJaccardJoin(edge_docs(spark)).links)

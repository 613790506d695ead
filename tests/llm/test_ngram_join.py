"""The join against all pairs, the component finder against union-find."""

from __future__ import annotations

import random

import numpy as np
import pytest

from salesloom.llm import ngram_join
from salesloom.llm.components import components

from tests.llm.conftest import EDGE_ROWS, PROSE


def shingles(text, words):
    own = (text or "").encode().lower().split()
    if len(own) >= words:
        return {tuple(own[i : i + words]) for i in range(len(own) - words + 1)}
    return {tuple(own)} if own else set()


def roots_of(n, links):
    root = list(range(n))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return [top(x) for x in range(n)]


def brute(rows, words, num, den):
    """Sorted (doc_id, set size, component) of rows with ids."""
    sets = [shingles(t, words) for _, t in rows]
    links = [
        (i, j) for i in range(len(rows)) for j in range(i)
        if sets[i] and sets[j]
        and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j])
    ]
    top = roots_of(len(rows), links)
    least = {}
    for (doc, _), r in zip(rows, top):
        least[r] = min(least.get(r, doc), doc)
    return sorted((doc, len(s), least[r]) for (doc, _), s, r in zip(rows, sets, top))


def near_copies(seed, n=220):
    """Chains of edits, near copies of a few texts, short texts and shared passages."""
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = [draw.choice(vocabulary) for _ in range(60)]
    base = [[draw.choice(vocabulary) for _ in range(draw.choice([2, 3, 4, 5, 8, 14, 30, 80, 300]))] for _ in range(12)]
    rows, last = [], base[8]
    for i in range(n):
        kind = draw.random()
        if kind < 0.6:
            words = list(draw.choice(base))
            for _ in range(draw.choice([0, 1, 1, 2, 3, 6])):
                at = draw.randrange(len(words) + 1)
                words[at : at + draw.choice([0, 1])] = [draw.choice(vocabulary)]
        elif kind < 0.75:  # a chain: each a small edit of the one before
            last = list(last)
            last[draw.randrange(len(last))] = draw.choice(vocabulary)
            words = last
        elif kind < 0.9:
            words = passage + [draw.choice(vocabulary) for _ in range(draw.choice([3, 20, 100]))]
        else:
            words = [draw.choice("a b".split()) for _ in range(draw.randint(0, 12))]
        rows.append((i * 3 + 1, " ".join(words)))
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,words,num", [(1, 4, 85), (2, 5, 80), (3, 2, 60)])
def test_join_equals_all_pairs(documents, seed, words, num):
    rows = near_copies(seed)
    out = ngram_join.near_duplicates(documents(rows), words=words, num=num, den=100)
    assert sorted(map(tuple, out.collect())) == brute(rows, words, num, 100)


def test_large_groups_in_stars_give_the_same(documents, monkeypatch):
    rows = near_copies(4, 120)
    monkeypatch.setattr(ngram_join, "PAIRED", 2)
    out = ngram_join.near_duplicates(documents(rows), words=4, num=85, den=100)
    assert sorted(map(tuple, out.collect())) == brute(rows, 4, 85, 100)


@pytest.mark.parametrize("num", [50, 80, 85, 95])
def test_similar_sets_always_share_a_signature(num):
    draw = np.random.default_rng(num)
    bands = ngram_join.Bands(num, 100)
    for trial in range(1500):
        size = int(draw.choice([1, 2, 3, 6, 7, 9, 13, 20, 40, 100, 400]))
        shared = draw.integers(1, 1 << 62, size, dtype=np.uint64)
        extra = draw.integers(1, 1 << 62, size, dtype=np.uint64)
        most = int(size * (100 - num) / num) + 1
        a_own, b_own = draw.integers(0, most + 1, 2)
        a = np.unique(np.concatenate([shared, extra[: min(a_own, size // 2)]]))
        b = np.unique(np.concatenate([shared, extra[size // 2 :][: min(b_own, size - size // 2)]]))
        both = len(np.intersect1d(a, b))
        similar = 100 * both >= num * (len(a) + len(b) - both)
        if similar and not np.array_equal(a, b):
            # Whichever parts each spares, as many as its tags say, one shared part stays.
            one, two = ngram_join.signatures(a, bands), ngram_join.signatures(b, bands)
            order = {v: draw.random() for v in np.union1d(one[0], two[0]).tolist()}
            kept = []
            for found, tags in (one, two):
                kept.append(set())
                for tag in np.unique(tags).tolist():
                    own = sorted(found[tags == tag].tolist(), key=order.get)
                    kept[-1] |= set(own[: len(own) - tag % (1 << 32)])
            assert kept[0] & kept[1], (trial, len(a), len(b), both)


def test_signatures_grow_linearly():
    bands = ngram_join.Bands(85, 100)
    draw = np.random.default_rng(0)
    for size in (50, 500, 5_000, 50_000):
        own = np.unique(draw.integers(1, 1 << 62, size, dtype=np.uint64))
        assert len(ngram_join.signatures(own, bands)[0]) <= 0.6 * size


@pytest.mark.parametrize("n", [2, 40])
def test_components_of_chains_and_stars(spark, n):
    draw = random.Random(n)
    names = list(range(3 * n))
    draw.shuffle(names)
    edges = [(names[i], names[i + 1]) for i in range(n - 1)]  # a chain
    edges += [(names[n], names[i]) for i in range(n + 1, 2 * n)]  # a star
    edges += [(names[2 * n], names[2 * n])]  # a loop
    found = components(spark.createDataFrame(edges, "u long, v long")).collect()
    top = roots_of(3 * n, edges)
    want = {(x, top[x]) for e in edges if e[0] != e[1] for x in e}
    assert {tuple(r) for r in found} == want and len(found) == len(want)


def test_edge_rows(edge, empty, documents):
    out = ngram_join.near_duplicates(edge)
    rows = [tuple(r) for r in out.collect()]
    assert len(rows) == len(EDGE_ROWS)
    assert {r for r in rows if r[0] in (2, 3)} == {(2, 0, 2), (3, 0, 3)}
    assert {r[2] for r in rows if r[0] in (7,)} == {6}
    assert (None, 0, None) in rows and any(r[0] is None and r[2] == 6 for r in rows)
    kept = ngram_join.first_of_groups(edge)
    assert set(kept.columns) == set(edge.columns)
    assert sorted(r["text"] for r in kept.where("doc_id = 6").collect()) == [
        "another text of id six", PROSE]
    assert kept.where("doc_id = 7").count() == 0
    assert ngram_join.near_duplicates(empty).count() == 0
    assert ngram_join.first_of_groups(empty).count() == 0


def test_near_copies_and_bridges_without_ids(documents):
    def text(name, own=()):
        return " ".join([f"{name}{i}" for i in range(40)] + list(own))

    a, bridge, b = text("p", ["x1", "x2", "x3"]), text("p", ["x1", "y1"]), text("p", ["y1", "y2", "y3", "y4"])
    rows = [(21, a), (None, bridge), (22, b), (23, text("q")), (None, text("q", ["z"])),
            (None, text("r")), (None, text("r", ["z"])), (None, text("r", ["z"])), (24, text("s"))]
    near = [shingles(t, 5) for t in (a, bridge, b)]
    alike = [100 * len(x & y) >= 85 * len(x | y) for x, y in zip(near, near[1:] + near[:1])]
    assert alike == [True, True, False]  # a and b are one group through the text without id
    out = ngram_join.near_duplicates(documents(rows), words=5, num=85, den=100).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in out) == [
        (0, 0), (0, 0), (0, 0), (0, 21), (0, 23), (21, 21), (22, 21), (23, 23), (24, 24)]


def test_groups_keep_one_row_where_ids_repeat_or_miss(documents):
    def text(name, *own):
        return " ".join([f"{name}{i}" for i in range(40)] + list(own))

    rows = [
        (7, text("a")), (7, text("b", "x")), (3, text("b")),  # the second is a copy of id 3
        (None, text("c")), (None, text("d")), (4, text("d")), (None, text("b", "y")),
        (None, text("e")), (None, text("e", "x")), (None, text("e")),  # a group without ids
        (8, text("f")), (8, text("f", "x")), (8, text("f", "x")),  # a group of one id
        (None, ""), (None, None), (9, " "),
    ]
    kept = [(r["doc_id"], r["text"]) for r in ngram_join.first_of_groups(documents(rows)).collect()]
    assert len(kept) == 9
    assert {r for r in kept if r[1] is None or r[1][:1] not in ("e", "f")} == {
        (7, text("a")), (3, text("b")), (None, text("c")), (4, text("d")),
        (None, ""), (None, None), (9, " ")}
    assert [d for d, t in kept if t and t[0] in "ef"].count(None) == 1


def _plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_groups_are_shuffled_once_and_those_of_two_are_done_with(spark):
    rows = [
        (signature, key, 100, weight, key, 0, 0, True)
        for signature, members in ((1, (5, 6)), (2, (5, 6, 7)), (3, (8, 9)))
        for key, weight in zip(members, (2, 2, 1))
    ]
    groups = spark.createDataFrame(
        rows, "signature long, key long, size long, weight long, root long, band long, rank long, home boolean"
    )
    pairs, rest = ngram_join._stars(groups, 85, 100)
    assert {tuple(r) for r in pairs.collect()} == {(5, 6), (7, 6), (8, 9)}
    assert sorted((r["signature"], r["key"]) for r in rest.collect()) == [(2, 5), (2, 7)]
    roots = spark.createDataFrame([(6, 5), (5, 5)], "node long, root long")
    plan = _plan_of(ngram_join._open(rest, roots).hint("merge"))
    assert plan.count("hashpartitioning(signature") == 1
    assert sorted(r["key"] for r in ngram_join._open(rest, roots).collect()) == [5, 7]


def test_classes_of_one_key_raise(spark):
    rows = spark.createDataFrame(
        [(3, 1, 10), (2, 1, 10), (4, 2, 20)], "doc_id long, key long, twin long"
    )
    assert {r["key"]: r["least"] for r in ngram_join._named(rows).collect()} == {1: 2, 2: 4}
    clash = rows.unionByName(rows.limit(1).selectExpr("doc_id", "key", "twin + 1 AS twin"))
    with pytest.raises(Exception, match="share a key"):
        ngram_join._named(clash).collect()

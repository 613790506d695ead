"""Operators 11 to 13 against plain versions, and their edge cases."""

from __future__ import annotations

import hashlib
import heapq
import itertools
import random
import re
import zlib

import numpy as np
import pytest
import regex
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from salesloom.llm import conversations, middle, minhash, stars

PROSE = "the quick brown fox jumps over the lazy dog and runs into the dark wood before night falls"


# --- 11: MinHash ---------------------------------------------------------------


def plain_groups(rows, words, num, den):
    """(id, set size, least reachable id) by all pairs."""
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        if len(w) >= words:
            sets.append({" ".join(w[i : i + words]) for i in range(len(w) - words + 1)})
        else:
            sets.append({"\0".join(w)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and den * both >= num * (len(sets[i]) + len(sets[j]) - both):
            root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        held = least.get(find(i))
        least[find(i)] = doc if held is None else held if doc is None else min(held, doc)
    return sorted(
        ((doc, len(sets[i]), least[find(i)] if sets[i] else doc) for i, (doc, _) in enumerate(rows)), key=repr
    )


def found_groups(df, **how):
    found = minhash.near_duplicates(df, **how).collect()
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found), key=repr)


def near_copies(seed=1):
    """Chains of near copies, templates whose copies are not similar enough, and short texts."""
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, number = [], 0
    for length, copies, edits in ((60, 12, 1), (200, 15, 3), (90, 25, 6), (30, 20, 2), (2, 5, 0), (5, 6, 1)):
        words = draw.choices(vocabulary, k=length)
        for _ in range(copies):
            text = list(words)
            for _ in range(edits):
                text[draw.randrange(length)] = draw.choice(vocabulary)
            if draw.random() < 0.3:
                words = text  # the next ones are copies of this copy
            rows.append((number * 7 % 1009, " ".join(text)))
            number += 1
    return rows


@pytest.mark.parametrize("words,num,den", [(3, 85, 100), (5, 80, 100)])
def test_components_equal_those_of_all_pairs(spark, documents, words, num, den):
    rows = near_copies()
    expected = plain_groups(rows, words, num, den)
    assert 10 < len({r[2] for r in expected}) < len(rows)
    assert found_groups(documents(rows), words=words, num=num, den=den) == expected


def test_minhash_edge_rows(spark, edge, empty):
    rows = [(r["doc_id"], r["text"]) for r in edge.collect()]
    assert found_groups(edge, words=3, num=85, den=100) == plain_groups(rows, 3, 85, 100)
    assert minhash.near_duplicates(empty).count() == 0


def test_bridge_without_id(spark, documents):
    words = [f"b{i}" for i in range(60)]
    rows = [(5, " ".join(words)), (None, " ".join(words[2:])), (9, " ".join(words[4:] + ["x", "y"]))]
    assert found_groups(documents(rows), words=3, num=90, den=100) == plain_groups(rows, 3, 90, 100)


def test_agreement_of_minima_estimates_similarity():
    draw = np.random.default_rng(3)
    for share in (0.3, 0.6, 0.85):
        both = draw.integers(0, 1 << 63, int(2000 * share), dtype=np.uint64)
        rest = draw.integers(0, 1 << 63, 2000 - len(both), dtype=np.uint64)
        half = len(rest) // 2
        a = minhash.minima(np.concatenate([both, rest[:half]]))
        b = minhash.minima(np.concatenate([both, rest[half:]]))
        assert abs((a == b).mean() - share) < 0.12
    least = minhash.least_agreement(85, 100)
    assert 0.6 * minhash.ROWS * minhash.BANDS < least < 0.85 * minhash.ROWS * minhash.BANDS


@pytest.mark.parametrize("seed", [1, 2])
def test_components_of_chains_stars_and_hubs(spark, seed):
    draw = random.Random(seed)
    edges = [(i, i + 1) for i in range(1000, 1060)] + [(500, i) for i in range(501, 900)]
    edges += [(draw.randrange(100), draw.randrange(100)) for _ in range(60)] + [(7, 7), (500, 501)]
    draw.shuffle(edges)
    root = {n: n for e in edges for n in e if e[0] != e[1]}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for u, v in edges:
        if u != v:
            a, b = sorted((find(u), find(v)))
            root[b] = a
    found = stars.components(spark.createDataFrame(edges, "u long, v long"))
    assert {(r["node"], r["root"]) for r in found.collect()} == {(n, find(n)) for n in root}
    assert stars.components(spark.createDataFrame([], "u long, v long")).count() == 0


# --- 12: fill in the middle -------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32), st.integers(0, 150_000), st.floats(0, 1), st.booleans())
def test_select_of_any_container(seed, size, share, clustered):
    draw = np.random.default_rng(seed)
    mask = draw.random(size + 1) < share
    if clustered:
        mask = np.repeat(mask[: size // 500 + 1], 500)
    mask[0] = True
    cuts, plain = middle.Boundaries(mask), np.flatnonzero(mask)
    assert len(cuts) == len(plain)
    for k in {0, len(plain) - 1, *draw.integers(0, len(plain), 30).tolist()}:
        assert cuts.select(k) == plain[k]


def test_each_form_of_container_occurs():
    dense = np.ones(middle.SPAN, bool)
    sparse = np.zeros(middle.SPAN, bool)
    sparse[::97] = True
    mixed = np.random.default_rng(1).random(middle.SPAN) < 0.5
    assert [type(middle.container(m)).__name__ for m in (dense, sparse, mixed)] == ["Runs", "Array", "Bitmap"]


def plain_middle(doc, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return (doc, n, "plain", None, None, text)
    if h4 % 100 < 20:
        return (doc, n, "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}")
    return (doc, n, "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}")


def test_middle_equals_plain_cuts_and_restores(spark, documents, edge, empty):
    draw = random.Random(5)
    letters = "ab <PSM>é日\U0001f600\n"
    rows = [(i, "".join(draw.choices(letters, k=draw.choice((0, 1, 5, 300))))) for i in range(400)]
    rows += [(1000, "é日" * 60_000), (1001, "x" * 200_000), (1002, "<P"), (1003, "a<" * 50)]
    for df in (documents(rows), edge):
        found = middle.transform(df)
        expected = sorted((plain_middle(r["doc_id"], r["text"]) for r in df.collect()), key=repr)
        assert sorted((tuple(r) for r in found.collect()), key=repr) == expected
        texts = found.select(middle.restore(F.col("output"), F.col("form"))).collect()
        assert sorted(r[0] for r in texts) == sorted(r["text"] or "" for r in df.collect())
    assert {f[2] for f in expected} >= {"plain"} and middle.transform(empty).count() == 0
    forms = {r["form"] for r in middle.report(middle.transform(documents(rows))).collect()}
    assert forms == {"plain", "psm", "spm"}


def test_middle_cuts_at_other_units(spark, documents):
    unit = r"\S+\s*"
    found = middle.transform(documents([(i, PROSE * 3) for i in range(40)]), unit=unit, transformed=100)
    for r in found.where("form = 'psm'").collect():
        words = regex.findall(unit, PROSE * 3)
        assert r["n"] == len(words)
        prefix = "".join(words[: r["prefix_units"]])
        assert r["output"].startswith(f"<P>{prefix}<S>")
        assert r["output"].endswith(f"<M>{''.join(words[r['prefix_units']:][: r['middle_units']])}")


# --- 13: conversations --------------------------------------------------------------


def plain_search(rows):
    """Cheapest (cost, audit, turns): all edit sequences in order of cost, then audit. ``rows`` are
    (role, text, fault)."""
    whole, part = re.compile(r"(s?(ua)+)?"), re.compile(r"(s?(ua)*u?)?")
    heap, seen = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, at, roles, turns = heapq.heappop(heap)
        if at == len(rows) and whole.fullmatch(roles):
            return cost, audit, turns
        if (at, roles[-1:], len(roles) == 1) in seen:
            continue  # a cheaper or smaller audit came here before
        seen.add((at, roles[-1:], len(roles) == 1))
        steps = [(3, "I", at, i, (r, "")) for i, r in (("u", "user"), ("a", "assistant"))]
        if at < len(rows):
            role, text, fault = rows[at]
            steps.append((4, "D", at + 1, "", None))
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                steps.append((more, "K", at + 1, role[:1] or "?", (role, text)))
                steps += [
                    (3 + more, "R", at + 1, i, (r, text)) for i, r in (("u", "user"), ("a", "assistant"))
                ]
        for price, edit, to, initial, turn in steps:
            if part.fullmatch(roles + initial):
                heapq.heappush(heap, (
                    cost + price, audit + edit, to, roles + initial, turns + ((turn,) if turn else ())
                ))


def plain_report(rows):
    """The query's row of one conversation: (turn, role, text) after damage, in any order."""
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest())
    rows = sorted(rows, key=key)
    seen, faults = set(), []
    for _, role, text in rows:
        end = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append(
            "blank" if not end else "duplicate" if (role, text) in seen
            else "truncated" if end[-1] not in ".!?" else ""
        )
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, repaired = plain_search([(r, t, f) for (_, r, t), f in zip(rows, faults)])
    text = "\n".join(f"{r}:{t}" for r, t in repaired)
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def plain_damage(rows):
    """Per conversation the damaged rows of (conv_id, turn, role, text)."""
    left = {}
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        shown = ":".join(" " if x is None else str(x) for x in (conv, turn))
        fate = zlib.crc32(shown.encode()) % 20
        kept = left.setdefault(conv, [])
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        kept += [(turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    return left


def expected_rows(rows):
    return sorted(((conv, *plain_report(kept)) for conv, kept in plain_damage(rows).items()), key=repr)


def found_rows(df, **how):
    repaired = conversations.repair(conversations.damage(df), **how)
    return sorted((tuple(r) for r in conversations.report_of_all(df, repaired).collect()), key=repr), repaired


def test_bidirectional_search_equals_plain_search():
    draw = random.Random(11)
    rows_of = {
        "s": ("system", "x.", ""), "u": ("user", "x.", ""), "a": ("assistant", "x.", ""), "x": ("tool", "x.", ""),
        "S": ("system", "x", "truncated"), "U": ("user", "x", "truncated"),
        "A": ("assistant", "x", "truncated"), "X": ("tool", "x", "truncated"), "#": ("user", "", "blank"),
    }
    shapes = ["".join(s) for n in range(4) for s in itertools.product("suaUA#x", repeat=n)]
    shapes += ["".join(draw.choices("suauauaSUAX#x", k=draw.randrange(4, 14))) for _ in range(400)]
    for shape in shapes:
        rows = [rows_of[c] for c in shape]
        cost, audit, turns = plain_search(rows)
        assert conversations.cheapest(shape) == (cost, audit), shape
        made = conversations.written(audit, 0, shape, [r for r, _, _ in rows], [t for _, t, _ in rows])
        assert tuple(made) == turns


def talk(draw, conv, n, null=False):
    roles = ["system", "user", "assistant", "tool", "", "s", None] if null else ["system", "user", "assistant"]
    texts = ["Yes.", "No", "Why?", " \n", "", "so it is. ", "é!", None] if null else ["Yes.", "No", "Why?", "one. two"]
    return [
        (conv, None if null and draw.random() < 0.1 else turn, draw.choice(roles), draw.choice(texts))
        for turn in range(n)
    ]


@pytest.mark.parametrize("block_rows", [3, 512])
def test_conversations_equal_plain_repair(spark, block_rows):
    draw = random.Random(2)
    rows = [r for conv in range(120) for r in talk(draw, conv, draw.randrange(1, 12), conv % 3 == 0)]
    rows += talk(draw, 500, 60) + talk(draw, None, 9, True)
    rows += rows[:25]  # repeated rows
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.withColumns({c: F.lit("x") for c in ("shape", "audit", "cost", "part", "same")})
    found, repaired = found_rows(df, block_rows=block_rows)
    assert found == expected_rows(rows)
    # The turns themselves give the digests.
    lines = {}
    for r in sorted(repaired.turns().collect(), key=lambda r: (r["part"], r["block"], r["at"])):
        lines.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    digests = {r["conv_id"]: r["repaired_sha256"] for r in repaired.report.collect()}
    for conv, digest in digests.items():
        assert hashlib.sha256("\n".join(lines.get(conv, [])).encode()).hexdigest() == digest


def test_conversation_over_many_tasks(spark):
    """A third of all rows in one conversation, half of them equal: its rows lie in many tasks."""
    draw = random.Random(4)
    rows = [(7, t, ("user", "assistant")[t % 2], "Same." if draw.random() < 0.5 else f"{t}.") for t in range(150)]
    rows += [r for conv in range(40) for r in talk(draw, conv + 10, 6)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    held = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    try:
        repaired = conversations.repair(conversations.damage(df), block_rows=10)
        parts = repaired._blocks.where("conv_id = 7").select("part").distinct().count()
        assert parts > 3
        found = sorted((tuple(r) for r in conversations.report_of_all(df, repaired).collect()), key=repr)
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert found == expected_rows(rows)


def test_conversations_that_lose_all_rows(spark):
    gone = next(c for c in range(10_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(gone, 0, "user", "Hi.")], "conv_id long, turn long, role string, text string")
    empty_hash = hashlib.sha256(b"").hexdigest()
    assert found_rows(df)[0] == [(gone, 0, 0, 0, 0, 0, 0, "", empty_hash)]
    assert found_rows(df.limit(0))[0] == []


def test_conversations_of_the_tables(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert found_rows(df)[0] == expected_rows(rows)

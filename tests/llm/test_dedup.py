"""Line spread, near-duplicates and components against brute force."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from localpulse.llm import graph, linespread, rtree

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return frozenset([tuple(w)] if 0 < len(w) < k else [tuple(w[i : i + k]) for i in range(len(w) - k + 1)])


def brute(docs, k, percent):
    sets = {d: shingles(t, k) for d, t in docs}
    head = {d: d for d in sets}

    def top(x):
        while head[x] != x:
            x = head[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                    x, y = top(a), top(b)
                    head[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), top(d)) for d in sets}


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(5000)}"
    passage = [word() for _ in range(30)]
    docs, n = [], 0
    for _ in range(25):
        base = [word() for _ in range(rng.choice([1, 2, 3, 4, 5, 9, 30, 90, 250]))]
        if rng.random() < 0.4:
            base += passage
        for _ in range(rng.choice([1, 1, 2, 3, 8])):
            copy = [word() if rng.random() < rng.choice([0, 0.005, 0.02, 0.05]) else w for w in base]
            docs.append((n, " ".join(copy).title() if rng.random() < 0.2 else "\n".join(copy)))
            n += 1
    chain = [word() for _ in range(200)]  # neighbours are alike, the ends are not
    for _ in range(12):
        i = rng.randrange(200)
        chain = [*chain[:i], word(), *chain[i + 1 :]]
        docs.append((n, " ".join(chain)))
        n += 1
    return [*docs, (n, None), (n + 1, ""), (n + 2, " \n "), (n + 3, "lone"), (n + 4, "Lone")]


@pytest.mark.parametrize(("seed", "k", "percent"), [(1, 4, 85), (2, 5, 80), (3, 3, 60)])
def test_near_duplicates(spark, seed, k, percent):
    docs = corpus(seed)
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id bigint, text string, node string, n int")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in rtree.near_duplicates(df, words=k, percent=percent).collect()}
    assert got == brute(docs, k, percent)


def test_near_duplicates_odd_rows(spark):
    schema = "doc_id bigint, text string, component_id string"
    df = spark.createDataFrame([(None, "a b c d e", "q"), (4, "a b c d e", "q"), (2, "a b c d e", "r"), (2, "a b c d e", "r"), (9, None, "s")], schema)
    got = sorted(((r.doc_id or 0), r.n_shingles, r.component_id) for r in rtree.near_duplicates(df).collect())
    assert got == [(0, 1, None), (2, 1, 2), (2, 1, 2), (4, 1, 2), (9, 0, 9)]
    kept = rtree.keep_one(df)
    assert kept.columns == df.columns and sorted((r.doc_id or 0) for r in kept.collect()) == [2, 9]
    assert rtree.near_duplicates(spark.createDataFrame([], schema)).count() == 0


def test_rows_of_one_id_unite_their_links(spark):
    """1 is like one text of 5, 7 like the other: all are one component, in any order of rows."""
    x, y = ([f"{c}{i}" for i in range(60)] for c in "xy")
    rows = [(1, " ".join(x)), (5, " ".join([*x[:-1], "z"])), (5, " ".join(y)), (7, " ".join([*y[:-1], "z"])), (9, "q " * 9)]
    for order in (rows, rows[::-1]):
        got = {(r.doc_id, r.component_id) for r in rtree.near_duplicates(spark.createDataFrame(order, "doc_id bigint, text string")).collect()}
        assert got == {(1, 1), (5, 1), (7, 1), (9, 9)}


def test_trees_against_all_pairs():
    """The range query and the join of a tree find just the pairs that the bound leaves, less those of one label."""
    rng = np.random.Generator(np.random.PCG64(8))
    rule = rtree.Rule(4, 85)
    for m in (2, 17, 300):
        points = np.concatenate([rng.poisson(c, (m, rtree.GROUPS)) for c in (3, 9)])[rng.permutation(2 * m)][:m].astype(np.int32)
        points[m // 2 :] = points[rng.integers(0, m // 2 + 1, m - m // 2)] + rng.integers(0, 2, (m - m // 2, rtree.GROUPS))
        n, label = points.sum(1) + rng.integers(0, 3, m), rng.integers(0, 4, m)
        bound = np.minimum(points[:, None], points[None]).sum(2)
        want = rtree._may_link(n[:, None], n[None], bound, rule)
        tree = rtree.CountTree(n, points, label)
        for i in range(0, m, 7):
            assert sorted(tree.near(int(n[i]), points[i], rule).tolist()) == np.flatnonzero(want[i]).tolist()
        got = sorted((min(a, b), max(a, b)) for x, y in tree.pairs(rule) for a, b in zip(x.tolist(), y.tolist(), strict=True))
        assert got == [(a, b) for a in range(m) for b in range(a + 1, m) if want[a, b] and label[a] != label[b]]


@pytest.mark.parametrize("seed", [4, 5])
def test_large_groups_in_chunks(spark, monkeypatch, seed):
    """Blocks far larger than a page, cut into chunks, lose no link: near copies, a chain of copies, and a group just below the threshold."""
    monkeypatch.setattr(rtree, "CHUNK", 24)
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(150)]
    docs = []
    for i in range(120):
        copy = list(base)
        for _ in range(rng.choice([1, 1, 2, 4])):
            copy[rng.randrange(150)] = f"r{i}"
        docs.append((i, " ".join(copy)))
    for i in range(60):
        base[rng.randrange(150)] = f"c{i}"
        docs.append((200 + i, " ".join(base)))
    rng.shuffle(docs)
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in rtree.near_duplicates(df, words=4, percent=85).collect()}
    assert got == brute(docs, 4, 85)


def test_very_long_text(spark):
    long = " ".join(f"w{i}" for i in range(150_000))
    df = spark.createDataFrame([(3, long), (8, long + " end"), (9, long.replace("w1", "v1"))], "doc_id bigint, text string")
    assert {r.doc_id: r.component_id for r in rtree.near_duplicates(df).collect()} == {3: 3, 8: 3, 9: 9}


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, x) for x in range(101, 140)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    head = {x: x for e in edges for x in e}

    def top(x):
        while head[x] != x:
            x = head[x]
        return x

    for a, b in edges:
        x, y = top(a), top(b)
        head[max(x, y)] = min(x, y)
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: top(x) for x in linked}


def test_line_spread(spark):
    rows = []
    for i in range(12):
        rows.append((i, f"own line {i}\nshared by all\n\nshared by few" if i < 3 else f"own line {i}\nshared by all\nseven {i % 7}", f"s{i}" if i else None))
    rows += [(50, None, "s1"), (51, "", "s1"), (52, "   \n ", "s2"), (0, rows[0][1], None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("pos", F.lit("keep"))
    out = linespread.remove_boilerplate(df, min_sites=4)
    got = {r.doc_id: r for r in out.collect()}
    assert out.count() == len(rows) and got[5].pos == "keep"
    assert got[0].text == rows[0][1] and got[0].n_removed == 0
    assert got[5].text == "own line 5\nseven 5" and got[5].n_removed == 1 and got[5].n_lines == 3
    assert got[50].text is None and got[51].text == "" and got[52].text == "   \n " and got[52].n_lines == 0
    assert linespread.remove_boilerplate(df.limit(0)).count() == 0


def test_line_spread_is_exact_near_the_threshold(spark):
    rows = [(100 * n + i, f"line {n}", f"site{i}") for n in range(2, 30) for i in range(n)]
    lines = linespread.line_table(spark.createDataFrame(rows, "doc_id bigint, text string, source string"), "doc_id", "text", "source")
    assert linespread.widespread(lines, 10).count() == 20


def test_line_spread_of_long_texts_and_clashing_names(spark):
    long = "\n".join(f"line {i % 900}" for i in range(20_000))
    df = spark.createDataFrame([(i, long + f"\nown {i}", f"s{i}", "clash") for i in range(4)], "doc_id bigint, text string, source string, n_lines string")
    got = {r.doc_id: r for r in linespread.remove_boilerplate(df, min_sites=3).collect()}
    assert got[3].text == "own 3" and got[3].n_removed == 20_000 and got[3].n_lines == 20_001
    assert got[0].text == "\n".join(f"line {i}" for i in range(900)) + "\nown 0"

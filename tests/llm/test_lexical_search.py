"""Lexical search against plain Python, the ball tree's bounds, and what it prunes."""

import math
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tidegrid.llm import lexical_search
from tidegrid.sources import scratch

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, top=50):
    own = [(d, Counter(terms(t))) for d, t in docs if terms(t)]
    n_docs, total = len(own), sum(sum(c.values()) for _, c in own)
    df = Counter(t for _, c in own for t in c)
    out = []
    for item, text in items:
        found = []
        for d, c in own:
            m = 50 + 50 * sum(c.values()) * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if t in c)
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        out += [(item, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(found, key=lambda f: f[:3])[:top], 1)]
    return sorted(out, key=str)


def tables(draw, n):
    words = [f"w{i}" for i in range(80)] + ["ÉTÉ", "été", "Ünï", "x" * 300]
    docs = [(i, " ".join(draw.choices(words, k=draw.choice([1, 5, 30, 200])))) for i in range(n)]
    docs += [(5000 + i, "Same same, text w1 w2") for i in range(300)]  # a group of copies larger than a result
    docs += [(None, "w1 w2 W3"), (None, "w1 w2 W3"), (7, "w1-w2_w3"), (7, None), (8, ""), (9, "...")]
    items = [(i, " ".join(draw.choices(words, k=draw.choice([1, 3, 20])))) for i in range(20)]
    return docs, [*items, (3, "w1 w1 W2"), (50, None), (51, "!!"), (None, "same TEXT"), (52, "nowhere")]


def test_equals_plain_python(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "BLOCK", 100)
    monkeypatch.setattr(lexical_search, "LEAF", 4)
    for seed, n in ((1, 400), (2, 30)):
        docs, items = tables(random.Random(seed), n)
        with scratch.run(spark):
            df = lexical_search.search(spark.createDataFrame([(*d, "x", "y") for d in docs], "doc_id long, text string, score string, rank string").repartition(3), spark.createDataFrame(items, "item_id long, text string"))
            assert sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=str) == brute(docs, items)


def test_passes_give_the_same(spark, monkeypatch):
    docs, items = tables(random.Random(3), 60)
    monkeypatch.setattr(lexical_search, "PASS_BYTES", 40)
    with scratch.run(spark):
        df = lexical_search.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), 7)
        assert sorted(map(tuple, df.collect()), key=str) == brute(docs, items, 7)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    with scratch.run(spark):
        assert lexical_search.search(docs.where("false"), items).collect() == []
        assert lexical_search.search(docs, items.where("false")).collect() == []
        assert lexical_search.search(docs, items.withColumn("text", F.lit(None).cast("string"))).collect() == []


def clustered(rng, groups, each, terms_of):
    rows = []
    for g in range(groups):
        for _ in range(each):
            own = np.unique(np.append(rng.integers(0, 60, terms_of) + 60 * g, 0))
            rows.append((own, rng.integers(1, 10**10, len(own))))
    return np.concatenate([[0], np.cumsum([len(r[0]) for r in rows])]), np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows])


def test_bounds_hold_for_every_node_and_search_is_exact():
    rng = np.random.default_rng(5)
    indptr, cols, vals = clustered(rng, 6, 50, 12)
    tree = lexical_search.BallTree(indptr, cols, vals, 8)
    assert sorted(tree.order.tolist()) == list(range(300))
    for _ in range(40):
        item = np.unique(rng.integers(0, 360, rng.integers(1, 30)))
        exact = np.array([vals[a:b][np.isin(cols[a:b], item)].sum() for a, b in zip(indptr[:-1], indptr[1:], strict=True)])
        own = np.flatnonzero(np.isin(tree.names, item))
        for k, (lo, hi) in enumerate(tree.range):
            assert tree.bound(k, own) >= exact[tree.order[lo:hi]].max()
        best = lexical_search.Best(10, 0)
        lexical_search.search_tree(tree, np.arange(300) + 7, item, best)
        want = sorted((-s, d + 7) for d, s in enumerate(exact.tolist()) if s > 0)[:10]
        assert sorted(zip((-best.score).tolist(), best.doc.tolist(), strict=True)) == want


def test_subtrees_are_pruned():
    rng = np.random.default_rng(6)
    names, vals = [], []
    for g in range(16):
        base = np.unique(rng.integers(0, 60, 40)) + 60 * g
        worth = rng.integers(10**9, 10**10, len(base))
        for _ in range(64):
            names.append(base), vals.append(worth + rng.integers(0, 10**8, len(base)))
    tree = lexical_search.BallTree(np.concatenate([[0], np.cumsum([len(n) for n in names])]), np.concatenate(names), np.concatenate(vals), 16)
    opened = [lexical_search.search_tree(tree, np.arange(1024), np.arange(60 * g, 60 * g + 60), lexical_search.Best(10, 0)) for g in range(16)]
    assert max(opened) <= tree.kids.count(0) // 4

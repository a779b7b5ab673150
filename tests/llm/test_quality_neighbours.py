"""Nearest-neighbour quality: features and votes against plain Python, held-out labels, odd inputs."""

import random
import re
from collections import Counter
from itertools import groupby

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidegrid.llm import language_id, quality_neighbours
from tidegrid.llm._words import NOT_SPACE, Words, mix
from tidegrid.sources import scratch


def hashed(token):
    data = np.frombuffer(token, np.uint8)
    return Words(data, np.array([0, len(data)]), NOT_SPACE).hashes()[0]


def plain_features(text):
    tokens = re.findall(rb"[^ \t-\r]+", (text or "").encode())
    kind = lambda c: 97 if 97 <= c < 123 or c >= 128 else 65 if 65 <= c < 91 else 48 if 48 <= c < 58 else c
    shapes = [hashed(bytes(k for k, _ in groupby(map(kind, t)))) for t in tokens]
    one = lambda h: int(mix(np.array([h], np.uint64))[0] >> np.uint64(64 - quality_neighbours.BITS))
    out = Counter([one((len(tokens) + 1).bit_length() - 1 + (1 << 40))])
    out.update(one(int(hashed(t)) ^ 1) for t in tokens)
    out.update(one(int(s) ^ 2) for s in shapes)
    out.update(one((int(a) * 3 % 2**64) ^ int(b)) for a, b in zip(shapes, shapes[1:], strict=False))
    for k in quality_neighbours.BACK:
        out.update(one(k + (1 << 41)) for a, b in zip(tokens, tokens[k:], strict=False) if a == b)
    return out


TEXTS = ["", None, "Word word word", "THE!! END!!", "aa### bb### ÉÉ é 12,3 x", "a | b | c\n" * 3, "one\ttwo\vthree four one two " * 5, "zz\xa0zz"]


def test_features_equal_plain_python():
    got = []
    for n, doc, feature, counts in quality_neighbours.features(pa.array(TEXTS)):
        rows = [Counter() for _ in range(n)]
        for d, f, c in zip(doc.tolist(), feature.tolist(), counts.tolist(), strict=True):
            rows[d][f] += c
        got += rows
    assert got == [plain_features(t) for t in TEXTS]


def vector(text, model):
    own = plain_features(text)
    total = sum(own.values())
    x = np.zeros(1 << quality_neighbours.BITS)
    for f, c in own.items():
        x[f] = (c / total) ** 0.5 * model.rarity[f]
    v = (x / np.sqrt(x @ x)) @ model.directions
    return v / np.sqrt(v @ v)


def corpus(draw, n):
    words = [f"word{i}" for i in range(200)]
    good = [" ".join(draw.choices(words, k=draw.randrange(20, 80))) for _ in range(n)]
    bad = [" ".join(w.upper() + "!!" for w in draw.choices(words, k=30)) if i % 2 else (draw.choice(words) + " ") * 40 for i in range(n // 3)]
    return [(i, t, int(i < n)) for i, t in enumerate(good + bad)]


def test_scores_equal_plain_votes_and_learn_what_is_labelled(spark):
    rows = corpus(random.Random(4), 90)
    docs = spark.createDataFrame([r[:2] for r in rows] + [(1000, None), (None, ""), (1001, "...")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows if i % 3] + [(2, 0), (None, 1), (999, 0), (3, None), (6, 7)], "doc_id long, quality int")
    with scratch.run(spark):
        model = quality_neighbours.learn(docs, labels, per_class=40, dimensions=12)
        got = quality_neighbours.score_quality(docs, model).collect()
    known = {i: q for i, _, q in rows if i % 3}
    assert len(model.label) and set(model.label) == {0, 1} and (model.label == 1).sum() < sum(known.values())  # bounded
    assert model.weight[model.label == 1][0] > model.weight[model.label == 0][0] >= 1
    n_docs = 3 + len(rows)
    df = Counter(f for _, t, _ in [*rows, (0, None, 0), (0, "", 0), (0, "...", 0)] for f in plain_features(t))
    for f, n in df.items():
        assert abs(model.rarity[f] - (np.log((1 + n_docs) / (1 + n)) + 0.1)) < 1e-5
    for r in got:
        alike = np.rint(model.vectors @ vector(r["text"], model) * 1e6)
        near = sorted(range(len(alike)), key=lambda k: (-alike[k], k))[: quality_neighbours.NEAREST]
        vote = [max(0, alike[k] / 1e6) ** quality_neighbours.POWER * model.weight[k] for k in near]
        want = sum(v for v, k in zip(vote, near, strict=True) if model.label[k] == 1) / sum(vote) if sum(vote) else None
        assert r["predicted"] == int(r["score"] >= 0.5) and 0 <= r["score"] <= 1
        if want is not None:
            assert abs(r["score"] - want) < 0.02
    wrong = [r for r in got if r["doc_id"] is not None and r["doc_id"] % 3 == 0 and r["doc_id"] < len(rows) and r["predicted"] != rows[r["doc_id"]][2]]
    assert not wrong


def test_directions_are_the_leading_singular_vectors():
    rng = np.random.default_rng(1)
    left, right = rng.standard_normal((60, 4)), rng.standard_normal((4, 30))
    dense = left @ right
    edges, feature, values = np.arange(60) * 30, np.tile(np.arange(30) * 7, 60), dense.ravel().astype(np.float32)
    found = quality_neighbours._directions(edges, feature, values, 4)[np.arange(30) * 7]
    assert np.abs(dense @ found @ found.T - dense).max() < 1e-3


def test_odd_tables(spark):
    docs = spark.createDataFrame([(1, "a b", "x", "y"), (1, "a b", "x", "y"), (2, None, "x", "y"), (3, "long " * 60_000, "x", "y")], "doc_id long, text string, score string, lang string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    with scratch.run(spark):
        got = quality_neighbours.score_quality(docs, quality_neighbours.learn(docs, none))
        assert [r["score"] for r in got.collect()] == [0.5] * 4 and got.columns.count("score") == 1 and "lang" in got.columns
        one = quality_neighbours.learn(docs, spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, quality int"))
        assert {r["predicted"] for r in quality_neighbours.score_quality(docs, one).collect()} == {0}
        empty = docs.where("false")
        assert quality_neighbours.score_quality(empty, quality_neighbours.learn(empty, none)).collect() == []


@pytest.mark.parametrize("sf", ["sf0.01"])
def test_held_out_labels(spark, sf):
    docs, labels = (spark.read.parquet(f"/root/testdata/{sf}/{t}.parquet") for t in ("documents", "labels"))
    out = language_id.held_out("doc_id", 3, 1)
    with scratch.run(spark):
        model = quality_neighbours.learn(docs, labels.where(~out))
        scored = quality_neighbours.score_quality(docs.where(out), model).join(labels, "doc_id").agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")), F.avg(F.when(F.col("quality") == 1, F.col("predicted")))).first()
    assert scored[0] > 0.97 and scored[1] > 0.98

"""The trie against plain Python: long, cut, equal, turnless and odd conversations."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidegrid.llm import prefix_trie
from tidegrid.sources import scratch

SCHEMA = "conv_id long, turn long, role string, text string, depth string, block string, n string"


def brute(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, hashlib.sha256(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).digest()[:16], role or "", text or ""))
    turns = {c: [t[3:] for t in sorted(v)] for c, v in turns.items()}
    members = defaultdict(list)
    full = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(c - 5 * int(c / 5))
        full[c] = tuple(turns.get(base, [])[:h] + own[h:])
        for d in range(len(full[c]) + 1):
            members[full[c][:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    worth, leaves = {}, {}
    for node in sorted(members, key=len, reverse=True):
        worth[node] = (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0) + sum(worth[c] for c in children[node])
        leaves[node] = sum(leaves[c] for c in children[node]) if children[node] else 1
    out = []
    for node, own in members.items():
        ends = ",".join(map(str, sorted(c for c in own if len(full[c]) == len(node))))
        out.append((min(own), len(node), min(members[node[:-1]]) if node else None, len(own), len(children[node]), leaves[node], worth[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[1], r[0]))


def conversations():
    draw = random.Random(7)
    rows = []
    for c in [*range(-12, 60), 500, 501]:
        if c in (10, 25):
            continue  # a base that is absent
        length = draw.choice([1, 2, 3, 8, 9, 16, 17, 40])
        start = draw.randrange(3)
        for t in range(length):
            same = t < draw.choice([0, 4, 20])
            rows.append((c, t if draw.random() < 0.95 else None, "user" if t % 2 else None, f"turn {t} {start}" if same else draw.choice([f"ünique {c} {t}", "", None])))
    rows += [(c, t, "user", f"copied {t}") for c in range(1000, 1300, 5) for t in range(70)]  # copies, longer than a run of blocks
    rows += [(2000, 1, "user", "tie"), (2000, 1, "user", "tie"), (2000, 1, "bot", "tie"), (2000, 1, "use", "rtie"), (None, 1, "user", "nobody")]
    return rows


@pytest.fixture(autouse=True)
def short_runs(monkeypatch):
    monkeypatch.setattr(prefix_trie, "RUN", 3)
    monkeypatch.setattr(prefix_trie, "SPAN", 10)


def test_equals_plain_python(spark):
    rows = conversations()
    with scratch.run(spark):
        df = prefix_trie.prefix_trie(spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA))
        got = sorted(map(tuple, df.collect()), key=lambda r: (r[1], r[0]))
    assert got == brute(rows)


def test_empty_turnless_and_single(spark):
    empty = spark.createDataFrame([], SCHEMA)
    with scratch.run(spark):
        assert prefix_trie.prefix_trie(empty).collect() == []
        cut = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 2)
        rows = [(cut, 1, "user", "a"), (cut, 2, "bot", "b")]
        got = prefix_trie.prefix_trie(spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)).collect()
        assert list(map(tuple, got)) == brute(rows) and got[0]["depth"] == 0 and got[0]["n_leaves"] == 1


def test_nothing_is_left_behind(spark, monkeypatch):
    before = set(scratch._OPEN)
    with scratch.run(spark):
        prefix_trie.prefix_trie(spark.range(20).select(F.col("id").alias("conv_id"), F.lit(1).cast("long").alias("turn"), F.lit("user").alias("role"), F.lit("x").alias("text"))).collect()
    assert set(scratch._OPEN) == before

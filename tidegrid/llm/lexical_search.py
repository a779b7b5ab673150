"""Ranked lexical search: exact inner-product search in sparse ball trees.

A document is the sparse vector of its terms' impacts, an item the 0/1 vector of its distinct terms, so a score is their inner
product. Weights and lengths come from the whole corpus. Documents are kept as postings of the terms that items ask for, which changes
no score; every block of them becomes a ball tree, split at the median along the line between two documents far apart. A node has the
centroid of its documents and the radius around it, so for an item q no document below scores over q . centroid + |q| radius, where
only the terms of q that the node holds count in |q|; that is raised by more than all rounding, so it is safe. Subtrees are opened best-first and left as soon as their bound is below the item's
50th best; leaves are scored in 64-bit integers. Every document is in a tree, and nothing that could rank is skipped.

A search of a small part of the documents comes first: its 50th best score is a floor for the whole search, which prunes from the first
block on. A floor only saves work, as no floor is above what the full search finds.

Items are sent to the tasks in passes of about ``PASS_BYTES`` of terms, so any number of them can be asked; a pass reads the documents
once. What a task sends back is its best ``top`` of each item at most.

Null texts and texts without a term are no documents and rank nowhere; items without a term have no rows. Rows that are repeated are
documents or items of their own; equal scores go by doc_id, null last. doc_id is an integer. Other columns are not read. Long texts are
read whole; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.llm._frames import discard, saved, small_batches
from tidegrid.llm._words import ALNUM, Words, chunks

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TOP = 50
#: Documents and postings of a block, and documents of a leaf.
BLOCK, BLOCK_POSTINGS, LEAF = 4096, 1 << 20, 32
#: Bytes of items' terms that a pass sends to the tasks.
PASS_BYTES = 16 << 20
#: One document in so many is searched first, for floors.
FIRST = 32
# The scale of impacts, and of a length's share in them.
SCALE, UNIT, LENGTH, SLOPE = 1_000_000_000, 1000, 20, 50

POSTINGS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n", T.LongType()), T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("tfs", T.ArrayType(T.IntegerType()))])
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_LAST = np.iinfo(np.int64).max


@dataclass
class Items:
    """The items of a pass: their rows, their terms (places in the vocabulary, rising), and the vocabulary, sorted by hash."""

    rows: list[tuple]
    terms: list[np.ndarray]
    hashes: np.ndarray
    data: np.ndarray
    start: np.ndarray
    size: np.ndarray

    @staticmethod
    def of(rows: list[tuple], terms: list[list[str]]) -> Items:
        words = sorted({t for own in terms for t in own})
        parts = [w.encode() for w in words]
        sizes = np.array([len(p) for p in parts], np.int64)
        data, starts = np.frombuffer(b" ".join(parts), np.uint8), np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]).astype(np.int64) if parts else np.zeros(0, np.int64)
        hashes = Words(data, np.array([0, len(data)]), ALNUM, fold=True).hashes()
        order = np.argsort(hashes, kind="stable")
        place = dict(zip((words[k] for k in order.tolist()), range(len(words)), strict=True))
        return Items(rows, [np.array(sorted(place[t] for t in own), np.int64) for own in terms], hashes[order], data, starts[order], sizes[order])

    def find(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Words of a text that are in the vocabulary, and their places in it. Bytes are compared."""
        if not len(self.hashes) or not len(words.start):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        h = words.hashes()
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        left = np.flatnonzero(self.hashes[at] == h)
        own, found = [], []
        while len(left):  # once, but for vocabulary terms with one hash
            same = self._equal(words, left, at[left])
            own.append(left[same]), found.append(at[left[same]])
            left = left[~same]
            at[left] += 1
            left = left[at[left] < len(self.hashes)]
            left = left[self.hashes[at[left]] == h[left]]
        return np.concatenate([np.zeros(0, np.int64), *own]), np.concatenate([np.zeros(0, np.int64), *found])

    def _equal(self, words: Words, own: np.ndarray, at: np.ndarray) -> np.ndarray:
        sizes = words.end[own] - words.start[own]
        same = sizes == self.size[at]
        own, at, sizes = own[same], at[same], sizes[same]
        if len(own):
            ahead = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            within = np.arange(int(sizes.sum())) - np.repeat(ahead, sizes)
            alike = _FOLD[words.data[np.repeat(words.start[own], sizes) + within]] == self.data[np.repeat(self.start[at], sizes) + within]
            same[np.flatnonzero(same)] = np.logical_and.reduceat(alike, ahead)
        return same


def postings(documents: DataFrame, items: Items) -> DataFrame:
    """doc_id, n (terms with repeats), and of the terms that items ask for, places in the vocabulary and occurrences. Rows without a term
    are left out."""
    small_batches(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        v = max(1, len(known.hashes))
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for row, last, data, offsets in chunks(batch.column(1)):
                words = Words(data, offsets, ALNUM, fold=True)
                own, at = known.find(words)
                keys, tfs = np.unique(words.doc[own] * v + at, return_counts=True)
                edges = np.searchsorted(keys, np.arange(last - row + 1) * v)
                some = words.n > 0
                sizes = np.diff(edges)[some]
                lists = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, last - row).filter(pa.array(some)), pa.array(words.n[some], pa.int64()), pa.ListArray.from_arrays(lists, pa.array(keys % v, pa.int32())), pa.ListArray.from_arrays(lists, pa.array(tfs, pa.int32()))], names=POSTINGS.names)
            del ids

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.col("text").isNotNull()).mapInArrow(run, POSTINGS)


def document_frequencies(rows: DataFrame, size: int) -> np.ndarray:
    """Of each term of the vocabulary, the documents that hold it; a task sends one sum a term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["term", "n"])

    found = rows.select("terms").mapInArrow(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size, np.int64)
    out[found.column("term").to_numpy()] = found.column("n").to_numpy()
    return out


class BallTree:
    """Of documents in rows of (indptr, terms, values): nodes with a range of rows, a sparse centroid and a radius. Child nodes of node k
    are kids[k] and kids[k] + 1, 0 for a leaf."""

    def __init__(self, indptr: np.ndarray, terms: np.ndarray, values: np.ndarray, leaf: int = LEAF):
        self.names, terms = np.unique(terms, return_inverse=True)  # the block's own terms
        n, sizes = len(indptr) - 1, np.diff(indptr)
        reals, order = values.astype(np.float64), np.arange(n)
        norms = np.add.reduceat(reals * reals, indptr[:-1]) if n else np.zeros(0)
        self.range, self.kids, self.centroid, self.radius = [(0, n)], [0], [], []
        k = 0
        while k < len(self.range):
            lo, hi = self.range[k]
            own = order[lo:hi]
            at = np.repeat(indptr[own] - np.concatenate([[0], np.cumsum(sizes[own])[:-1]]), sizes[own]) + np.arange(int(sizes[own].sum()))
            cols, vals, edges = terms[at], reals[at], np.concatenate([[0], np.cumsum(sizes[own])[:-1]])
            mean = np.bincount(cols, vals, len(self.names)) / (hi - lo)
            away = self._away(vals, cols, edges, norms[own], mean)
            some = np.flatnonzero(mean)
            self.centroid.append((some, mean[some])), self.radius.append(float(away.max()))
            if hi - lo > leaf and away.max() > 0:
                a = self._row(int(away.argmax()), cols, vals, edges)
                b = self._row(int(self._away(vals, cols, edges, norms[own], a).argmax()), cols, vals, edges)
                side = np.add.reduceat(vals * (b - a)[cols], edges)
                half = (hi - lo) // 2
                order[lo:hi] = own[np.argpartition(side, half)]
                self.kids[k] = len(self.range)
                self.range += [(lo, lo + half), (lo + half, hi)]
                self.kids += [0, 0]
            k += 1
        at = np.repeat(indptr[order] - np.concatenate([[0], np.cumsum(sizes[order])[:-1]]), sizes[order]) + np.arange(len(terms))
        self.order, self.indptr, self.terms, self.values = order, np.concatenate([[0], np.cumsum(sizes[order])]), terms[at], values[at]

    def _row(self, k: int, cols: np.ndarray, vals: np.ndarray, edges: np.ndarray) -> np.ndarray:
        own = slice(edges[k], edges[k + 1] if k + 1 < len(edges) else None)
        out = np.zeros(len(self.names))
        out[cols[own]] = vals[own]
        return out

    @staticmethod
    def _away(vals: np.ndarray, cols: np.ndarray, edges: np.ndarray, norms: np.ndarray, point: np.ndarray) -> np.ndarray:
        """Distances from a point, never too small: the rounding of the squares is added before the root."""
        far = point @ point
        return np.sqrt(np.maximum(0, norms - 2 * np.add.reduceat(vals * point[cols], edges) + far) + 1e-11 * (norms + far))

    def bound(self, k: int, own: np.ndarray) -> float:
        """No document below node k scores more for the item whose terms (of the block) are own."""
        some, mean = self.centroid[k]
        at = np.minimum(np.searchsorted(some, own), len(some) - 1)
        held = mean[at[some[at] == own]]
        return (float(held.sum()) + math.sqrt(len(held)) * self.radius[k]) * (1 + 1e-9) + 1

    def scores(self, k: int, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of leaf k, and their scores in integers; asked: which of the block's terms the item has."""
        lo, hi = self.range[k]
        a, b = self.indptr[lo], self.indptr[hi]
        return self.order[lo:hi], np.add.reduceat(np.where(asked[self.terms[a:b]], self.values[a:b], 0), self.indptr[lo:hi] - a)


class Best:
    """The best ``top`` (score, doc_id) of an item so far, equal scores by id; scores below the floor are not wanted."""

    def __init__(self, top: int, floor: int):
        self.top, self.least = top, max(1, floor)
        self.score, self.doc = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, score: np.ndarray, doc: np.ndarray) -> None:
        good = score >= self.least
        if good.any():
            self.score, self.doc = np.concatenate([self.score, score[good]]), np.concatenate([self.doc, doc[good]])
            if len(self.score) > self.top:
                keep = np.lexsort((self.doc, -self.score))[: self.top]
                self.score, self.doc = self.score[keep], self.doc[keep]
            if len(self.score) == self.top:
                self.least = max(self.least, int(self.score.min()))  # as good a score may still come with a smaller id


def search_tree(tree: BallTree, doc: np.ndarray, terms: np.ndarray, best: Best) -> int:
    """Best-first search for one item; returns the leaves that were scored."""
    at = np.minimum(np.searchsorted(tree.names, terms), max(0, len(tree.names) - 1))
    own = at[tree.names[at] == terms] if len(tree.names) else np.zeros(0, np.int64)
    if not len(own):
        return 0
    asked = np.zeros(len(tree.names), bool)
    asked[own] = True
    heap, opened = [(-tree.bound(0, own), 0)], 0
    while heap and -heap[0][0] >= best.least:
        _, k = heapq.heappop(heap)
        if tree.kids[k]:
            for kid in (tree.kids[k], tree.kids[k] + 1):
                bound = tree.bound(kid, own)
                if bound >= best.least:
                    heapq.heappush(heap, (-bound, kid))
        else:
            rows, score = tree.scores(k, asked)
            best.add(score, doc[rows])
            opened += 1
    return opened


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


def _searched(rows: DataFrame, terms: list[np.ndarray], weight: np.ndarray, n_docs: int, n_terms: int, floors: list[int], top: int) -> DataFrame:
    """(item, doc_id, score): of each task, the best of each item."""
    small_batches(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast((terms, weight, floors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, w, least = shared.value
        best = [Best(top, f) for f in least]
        held: list[tuple[np.ndarray, ...]] = []

        def search() -> None:
            docs, n, sizes, own, tfs = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            m = 100 - SLOPE + (50 * n * n_docs) // n_terms
            values = w[own] * ((SCALE * tfs) // (UNIT * tfs + LENGTH * np.repeat(m, sizes)))
            tree = BallTree(np.concatenate([[0], np.cumsum(sizes)]), own, values)
            for k, item in enumerate(asked):
                search_tree(tree, docs, item, best[k])

        size = postings_held = 0
        for batch in batches:
            lists = batch.column(2)
            sizes = np.diff(lists.offsets.to_numpy())
            some = sizes > 0
            docs = np.where(np.asarray(batch.column(0).is_null()), _LAST, batch.column(0).fill_null(0).to_numpy())
            held.append((docs[some], batch.column(1).to_numpy()[some], sizes[some], lists.flatten().to_numpy().astype(np.int64), batch.column(3).flatten().to_numpy().astype(np.int64)))
            size, postings_held = size + int(some.sum()), postings_held + int(sizes.sum())
            if size >= BLOCK or postings_held >= BLOCK_POSTINGS:
                search()
                size = postings_held = 0
        if size:
            search()
        for k, own in enumerate(best):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own.doc), k, np.int32)), pa.array(own.doc, mask=own.doc == _LAST), pa.array(own.score)], names=["item", "doc_id", "score"])

    found = rows.select("doc_id", "n", "terms", "tfs").mapInArrow(run, "item int, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _passes(items: DataFrame) -> Iterator[Items]:
    """The items by passes of about PASS_BYTES of terms."""
    text = F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = items.select("item_id", F.array_distinct(F.regexp_extract_all(text, F.lit(TERM), F.lit(0))).alias("terms")).where(F.size("terms") > 0)
    total = rows.agg(F.coalesce(F.sum(F.octet_length(F.array_join("terms", " "))), F.lit(0))).first()[0]
    n = max(1, -(-total // PASS_BYTES))
    for k in range(n if total else 0):
        own = rows.where(F.pmod(F.xxhash64("item_id", "terms"), F.lit(n)) == k).collect()
        if own:
            yield Items.of([(r["item_id"],) for r in own], [r["terms"] for r in own])


def search(documents: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: of each row of items, the ``top`` documents with the highest scores above 0."""
    spark = documents.sparkSession
    out = spark.createDataFrame([], T.StructType([items.schema["item_id"], T.StructField("rank", T.IntegerType()), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())]))
    for asked in _passes(items):
        rows = saved(postings(documents, asked), "postings")
        n_docs, n_terms = rows.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not n_docs:
            discard(rows)
            return out
        weight = weights(document_frequencies(rows, len(asked.hashes)), n_docs)
        some = rows.where(F.size("terms") > 0)
        part = some.where(F.pmod(F.xxhash64("doc_id", "n"), F.lit(FIRST)) == 0)
        floors = [0] * len(asked.rows)
        for r in _searched(part, asked.terms, weight, n_docs, n_terms, floors, top).where(F.col("rank") == top).select("item", "score").collect():
            floors[r["item"]] = r["score"]
        found = saved(_searched(some, asked.terms, weight, n_docs, n_terms, floors, top), "ranked")
        discard(rows)
        names = spark.createDataFrame([(k, *r) for k, r in enumerate(asked.rows)], T.StructType([T.StructField("item", T.IntegerType()), items.schema["item_id"]]))
        out = out.unionByName(found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    return out

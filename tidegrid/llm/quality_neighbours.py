"""Quality by nearest-neighbour voting over labelled latent-semantic vectors.

A text becomes counts of hashed features: its words, the shapes of its tokens (runs of letters, capitals, digits and single signs)
alone and in pairs, tokens that stand again within a few places, and the magnitude of its length. Counts go in as square roots of
shares, times the rarity of a feature among all documents, and are projected on the leading singular vectors of the labelled sample.
Every document is compared with every labelled vector by a blocked product of unit vectors, none left out; its ``NEAREST`` vote,
by a power of their similarity and by how many labels each stands for.

The classifier is fitted on about ``PER_CLASS`` labelled documents of each class, chosen by a hash of their id: a documented bound, so
the vectors and the projection that are broadcast have a fixed size. Rarities are counted over all documents.

Null and empty texts have the feature of their length only; they and whatever else is like nothing labelled get the share of label 1.
Labels other than 0 and 1, labels without id and labels of no document teach nothing; an id with two labels has the greater; without
labels, every score is 0.5. Ties go to the label that sorts first. Repeated rows are scored alike. Other columns pass through;
those named like an output are replaced. Long texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.llm._frames import discard, map_column, saved, small_batches
from tidegrid.llm._words import NOT_SPACE, Words, chunks, mix

#: Bits of a hashed feature, latent dimensions, labels of a class, neighbours that vote, the power of their similarity, the cut.
BITS, DIMENSIONS, PER_CLASS, NEAREST, POWER, CUT = 15, 64, 4000, 15, 8, 0.5
#: Places back in which a token that stands again is noticed.
BACK = (1, 2, 4, 8)
#: Documents that are compared in one product.
BLOCK = 512
OUTPUT = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[97:123] = _SHAPE[128:] = 97
_SHAPE[65:91] = 65
_SHAPE[48:58] = 48


def _shapes(words: Words) -> np.ndarray:
    """The hash of each token's shape: equal neighbours of a class count once."""
    kind = _SHAPE[words.data]
    keep = np.ones(len(kind), bool)
    keep[1:] = (kind[1:] != kind[:-1]) | ~NOT_SPACE[words.data[1:]]
    inner = words.offsets[1:-1]
    keep[inner[inner < len(keep)]] = True  # a text starts anew
    upto = np.concatenate([[0], np.cumsum(keep)])
    return Words(kind[keep], upto[words.offsets], NOT_SPACE).hashes()


def features(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Of each chunk of texts: how many they are, and text, feature and count of each feature of each text, in that order."""
    for row, last, data, offsets in chunks(column):
        words = Words(data, offsets, NOT_SPACE, fold=False)
        n, doc, h = last - row, words.doc, words.hashes()
        found = [(np.arange(n), mix(np.floor(np.log2(words.n + 1)).astype(np.uint64) + np.uint64(1 << 40)))]
        if len(h):
            shape = _shapes(words)
            found += [(doc, mix(h ^ np.uint64(1))), (doc, mix(shape ^ np.uint64(2)))]
            two = np.flatnonzero(doc[1:] == doc[:-1])
            found.append((doc[two], mix(shape[two] * np.uint64(3) ^ shape[two + 1])))
            for k in BACK:
                again = np.flatnonzero((h[k:] == h[:-k]) & (doc[k:] == doc[:-k])) if len(h) > k else np.zeros(0, np.int64)
                found.append((doc[again], np.full(len(again), mix(np.array([k + (1 << 41)], np.uint64))[0])))
        keys = np.concatenate([(d.astype(np.int64) << BITS) | (f >> np.uint64(64 - BITS)).astype(np.int64) for d, f in found])
        keys, counts = np.unique(keys, return_counts=True)
        yield n, keys >> BITS, keys & ((1 << BITS) - 1), counts


def rarities(documents: DataFrame) -> np.ndarray:
    """Of each feature, the logarithm of how rare it is among all documents; a task sends one sum a feature."""
    small_batches(documents.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((1 << BITS) + 1, np.int64)
        for batch in batches:
            for n, _, feature, _ in features(batch.column(0)):
                total[:-1] += np.bincount(feature, minlength=1 << BITS)
                total[-1] += n
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["feature", "n"])

    found = documents.select("text").mapInArrow(count, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros((1 << BITS) + 1, np.int64)
    total[found.column("feature").to_numpy()] = found.column("n").to_numpy()
    return np.log((1 + total[-1]) / (1 + total[:-1])) + 0.1


def _weighted(n: int, doc: np.ndarray, feature: np.ndarray, counts: np.ndarray, rarity: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place of each text, and values of unit length; every text has a feature."""
    edges = np.searchsorted(doc, np.arange(n))
    values = np.sqrt(counts / np.add.reduceat(counts, edges)[doc]) * rarity[feature]
    return edges, (values / np.sqrt(np.add.reduceat(values * values, edges))[doc]).astype(np.float32)


def _times(edges: np.ndarray, feature: np.ndarray, values: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The product of sparse rows with a matrix, a run of rows at a time."""
    out, ends = [np.zeros((0, right.shape[1]), np.float32)], np.append(edges[1:], len(feature))
    row = 0
    while row < len(edges):
        last = max(row + 1, int(np.searchsorted(ends, edges[row] + 65536, "right")))
        a, b = edges[row], ends[last - 1]
        out.append(np.add.reduceat(right[feature[a:b]] * values[a:b, None], edges[row:last] - a))
        row = last
    return np.concatenate(out)


def _unit(x: np.ndarray) -> np.ndarray:
    size = np.sqrt((x * x).sum(1, keepdims=True))
    return np.divide(x, size, out=np.zeros_like(x), where=size > 0)


@dataclass
class Model:
    """The rarity of features, their latent directions, and the labelled unit vectors with label and weight."""

    rarity: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    label: np.ndarray
    weight: np.ndarray

    def vectors_of(self, column: pa.Array) -> Iterator[np.ndarray]:
        for n, doc, feature, counts in features(column):
            edges, values = _weighted(n, doc, feature, counts, self.rarity)
            yield _unit(_times(edges, feature, values, self.directions))

    def scores(self, own: np.ndarray) -> np.ndarray:
        """The vote of the nearest labelled vectors, by blocks of documents."""
        if not len(self.label):
            return np.full(len(own), 0.5)
        share = float(self.weight @ self.label / self.weight.sum())
        k, out = min(NEAREST, len(self.label)), []
        for row in range(0, len(own), BLOCK):
            alike = np.rint(own[row : row + BLOCK] @ self.vectors.T * 1e6).astype(np.int64)
            near = np.argpartition(alike * len(self.label) - np.arange(len(self.label)), -k, axis=1)[:, -k:]  # equal ones by place
            near.sort(axis=1)
            vote = np.maximum(0, np.take_along_axis(alike, near, 1) / 1e6) ** POWER * self.weight[near]
            both = vote.sum(1)
            out.append(np.where(both > 0, (vote * self.label[near]).sum(1) / np.where(both > 0, both, 1), share))
        return np.clip(np.concatenate([np.zeros(0), *out]), 0, 1)


def _directions(edges: np.ndarray, feature: np.ndarray, values: np.ndarray, dimensions: int, rounds: int = 3) -> np.ndarray:
    """The leading right singular vectors of sparse rows, by subspace iteration from a seeded start."""
    size, n = 1 << BITS, len(edges)
    doc = np.repeat(np.arange(n), np.diff(np.append(edges, len(feature))))
    order = np.argsort(feature, kind="stable")
    kinds, first = np.unique(feature[order], return_index=True)  # the rows of the transposed matrix
    wide = min(dimensions + 16, n, len(kinds))
    basis = np.random.default_rng(0).standard_normal((size, wide)).astype(np.float32)
    for _ in range(rounds):
        left, _ = np.linalg.qr(_times(edges, feature, values, basis))
        back = np.zeros((size, left.shape[1]), np.float32)
        back[kinds] = _times(first, doc[order], values[order], left)
        basis, _ = np.linalg.qr(back)
    _, _, turned = np.linalg.svd(_times(edges, feature, values, basis), full_matrices=False)
    return np.ascontiguousarray((basis @ turned.T)[:, :dimensions]).astype(np.float32)


def learn(documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, dimensions: int = DIMENSIONS) -> Model:
    """The model from documents (doc_id, text) and labels (doc_id, quality), about per_class labels of each class."""
    rarity = rarities(documents)
    none = Model(rarity, np.zeros((1 << BITS, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0), np.zeros(0))
    known = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    sizes = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    rates = {k: min(1.0, per_class / n) for k, n in sizes.items()}
    rate = F.when(F.col("quality") == 1, rates.get(1, 1.0)).otherwise(rates.get(0, 1.0))
    drawn = known.where(F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 20)) < rate * (1 << 20))
    sample = documents.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").select("doc_id", "text", F.col("quality").cast("int").alias("quality"))  # 2 per_class ids are sent
    small_batches(documents.sparkSession)

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = 0
            for n, doc, feature, counts in features(batch.column("text")):
                lists = pa.array(np.append(np.searchsorted(doc, np.arange(n)), len(doc)), pa.int32())
                rest = [batch.column(c).slice(row, n) for c in ("doc_id", "quality")]
                yield pa.RecordBatch.from_arrays([rest[0].cast(pa.string()), rest[1], pa.ListArray.from_arrays(lists, pa.array(feature, pa.int32())), pa.ListArray.from_arrays(lists, pa.array(counts, pa.int32()))], names=["doc_id", "quality", "features", "counts"])
                row += n

    # repeated rows of an id are one label; sorted, so that reruns agree
    table = saved(sample.mapInArrow(sparse, "doc_id string, quality int, features array<int>, counts array<int>").distinct(), "quality-sample")
    rows = table.toArrow().sort_by([("doc_id", "ascending")]).combine_chunks()
    discard(table)
    if not rows.num_rows:
        return none
    lists = rows.column("features").combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    counts = rows.column("counts").combine_chunks()
    counts = counts.chunk(0) if isinstance(counts, pa.ChunkedArray) else counts
    sizes_of = np.diff(lists.offsets.to_numpy())
    doc, feature = np.repeat(np.arange(len(sizes_of)), sizes_of), lists.flatten().to_numpy().astype(np.int64)
    edges, values = _weighted(len(sizes_of), doc, feature, counts.flatten().to_numpy(), rarity)
    directions = _directions(edges, feature, values, dimensions)
    label = rows.column("quality").to_numpy().astype(np.float64)
    weight = np.where(label == 1, 1 / rates.get(1, 1.0), 1 / rates.get(0, 1.0))
    return Model(rarity.astype(np.float32), directions, _unit(_times(edges, feature, values, directions)), label, weight)


def score_quality(documents: DataFrame, model: Model, cut: float = CUT) -> DataFrame:
    """documents with score and predicted."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def fn(column: pa.Array) -> list[pa.Array]:
        own = shared.value
        score = np.concatenate([np.zeros(0), *(own.scores(v) for v in own.vectors_of(column))])
        return [pa.array(score, pa.float64()), pa.array((score >= cut).astype(np.int32), pa.int32())]

    return map_column(documents, "text", OUTPUT, fn)

"""N-gram Jaccard join with PartEnum signatures.

A document's set holds the hashes of its distinct ``n`` -word shingles (words lower-cased A-Z); with fewer words, the
whole sequence. Two sets link when 100 * intersection >= THRESHOLD * union.

Sets are dealt to bands of sizes; a set that can link into the next band signs there too. Within a band linked sets differ
in at most k features. The feature domain is cut into groups of ``PARTS`` = 3 partitions each, k // 2 + 1 groups and some spare
ones. By counting, linked sets differ in one feature at most in one group and in each of as many others as are spare, and there
they agree in two whole partitions of the three. So a signature is a subset of two partitions of a group with the features in
it, and all such subsets are enumerated.

A subset without features says nothing, and very many sets share it. It is signed only by sets with more weak groups (those
with features in one partition at most) than there are spare ones: of any other set's agreeing groups one is not weak, so
a subset with features agrees, and the partner signs that in any case. So linked sets always share a signature; how many
they share at least follows from the features in which they can differ, and from the subsets that one may leave unsigned.

Equal sets are one class. Per signature, classes are compared with a leader, the member whose signatures are
the most common; that is linear in the group, and pairs that the better ones have joined are left out. Signatures whose classes do not all fall into one component
then go through an exact prefix join: a class's rarest features first, pairs of different components only.
So large groups of near copies are joined without emitting all pairs, and no link between components is lost.

Null, empty and wordless texts have no shingles, link with nothing and are their own component; equal ids
are judged by their own texts; a row without id joins only rows with an equal set, and has a null component if
there are none with an id; an empty table gives no rows. Long texts are handled whole. Columns other than those read pass through ``keep_one_of_each_group``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.llm._frames import alone, discard, free_name, key_sketch, map_column, may_hold, saved
from tidegrid.llm._words import Words, chunks, mix
from tidegrid.llm.components import components

SHINGLE, THRESHOLD = 3, 90
#: Growth of a band's sizes; over 100 / THRESHOLD.
BAND = 1.4
#: Partitions of a group; a signature takes two of them.
PARTS = 3
#: Most spare groups, and the share of a band's sets that may sign subsets without features, if that can be had.
SPARE, EMPTY_SHARE = 6, 0.002
#: Sketches of features by the classes that have them; and the share of all features from which on a feature's count is
#: broadcast: there are no more than COMMON such.
TIERS, COMMON = 5, 1_000_000
#: Sets that a task remembers, so as not to sign equal ones again.
REMEMBERED = 500_000

#: Features that are ranked at a time; a set of more is ranked alone. Each takes some 100 bytes while it is.
RANKED = 1 << 16

#: Stands for a null id while rows are dealt.
NO_ID = (1 << 63) - 1

_C = np.uint64(0xA0761D6478BD642F)
_PAIRS = ((0, 1), (0, 2), (1, 2))


def sets_of(column: pa.Array, n: int) -> Iterator[np.ndarray]:
    """For each text its sorted distinct shingle hashes."""
    for row, last, data, offsets in chunks(column):
        words = Words(data, offsets, fold=True)
        count = len(words.start)
        hashes = words.window_hashes(np.arange(count - n + 1), n) if count >= n else np.zeros(0, np.uint64)
        short = np.flatnonzero((words.n > 0) & (words.n < n))
        whole = dict(zip(short.tolist(), words.range_hashes(words.first[short], words.first[short + 1]), strict=True)) if len(short) else {}
        for d in range(last - row):
            yield np.array([whole[d]], np.uint64) if d in whole else np.unique(hashes[words.first[d] : max(words.first[d], words.first[d + 1] - n + 1)])


def digests(found: np.ndarray) -> tuple[int, int]:
    return int(mix(found).sum(dtype=np.uint64).astype(np.int64)), int(mix(found ^ _C).sum(dtype=np.uint64).astype(np.int64))


def _edges(upto: int) -> np.ndarray:
    edges = [1]
    while edges[-1] <= upto:
        edges.append(max(edges[-1] + 1, int(edges[-1] * BAND)))
    return np.array(edges)


class Signatures:
    """PartEnum signatures of sets under a threshold in percent."""

    def __init__(self, threshold: int):
        self.threshold, self.edges = threshold, _edges(1 << 16)
        self._groups: dict[int, tuple[int, int, int]] = {}

    def groups(self, band: int) -> tuple[int, int, int]:
        """(greatest difference, groups, spare ones) of a band. Sizes a, b that link differ in (a + b)(100 - t)/(100 + t) at most."""
        if band not in self._groups:
            low, top = int(self.edges[band]), int(self.edges[band + 1]) - 1
            k = 2 * top * (100 - self.threshold) // (100 + self.threshold)
            best = (2.0, 1, 0)
            for spare in range(1, SPARE + 1) if k else ():
                n = k // 2 + 1 + spare
                mean = n * min(1.0, PARTS ** (1 - low / n))  # weak groups of the smallest sets
                more = 1 - sum(np.exp(-mean) * mean**i / math.factorial(i) for i in range(spare + 1))
                best = min(best, (max(more, EMPTY_SHARE), n, spare))  # the fewest groups that do
            self._groups[band] = (k, *best[1:])
        return self._groups[band]

    def of(self, found: np.ndarray) -> tuple[np.ndarray, int, int]:
        """The signatures, how many of them any linked set shares at least, and how many subsets may be left unsigned."""
        size = len(found)
        if size >= self.edges[-1]:
            self.edges = _edges(2 * size)
        band = int(np.searchsorted(self.edges, size, "right")) - 1
        if self.edges[-1] <= self.edges[band + 1]:
            self.edges = _edges(4 * size)
        out = [self._in_band(found, band)]
        if 100 * size // self.threshold >= self.edges[band + 1]:
            out.append(self._in_band(found, band + 1))
        return np.concatenate([own for own, _, _ in out]), min(need for _, need, _ in out), max(unsigned for _, _, unsigned in out)

    def shared(self, a: np.ndarray, b: np.ndarray, unsigned: np.ndarray) -> np.ndarray:
        """How many signatures linked sets of sizes a and b share at least, if one of them leaves so many subsets unsigned at most. They
        share a band that is the larger one's own."""
        top = np.maximum(a, b)
        while len(top) and self.edges[-2] <= top.max():
            self.edges = _edges(2 * int(top.max()))
        band = np.searchsorted(self.edges, top, "right") - 1
        known = {int(k): self.groups(int(k)) for k in np.unique(band)}
        k, n = (np.array([known[int(x)][i] for x in band], np.int64) for i in (0, 1))
        differ = np.minimum(k, (a + b) * (100 - self.threshold) // (100 + self.threshold))
        return np.where(k > 0, np.maximum(1, PARTS * n - 2 * np.minimum(differ, n) - np.maximum(0, differ - n) - unsigned), 1)

    def _in_band(self, found: np.ndarray, band: int) -> tuple[np.ndarray, int, int]:
        k, n, spare = self.groups(band)
        if not k:
            return mix(mix(found ^ _C).sum(keepdims=True) + mix(np.array([(band + 1) << 32], np.uint64))), 1, 0
        cell = ((found >> np.uint64(32)) * np.uint64(n * PARTS)) >> np.uint64(32)  # found is sorted, so cell is
        first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
        sums, full = np.zeros(n * PARTS, np.uint64), np.zeros(n * PARTS, bool)
        sums[cell[first]] = np.add.reduceat(mix(found ^ _C), first)
        full[cell[first]] = True
        sums, full = sums.reshape(n, PARTS), full.reshape(n, PARTS)
        subsets = np.stack([sums[:, i] + sums[:, j] for i, j in _PAIRS], axis=1).ravel()
        filled = np.stack([full[:, i] | full[:, j] for i, j in _PAIRS], axis=1).ravel()
        out = mix(subsets + mix(np.arange(n * PARTS, dtype=np.uint64) + np.uint64((band + 1) << 32)))
        weak, empty = int((full.sum(1) < 2).sum()), int((~filled).sum())
        # features in which a linked set can differ spoil the more subsets the more groups they are in: two in a group's first, one in the next
        differ = min(k, len(found) * (100 - self.threshold) // self.threshold)
        agree = n - differ // 2
        shared = PARTS * n - 2 * min(differ, n) - max(0, differ - n)
        if weak > spare:  # signs all; a set that does not has no more than the spare ones weak
            return out, max(1, agree - spare, shared - PARTS * spare), PARTS * spare
        return out[filled], max(1, agree - weak, shared - empty), empty


def _class_of(column: pa.Array, n: int) -> list[pa.Array]:
    size, d1, d2 = [], [], []
    for found in sets_of(column, n):
        a, b = digests(found)
        size.append(len(found)), d1.append(a), d2.append(b)
    return [pa.array(x, pa.int64()) for x in (size, d1, d2)]


_CLASS = ("_n", "_d1", "_d2")
_CLASS_FIELDS = [T.StructField(c, T.LongType()) for c in _CLASS]


def _signed(ids: DataFrame, n: int, threshold: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer, seen = Signatures(threshold), set()
        for batch in batches:
            sigs, owners, needs = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for found in sets_of(batch.column("text"), n):
                if len(found) and (key := digests(found)) not in seen:  # a task's equal sets sign once
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen.add(key)
                    own, need, unsigned = signer.of(found)
                    sigs.append(own)
                    owners.append(np.full(len(own), key[0]))
                    needs.append(np.full(len(own), len(found) << 24 | min(need, NEED) << 6 | unsigned))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sigs).view(np.int64)), pa.array(np.concatenate(owners)), pa.array(np.concatenate(needs))], names=["sig", "d1", "code"])

    return ids.select("text").mapInArrow(run, "sig long, d1 long, code long")


#: A class's code holds its size, how many signatures it shares with any linked set (up to NEED), and its unsigned subsets (6 bits).
NEED = (1 << 18) - 1


def _need(code: Column) -> Column:
    return F.shiftright(code, 6).bitwiseAND(F.lit(NEED))


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by sig and d1: the distinct ones whose sig has two classes at least. Only the last row and whether its
    signature is known to be shared are held over, so a signature of any size streams through."""
    held: tuple[np.ndarray, ...] | None = None  # the last row, not yet given out
    known = False
    for batch in batches:
        sig, d1, code = (batch.column(k).to_numpy() for k in range(3))
        if held is not None:
            sig, d1, code = (np.concatenate(x) for x in zip(held, (sig, d1, code), strict=True))
        if not len(sig):
            continue
        new = np.ones(len(sig), bool)
        new[1:] = (sig[1:] != sig[:-1]) | (d1[1:] != d1[:-1])
        sig, d1, code = sig[new], d1[new], code[new]
        shared = np.zeros(len(sig), bool)
        same = sig[1:] == sig[:-1]
        shared[1:] |= same
        shared[:-1] |= same
        if held is not None and known:
            shared |= sig == held[0][0]
        held, known = (sig[-1:], d1[-1:], code[-1:]), bool(shared[-1])
        yield pa.RecordBatch.from_arrays([pa.array(x[:-1][shared[:-1]]) for x in (sig, d1, code)], names=["sig", "d1", "code"])
    if held is not None and known:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], names=["sig", "d1", "code"])


def _able(rows: DataFrame) -> DataFrame:
    """rows of classes that share as many signatures as a link takes; then, of signatures that two classes still share."""
    enough = rows.groupBy("d1").agg(F.count("*").alias("n"), _need(F.first("code")).alias("need")).where("n >= need").select("d1")
    kept = rows.join(enough, "d1")
    common = kept.groupBy("sig").agg(F.count("*").alias("common")).where("common > 1")
    return kept.join(common, "sig").select("sig", "d1", "code", "common")


def _agreeing(pairs: DataFrame, rows: DataFrame, threshold: int) -> DataFrame:
    """The pairs (x, y, met) that share as many signatures as a link of their sizes takes. Signatures are a fraction of the features, so this is
    asked before sets are moved. Either set's need holds for the pair."""
    own = saved(rows.groupBy("d1").agg(F.collect_set("sig").alias("sigs"), F.first("code").alias("code")), "signatures-by-class")
    a, b = own.alias("a"), own.alias("b")
    joined = pairs.join(a, F.col("x") == F.col("a.d1")).join(b, F.col("y") == F.col("b.d1"))
    met = joined.select("x", "y", F.size(F.array_intersect("a.sigs", "b.sigs")).alias("met"), F.col("a.code").alias("a"), F.col("b.code").alias("b"))

    def enough(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signatures(threshold)
        for batch in batches:
            a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
            need = signer.shared(a >> 24, b >> 24, np.minimum(a & 63, b & 63))
            yield batch.select(["x", "y", "met"]).filter(pa.array(batch.column("met").to_numpy() >= need))

    return met.where(F.col("met") >= F.greatest(_need(F.col("a")), _need(F.col("b")))).mapInArrow(enough, "x long, y long, met int")


def _with_sets(ids: DataFrame, needed: DataFrame, n: int) -> DataFrame:
    """rep, d1, n, features for classes needed (rep, _n, _d1, _d2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, found in enumerate(sets_of(batch.column("text"), n)):
                want = tuple(batch.column(c)[i].as_py() for c in _CLASS)
                if (len(found), *digests(found)) == want:
                    rows.append((batch.column("rep")[i].as_py(), want[1], want[0], found.view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.list_(pa.int64()))], names=["rep", "d1", "n", "features"])

    # only texts that may be needed are moved
    sketch = ids.sparkSession.sparkContext.broadcast(key_sketch(needed.select(F.col("rep").alias("k"))))

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("_id").fill_null(NO_ID).to_numpy()
            yield batch.filter(pa.array(may_hold(sketch.value, own)))

    ids = ids.mapInArrow(wanted, ids.schema)
    return ids.join(needed, ids["_id"] == needed["rep"]).select("text", "rep", *_CLASS).mapInArrow(run, "rep long, d1 long, n long, features array<long>").dropDuplicates(["rep", "d1"])


def _linked(threshold: int) -> Column:
    both = F.size(F.array_intersect("a.features", "b.features"))
    return 100 * both >= threshold * (F.col("a.n") + F.col("b.n") - both)


def _verified(pairs: DataFrame, sets: DataFrame, left: str, right: str, threshold: int) -> DataFrame:
    a, b = sets.select("rep", "d1", "n", "features").alias("a"), sets.select("rep", "d1", "n", "features").alias("b")
    by = "rep" if left == "a" else "d1"
    joined = pairs.join(a, F.col(left) == F.col(f"a.{by}")).join(b, F.col(right) == F.col(f"b.{by}"))
    return joined.where((F.col("a.rep") != F.col("b.rep")) & _linked(threshold)).select(F.col("a.rep").alias("a"), F.col("b.rep").alias("b"))


def _labelled(sets: DataFrame, labels: DataFrame) -> DataFrame:
    """d1 and label of each class."""
    return sets.select("rep", "d1").join(labels.withColumnRenamed("v", "rep"), "rep", "left").select("d1", F.coalesce("label", "rep").alias("label"))


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch of sets (n, features) in runs of rows with about RANKED features."""
    ends, row = np.cumsum(batch.column("n").to_numpy()), 0
    while row < len(ends):
        last = max(row + 1, int(np.searchsorted(ends, (ends[row - 1] if row else 0) + RANKED, "right")))
        yield batch.slice(row, last - row)
        row = last


def _prefixes(own: DataFrame, counted: DataFrame, threshold: int) -> DataFrame:
    """Of own (rep, d1, label, n, features) the prefixes: a class's n - ceil(t n) + 1 rarest features with their places; linked classes share
    one. Any order that all classes keep to will do, so rarity is read from tables of bounded size, and features stay in
    their rows: a sketch for each power of two tells features of fewer classes apart, and the commonest have their counts."""
    n_all = counted.agg(F.coalesce(F.sum("df"), F.lit(0))).first()[0]
    sketches = [key_sketch(counted.where(F.col("df") >= 1 << k).select(F.col("t").alias("k"))) for k in range(1, TIERS + 1)]
    most = counted.where(F.col("df") >= max(1 << (TIERS + 1), n_all / COMMON)).toArrow()
    order = np.argsort(most.column("t").to_numpy())
    shared = own.sparkSession.sparkContext.broadcast((sketches, most.column("t").to_numpy()[order], most.column("df").to_numpy()[order]))
    columns = ("rep", "d1", "label", "n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketches, common, counts = shared.value
        for batch in (piece for whole in batches for piece in _pieces(whole)):
            t, n = batch.column("features").flatten().to_numpy(), batch.column("n").to_numpy()
            rank = np.zeros(len(t), np.int64)
            for sketch in sketches:
                rank += may_hold(sketch, t)
            if len(common):
                at = np.minimum(np.searchsorted(common, t), len(common) - 1)
                rank = np.where(common[at] == t, counts[at], rank)
            row = np.repeat(np.arange(len(n)), n)
            order = np.lexsort((t, rank, row))
            place = np.arange(len(t)) - np.repeat(np.cumsum(n) - n, n)
            taken = (place < (n + (-n * threshold) // 100 + 1)[row]) & (rank[order] > 0)  # rank 0: no other class has the feature
            row, place = pa.array(row[taken]), place[taken]
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(row) for c in columns), pa.array(place), pa.array(t[order][taken])], names=[*columns, "i", "t"])

    return own.select(*columns, "features").mapInArrow(run, "rep long, d1 long, label long, n long, i long, t long")


def _residual_pairs(rows: DataFrame, sets: DataFrame, labels: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b) of different components that may link, from signatures whose classes lie in more than one component."""
    named = _labelled(sets, labels)
    # the one pair of a signature with two classes has been compared; a pair that has none such shares as many others as a link takes
    placed = rows.where("common > 2").join(named, "d1")
    mixed = placed.groupBy("sig").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("sig")
    who = saved(placed.join(mixed, "sig").groupBy("d1").agg(F.count("*").alias("c"), _need(F.first("code")).alias("need"), F.first("label").alias("label")).where("c >= need").select("d1", "label"), "unsettled")
    own = sets.join(who, "d1").select("rep", "d1", "label", "n", "features")
    counted = saved(own.select(F.explode("features").alias("t")).groupBy("t").agg(F.count("*").alias("df")), "feature-counts")
    prefix = saved(_prefixes(own, counted, threshold), "prefixes")
    discard(counted)
    split = prefix.groupBy("t").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("t", "lo")
    a = saved(prefix.join(split, "t").where("label != lo"), "prefixes-split").alias("a")  # both sides of the next join can be split where it is skewed
    b = prefix.alias("b")
    # at the first feature in common, what is left of either set bounds the intersection
    near = (100 + threshold) * F.least(F.col("a.n") - F.col("a.i"), F.col("b.n") - F.col("b.i")) >= threshold * (F.col("a.n") + F.col("b.n"))
    other = (F.col("a.label") != F.col("b.label")) & ((F.col("b.label") == F.col("a.lo")) | (F.col("a.rep") < F.col("b.rep")))
    return a.join(b, (F.col("a.t") == F.col("b.t")) & near & other).select(F.col("a.rep").alias("a"), F.col("b.rep").alias("b")).distinct()


def class_components(ids: DataFrame, n: int = SHINGLE, threshold: int = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """For ids (_id, text): the rows as (_id, _n, _d1, _d2), and for each class its component. Only these two tables are left."""
    rows_of = map_column(ids, "text", _CLASS_FIELDS, lambda column: _class_of(column, n)).select("_id", *_CLASS)
    rows_of = saved(rows_of, "set-digests")
    return rows_of, alone(ids.sparkSession, "components", lambda: _named_classes(ids, rows_of, n, threshold))


def _named_classes(ids: DataFrame, rows_of: DataFrame, n: int, threshold: int) -> DataFrame:
    classes = saved(rows_of.where("_n > 0").groupBy(*_CLASS).agg(F.min("_id").alias("rep")), "classes")
    signed = _signed(ids, n, threshold)
    shared = saved(signed.repartition("sig").sortWithinPartitions("sig", "d1").mapInArrow(_shared, "sig long, d1 long, code long"), "signatures-shared")
    rows = saved(_able(shared), "signatures")
    discard(shared)
    fame = rows.groupBy("d1").agg(F.sum("common").alias("fame"))
    leaders = rows.join(fame, "d1").groupBy("sig").agg(F.max(F.struct("fame", "d1")).getField("d1").alias("lead"))
    pairs = rows.join(leaders, "sig").where("d1 != lead").select(F.col("d1").alias("x"), F.col("lead").alias("y")).distinct()
    needed = saved(classes.where("rep IS NOT NULL").join(rows.select(F.col("d1").alias("_d1")).distinct(), "_d1"), "needed")
    sets = saved(_with_sets(ids, needed, n), "sets")
    discard(needed)
    pairs = saved(_agreeing(pairs, rows, threshold), "pairs")
    # each class with the leader that it shares most with; then its other leaders, as far as that has left them apart
    best = pairs.groupBy("x").agg(F.max_by("y", F.struct("met", "y")).alias("y"))
    links = saved(_verified(best, sets, "x", "y", threshold), "verified")
    placed = saved(_labelled(sets, components(links)), "labels-by-class")
    apart = pairs.join(placed.select(F.col("d1").alias("x"), F.col("label").alias("lx")), "x").join(placed.select(F.col("d1").alias("y"), F.col("label").alias("ly")), "y").where("lx != ly")
    links = links.unionByName(saved(_verified(apart.select("x", "y"), sets, "x", "y", threshold), "verified"))
    discard(pairs)
    labels = components(links)
    more = saved(_verified(_residual_pairs(rows, sets, labels, threshold), sets, "a", "b", threshold), "verified")
    if not more.isEmpty():
        labels = components(links.unionByName(more))
    return classes.join(labels, classes["rep"] == labels["v"], "left").select(*_CLASS, F.coalesce("label", "rep").alias("component_id"))


def near_duplicate_groups(documents: DataFrame, n: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, n_shingles and component_id, the smallest doc_id that links reach, for each row of documents."""
    ids = documents.select(F.col("doc_id").cast("long").alias("_id"), "text")
    rows, named = class_components(ids, n, threshold)
    named = named.withColumnsRenamed({"_n": "_cn", "_d1": "_c1", "_d2": "_c2"})
    joined = rows.join(named, (F.col("_d1") == F.col("_c1")) & (F.col("_d2") == F.col("_c2")) & (F.col("_n") == F.col("_cn")), "left")
    return joined.select(F.col("_id").alias("doc_id"), F.col("_n").alias("n_shingles"), F.coalesce("component_id", "_id").alias("component_id"))


def keep_one_of_each_group(documents: DataFrame, n: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """The rows of documents, in their own columns, that have no words or the smallest id of their component; one of equal rows."""
    names = {c: free_name(documents, c) for c in ("_n", "_d1", "_d2", "_id", "_head", "_row")}
    ids = documents.select(F.col("doc_id").cast("long").alias("_id"), "text")
    rows, named = class_components(ids, n, threshold)
    key = [names[c] for c in ("_id", *_CLASS)]
    heads = saved(named.select(F.coalesce("component_id", F.lit(NO_ID)).alias(names["_id"]), *(F.col(c).alias(names[c]) for c in _CLASS), F.lit(True).alias(names["_head"])), "heads")
    # rows that may be no head, or stand more than once, are joined with the heads; the others stay where they are
    slim = rows.where("_n > 0").select(F.coalesce("_id", F.lit(NO_ID)).alias(names["_id"]), *(F.col(c).alias(names[c]) for c in _CLASS))
    doubtful = slim.groupBy(*key).agg(F.count("*").alias("_c")).join(heads, key, "left").where((F.col("_c") > 1) | F.col(names["_head"]).isNull())
    sketch = documents.sparkSession.sparkContext.broadcast(key_sketch(doubtful.select((F.col(names["_id"]).bitwiseXOR(F.col(names["_d1"]))).alias("k"))))
    discard(rows), discard(named)
    columns, id_type = documents.columns, "doc_id"
    made = T.StructType([*documents.schema.fields, *(T.StructField(names[c], T.LongType()) for c in ("_id", *_CLASS)), T.StructField(names["_head"], T.BooleanType())])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, d1, d2 = _class_of(batch.column("text"), n)
            own = batch.column(id_type).cast(pa.int64()).fill_null(NO_ID)
            maybe = may_hold(sketch.value, own.to_numpy() ^ d1.to_numpy()) & (size.to_numpy() > 0)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), own, size, d1, d2, pa.array(maybe)], names=made.names)

    marked = documents.mapInArrow(mark, made)
    settled = marked.where(~F.col(names["_head"]))
    first = Window.partitionBy(*key).orderBy(names["_n"])  # dealt and sorted as the join left it
    open_rows = marked.where(F.col(names["_head"])).drop(names["_head"]).join(heads, key)
    one = open_rows.withColumn(names["_row"], F.row_number().over(first)).where(F.col(names["_row"]) == 1)
    one = settled.select(*documents.columns).unionByName(one.select(*documents.columns))
    return one.select(*(F.col(f"`{c}`") for c in documents.columns))

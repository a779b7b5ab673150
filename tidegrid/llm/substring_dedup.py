"""Substring dedup by super-k-mer partitioning.

A window is ``window`` consecutive words of one document. A word goes if a window that covers it also starts
in a document with a smaller id. The minimiser of a window is the least hash of its ``MINIMISER`` -word grams,
so it depends on the window's words alone; consecutive windows with one minimiser form a super-k-mer.

1. Every document gives its distinct minimisers, once; those of two documents or more are kept (an aggregate with
   map-side sums). A window of two documents has such a minimiser, so nothing is lost here.
2. The super-k-mers of these travel as one packed string each to the bucket of their minimiser, equal ones once
   a batch. A minimiser of more than ``HOT`` documents has several buckets, told by a hash of the string. A bucket's strings
   come sorted, in Arrow batches. If a bucket has one distinct string, its smallest document owns the super-k-mer;
   else its windows are sorted and each window's smallest document owns it. The windows of hot minimisers, and of
   buckets that a batch cuts, meet again in a groupBy, so no bucket has to fit in memory or in one task.
3. A document keeps its candidate windows that it owns and loses the words of the others.

Equal windows are told by their words within a bucket, and by a 64-bit hash within one document or, for hot
buckets, a 128-bit one. Null, empty and short texts have no window and lose nothing; rows with equal ids lose nothing to
each other; a null id counts as the largest; an empty table gives no rows. Long texts are handled whole.
Columns other than those read pass through; those named like an output are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.llm._frames import saved, small_batches
from tidegrid.llm._words import Words, chunks, mix, sliding_min

WINDOW, MINIMISER = 50, 8
#: Documents of a minimiser for each of its buckets.
HOT = 1000
LAST = (1 << 63) - 1

OUTPUT = [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType()), T.StructField("kept_sha256", T.StringType())]


class Kmers:
    """Super-k-mers of a Words: text, first window, windows, minimiser."""

    def __init__(self, words: Words, window: int):
        self.words, self.window, m = words, window, min(MINIMISER, window)
        starts = words.windows(window)
        if not len(starts):
            self.doc = self.start = self.n = np.zeros(0, np.int64)
            self.minimiser = np.zeros(0, np.int64)
            return
        grams = words.window_hashes(np.arange(len(words.start) - m + 1), m)
        least = sliding_min(grams, window - m + 1)[starts]
        doc = words.doc[starts]
        new = np.ones(len(starts), bool)
        new[1:] = (least[1:] != least[:-1]) | (doc[1:] != doc[:-1])
        at = np.flatnonzero(new)
        self.doc, self.start, self.minimiser = doc[at], starts[at], least[at].view(np.int64)
        self.n = np.diff(np.append(at, len(starts)))

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the super-k-mers, and of the window at each word (at places without a window: of no use)."""
        words = self.words
        if not len(self.start):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        ends = self.start + self.n + self.window - 1
        whole = mix(words.range_hashes(self.start, ends)).view(np.int64)
        return whole, words.window_hashes(np.arange(len(words.start) - self.window + 1), self.window).view(np.int64)

    def named(self, mins: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """The super-k-mers whose minimiser is in their text's list, and its place in the flattened lists."""
        lengths = pc.list_value_length(mins).fill_null(0).to_numpy(zero_copy_only=False)
        flat = mins.flatten().to_numpy()
        if not len(flat) or not len(self.doc):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        values, at = np.unique(flat, return_inverse=True)
        listed = np.repeat(np.arange(len(mins)), lengths) * len(values) + at
        order = np.argsort(listed)
        near = np.minimum(np.searchsorted(values, self.minimiser), len(values) - 1)
        own = self.doc * len(values) + near
        place = order[np.minimum(np.searchsorted(listed[order], own), len(listed) - 1)]
        found = np.flatnonzero((values[near] == self.minimiser) & (listed[place] == own))
        return found, place[found]


def shared_minimisers(ids: DataFrame, window: int) -> DataFrame:
    """_id, mins and heats: for each document id the minimisers that it shares with another id, and the buckets of each."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, last, data, offsets in chunks(batch.column("text")):
                kmers = Kmers(Words(data, offsets), window)
                pairs = np.unique(np.stack([kmers.doc, kmers.minimiser]), axis=1)
                own = batch.column("_id").slice(row, last - row).take(pa.array(pairs[0]))
                yield pa.RecordBatch.from_arrays([own, pa.array(pairs[1])], names=["_id", "m"])

    found = saved(ids.mapInArrow(scan, "_id long, m long"), "minimisers-found")
    shared = found.groupBy("m").agg(F.min("_id").alias("a"), F.max("_id").alias("b"), F.ceil(F.count("*") / HOT).cast("int").alias("heat")).where("a < b").select("m", "heat")
    listed = found.join(shared, "m").groupBy("_id").agg(F.collect_set(F.struct("m", "heat")).alias("ms"))
    return listed.select("_id", F.col("ms.m").alias("mins"), F.col("ms.heat").alias("heats"))


def _pack(candidates: DataFrame, window: int) -> DataFrame:
    """m, salt (0 unless m is hot), packed and _id of the super-k-mers that may be shared. candidates: _id, text, mins, heats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least: dict[bytes, tuple[int, int, int]] = {}
            ids, mins, heats = batch.column("_id").to_numpy(), batch.column("mins"), batch.column("heats")
            for row, last, data, offsets in chunks(batch.column("text")):
                words = Words(data, offsets)
                kmers = Kmers(words, window)
                own, place = kmers.named(mins.slice(row, last - row))
                if not len(own):
                    continue
                text, at = words.joined(np.arange(len(words.start)))
                text = text.tobytes()
                first, end = kmers.start[own], kmers.start[own] + kmers.n[own] + window - 1
                heat = heats.slice(row, last - row).flatten().to_numpy()[place]
                salt = np.where(heat > 1, 1 + mix(words.range_hashes(first, end)) % heat.astype(np.uint64), 0).astype(np.int64)
                stop = at[end - 1] + words.end[end - 1] - words.start[end - 1]
                for a, b, m, x, i in zip(at[first].tolist(), stop.tolist(), kmers.minimiser[own].tolist(), salt.tolist(), ids[row + kmers.doc[own]].tolist(), strict=True):
                    packed = text[a:b]
                    if (had := least.get(packed)) is None or i < had[2]:
                        least[packed] = (m, x, i)
            m, salt, own = (pa.array([x[k] for x in least.values()], pa.int64()) for k in range(3))
            yield pa.RecordBatch.from_arrays([m, salt, pa.array(least, pa.binary()), own], names=["m", "salt", "packed", "_id"])

    return candidates.mapInArrow(run, "m long, salt long, packed binary, _id long")


def _alike(words: Words, starts: np.ndarray, bucket: np.ndarray, h1: np.ndarray, h2: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The windows sorted so that equal ones of a bucket stand together, and where each group begins."""
    order = np.lexsort((h2, h1, bucket))
    same = (bucket[order][1:] == bucket[order][:-1]) & (h1[order][1:] == h1[order][:-1]) & (h2[order][1:] == h2[order][:-1])
    numbers = words.numbers()
    a, b = starts[order][1:][same], starts[order][:-1][same]
    if all((numbers[a + k] == numbers[b + k]).all() for k in range(window)):
        return order, np.flatnonzero(np.concatenate([[True], ~same]))
    seen: dict[tuple[int, bytes], int] = {}  # unlike windows have one hash
    group = np.array([seen.setdefault((int(x), words.text(s, s + window)), len(seen)) for x, s in zip(bucket, starts, strict=True)], np.int64)
    order = np.argsort(group, kind="stable")
    return order, np.flatnonzero(np.concatenate([[True], group[order][1:] != group[order][:-1]]))


def owners(candidates: DataFrame, window: int) -> DataFrame:
    """_id and keys: hashes of the super-k-mers and windows whose smallest document it is. candidates: _id, text, mins, heats."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by bucket and packed string. key2 is null for keys that are settled here."""
        for batch in batches:
            if not batch.num_rows:
                continue
            m, salt, ids = (batch.column(c).to_numpy() for c in ("m", "salt", "_id"))
            packed = batch.column("packed")
            same = (m[1:] == m[:-1]) & pc.equal(packed.slice(1), packed.slice(0, len(packed) - 1)).to_numpy(zero_copy_only=False)
            head = np.flatnonzero(np.concatenate([[True], ~same]))
            ids, m, salt, packed = np.minimum.reduceat(ids, head), m[head], salt[head], packed.take(pa.array(head))
            bucket = np.cumsum(np.concatenate([[0], (m[1:] != m[:-1]) | (salt[1:] != salt[:-1])]))
            goes_on = (salt > 0) | (bucket == 0) | (bucket == bucket[-1])  # elsewhere too, or in another batch
            words = Words(np.frombuffer(packed.buffers()[2], np.uint8), np.frombuffer(packed.buffers()[1], np.int32)[: len(packed) + 1].astype(np.int64))
            alone = np.flatnonzero((np.bincount(bucket)[bucket] == 1) & ~goes_on)
            # owner keys of super-k-mers and windows share a set, so a super-k-mer's hash is mixed once more
            whole = mix(words.range_hashes(words.first[alone], words.first[alone + 1])).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids[alone]), pa.array(whole), pa.nulls(len(alone), pa.int64())], names=["_id", "key", "key2"])
            starts = words.windows(window)
            starts = starts[~np.isin(words.doc[starts], alone)]
            if not len(starts):
                continue
            row = words.doc[starts]
            h1, h2 = (words.window_hashes(starts, window, k) for k in (0, 1))
            order, head = _alike(words, starts, bucket[row], h1, h2, window)
            least, first = np.minimum.reduceat(ids[row][order], head), order[head]
            yield pa.RecordBatch.from_arrays([pa.array(least), pa.array(h1[first].view(np.int64)), pa.array(h2[first].view(np.int64), mask=~goes_on[row[first]])], names=["_id", "key", "key2"])

    packed = _pack(candidates, window)
    counted = saved(packed.repartition("m", "salt").sortWithinPartitions("m", "salt", "packed").mapInArrow(count, "_id long, key long, key2 long"), "windows-counted")
    # a settled key has one row; the windows of cut and hot buckets meet here, with map-side minima
    open_keys = counted.where("key2 IS NOT NULL").groupBy("key", "key2").agg(F.min("_id").alias("_id")).select("_id", "key")
    return counted.where("key2 IS NULL").select("_id", "key").unionAll(open_keys).groupBy("_id").agg(F.collect_list("key").alias("keys"))


def _string_array(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.string(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())])


def remove_repeats(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """documents with n_words, n_removed, kept_text (kept words joined by one space) and its kept_sha256."""
    small_batches(documents.sparkSession)
    kept = [c for c in documents.columns if c.lower() not in {f.name for f in OUTPUT}]
    own_id = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))
    ids = documents.select(own_id.alias("_id"), "text")
    mins = saved(shared_minimisers(ids, window), "minimisers")
    owned = owners(ids.join(mins, "_id"), window)
    own = "__tg_id"
    rows = documents.select(own_id.alias(own), *(F.col(f"`{c}`") for c in kept))
    to = lambda df, name: df.select(F.col("_id").alias(own), F.col(name).alias(f"__tg_{name}"))
    joined = rows.join(to(mins, "mins"), own, "left").join(to(owned, "keys"), own, "left")
    schema = T.StructType([*(documents.schema[c] for c in kept), *OUTPUT])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            none = [np.zeros(0, np.int64)]
            n_words, n_removed, texts, sha = list(none), list(none), [pa.array([], pa.string())], []
            mins, keys = batch.column("__tg_mins"), batch.column("__tg_keys")
            for row, last, data, offsets in chunks(batch.column("text")):
                words = Words(data, offsets)
                kmers = Kmers(words, window)
                found, _ = kmers.named(mins.slice(row, last - row))
                gone = np.zeros(len(words.start) + 1, np.int64)
                if len(found):
                    whole, hashes = kmers.keys()
                    edges = np.searchsorted(kmers.doc[found], np.arange(last - row + 1))
                    for d in np.flatnonzero(np.diff(edges)).tolist():
                        at = found[edges[d] : edges[d + 1]]
                        own = keys[row + d].values.to_numpy() if keys[row + d].is_valid else none[0]
                        at = at[~np.isin(whole[at], own)]
                        starts = np.repeat(kmers.start[at] - np.concatenate([[0], np.cumsum(kmers.n[at])[:-1]]), kmers.n[at]) + np.arange(kmers.n[at].sum()) if len(at) else at
                        starts = starts[~np.isin(hashes[starts], own)]
                        gone[starts] += 1
                        gone[starts + window] -= 1
                removed = np.cumsum(gone[:-1]) > 0
                sums = np.concatenate([[0], np.cumsum(removed)])
                n_words.append(words.n)
                n_removed.append(sums[words.first[1:]] - sums[words.first[:-1]])
                left = np.flatnonzero(~removed)
                text, at = words.joined(left)
                ends = at[np.searchsorted(left, words.first)]
                texts.append(_string_array(text, ends))
                text = text.tobytes()
                sha += [hashlib.sha256(text[a:b]).hexdigest() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(np.concatenate(n_words)), pa.array(np.concatenate(n_removed)), pa.concat_arrays(texts), pa.array(sha, pa.string())], names=schema.names)

    return joined.select(*(F.col(f"`{c}`") for c in kept), "__tg_mins", "__tg_keys").mapInArrow(cut, schema)

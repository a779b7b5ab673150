"""Benchmark decontamination: a broadcast hash set of normalised test n-grams.

Texts are lower-cased (A-Z) and split into words of letters, digits and non-ASCII characters. An item's
n-grams are its windows of ``n`` words; an item with fewer words, but some, is one window. Each task scans
the word windows of its documents against the hash set and compares the words of every hit, so a hash
collision cannot mark a document.

The set is broadcast only while its n-grams and the item ids that each lists take ``max_broadcast`` bytes at most. Its
hashes are taken once, by the driver, and a task only looks them up. Beyond that size the windows that may be n-grams (by a
sketch of fixed size) are joined with the n-grams on their hash by a shuffle, and only the documents' own matches come
back; an n-gram that very many documents hold is a skewed join key, which adaptive execution splits.

Null, empty and wordless texts have no words and no hits; items without words have no n-grams; the words of items without
id are hit like others', but name no item; repeated rows are each judged alike; an empty benchmark leaves every document
clean. Long texts are scanned whole. Columns other than ``doc_id`` and ``text`` pass through; those named like an output
column are replaced.
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

from tidegrid.llm._frames import aside, free_name, key_sketch, map_column, may_hold, saved, small_batches
from tidegrid.llm._words import ALNUM, Words, chunks, covered

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
N = 10
#: Bytes of n-grams and item ids that may be broadcast.
MAX_BROADCAST = 64 << 20

OUTPUT = [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("n_items", T.LongType()), T.StructField("items_sha256", T.StringType()), T.StructField("contaminated", T.BooleanType())]
SPANS = T.StructField("hit_spans", T.ArrayType(T.StructType([T.StructField("first", T.IntegerType()), T.StructField("last", T.IntegerType())])))


def benchmark_grams(benchmark: DataFrame, n: int = N) -> DataFrame:
    """gram (words joined by a space), k (its words) and items (the sorted ids, as strings, of the items that have it)."""
    words = F.regexp_extract_all(F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(WORD), F.lit(0))
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), words.alias("w")).where(F.size("w") > 0)
    k = F.least(F.size("w"), F.lit(n))
    grams = items.select("item", k.alias("k"), F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - k + 1), lambda i: F.array_join(F.slice("w", i, k), " "))).alias("gram"))
    return grams.groupBy("gram", "k").agg(F.array_sort(F.collect_set("item")).alias("items"))  # a null id is in no set


def _gram_hashes(grams: pa.Array) -> np.ndarray:
    """The hash of each n-gram, as that of an equal window of a text."""
    out = [np.zeros(0, np.uint64)]
    for _, _, data, offsets in chunks(grams):
        words = Words(data, offsets, ALNUM, fold=True)
        out.append(words.range_hashes(words.first[:-1], words.first[1:]))
    return np.concatenate(out)


class _Grams:
    """A hash set of n-grams by their length, as arrays; look-ups give verified hits only."""

    def __init__(self, table: pa.Table):
        """table: gram, k and items; the same n-gram may stand in several rows."""
        hashes, k = _gram_hashes(table.column("gram").combine_chunks()), table.column("k").to_numpy()
        order = np.lexsort((hashes, k))
        self.sizes, first = np.unique(k[order], return_index=True)
        edges = np.append(first, len(order))
        self.known = {int(n): hashes[order][a:b] for n, a, b in zip(self.sizes, edges[:-1], edges[1:], strict=True)}
        self.base = {int(n): int(a) for n, a in zip(self.sizes, first, strict=True)}
        table = table.take(pa.array(order)).combine_chunks()
        self.grams, self.items = (table.column(c).chunk(0) if table.num_rows else [] for c in ("gram", "items"))

    def find(self, words: Words) -> Iterator[tuple[int, int, int]]:
        """(word, length, n-gram) of each hit."""
        for k, known in self.known.items():
            starts = words.windows(k)
            if not len(starts):
                continue
            h = words.window_hashes(starts, k)
            at = np.minimum(np.searchsorted(known, h), len(known) - 1)
            for i in np.flatnonzero(known[at] == h).tolist():
                own, g = words.text(starts[i], starts[i] + k).lower().decode(), int(at[i])  # bytes.lower() folds A-Z only
                while g < len(known) and known[g] == h[i]:
                    if self.grams[self.base[k] + g].as_py() == own:
                        yield int(starts[i]), k, self.base[k] + g
                        break
                    g += 1


def _sha(items: set[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


_NO_ITEMS = _sha(set())


def _judged(column: pa.Array, grams: _Grams) -> list[pa.Array]:
    n_words, n_hit, n_items, sha, spans = [], [], [], [], []
    for _, _, data, offsets in chunks(column):
        words = Words(data, offsets, ALNUM, fold=True)
        found = list(grams.find(words))
        hit = covered(np.array([s for s, _, _ in found], np.int64), np.array([k for _, k, _ in found], np.int64), len(words.start))
        lists = {g: grams.items[g].as_py() for g in {g for _, _, g in found}}
        items: dict[int, set[str]] = {}
        for d, g in {(int(words.doc[s]), g) for s, _, g in found}:
            items.setdefault(d, set()).update(lists[g])
        n_words.append(words.n)
        sums = np.concatenate([[0], np.cumsum(hit)])
        n_hit.append(sums[words.first[1:]] - sums[words.first[:-1]])
        for i in range(len(words.n)):
            own = items.get(i)
            n_items.append(len(own) if own else 0)
            sha.append(_sha(own) if own else _NO_ITEMS)
            spans.append(_runs(hit[words.first[i] : words.first[i + 1]]) if own is not None else [])
    hits = np.concatenate(n_hit) if n_hit else np.zeros(0, np.int64)
    return [pa.array(np.concatenate(n_words) if n_words else hits, pa.int64()), pa.array(hits, pa.int64()), pa.array(n_items, pa.int64()), pa.array(sha, pa.string()), pa.array(hits > 0, pa.bool_()), pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())])))]


def _runs(hit: np.ndarray) -> list[dict[str, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return [{"first": int(a), "last": int(b) - 1} for a, b in zip(edges[::2], edges[1::2], strict=True)]


def find_contamination(documents: DataFrame, benchmark: DataFrame, n: int = N, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """documents with n_words, n_hit, n_items, items_sha256, contaminated and hit_spans (word ranges, last included)."""
    grams = benchmark_grams(benchmark, n)
    # the sum is taken over a table of its own, so that a large benchmark is never collected
    size = grams.agg(F.coalesce(F.sum(F.octet_length("gram") + 24 + F.octet_length(F.array_join("items", "")) + 4 * F.size("items")), F.lit(0))).first()[0]
    if size > max_broadcast:
        return _by_shuffle(documents, grams)
    shared = documents.sparkSession.sparkContext.broadcast(_Grams(grams.toArrow()))
    return map_column(documents, "text", [*OUTPUT, SPANS], lambda column: _judged(column, shared.value))


def _by_shuffle(documents: DataFrame, grams: DataFrame) -> DataFrame:
    """The same for any number of n-grams: windows meet n-grams in a join on their hash.

    A digest of each text stands for it meanwhile, so repeated ids do not mix and equal texts are looked up once. Within
    a text equal windows go once, so a passage repeated within it adds no rows.
    """
    small_batches(documents.sparkSession)
    key = free_name(documents, "row_sha")
    keyed = documents.withColumn(key, F.sha2(F.coalesce("text", F.lit("")), 256))

    def gram_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_gram_hashes(batch.column("gram")).view(np.int64)), *(batch.column(c) for c in ("gram", "k", "items"))], names=["hash", "gram", "k", "items"])

    table = grams.select("gram", F.col("k").cast("int").alias("k"), "items").mapInArrow(gram_hashes, "hash long, gram string, k int, items array<string>")
    table = saved(table, "benchmark-grams")
    sizes = sorted(r["k"] for r in table.select("k").distinct().collect())  # no more than n
    sketch = documents.sparkSession.sparkContext.broadcast(key_sketch(table.select(F.col("hash").alias("k"))))

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, _, data, offsets in chunks(batch.column(1)):
                words = Words(data, offsets, ALNUM, fold=True)
                for k in sizes:
                    starts = words.windows(k)
                    if not len(starts):
                        continue
                    h = words.window_hashes(starts, k).view(np.int64)
                    maybe = may_hold(sketch.value, h)
                    own = np.unique(np.stack([words.doc[starts[maybe]], h[maybe]]), axis=1)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(own[0] + row)), pa.array(own[1]), pa.array(np.full(own.shape[1], k, np.int32))], names=["key", "hash", "k"])

    windows = keyed.select(key, "text").mapInArrow(hashes, "key string, hash long, k int").distinct()
    met = windows.join(table, ["hash", "k"]).groupBy("key").agg(F.collect_list(F.struct("gram", "k", "items")).alias("met"))
    names = [c for c in documents.columns if c.lower() not in {f.name for f in [*OUTPUT, SPANS]}]
    schema = T.StructType([*(documents.schema[c] for c in names), *OUTPUT, SPANS])
    other = free_name(documents, "met")
    joined = keyed.join(met.select(F.col("key").alias(key), F.col("met").alias(other)), key, "left").select(*(F.col(f"`{c}`") for c in dict.fromkeys([*names, "text"])), other)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:  # an n-gram that one text of the batch holds is one for all of them
            rows = batch.column(other).flatten()
            columns = {c: pc.struct_field(rows, c) for c in ("gram", "k", "items")} if len(rows) else {"gram": pa.array([], pa.string()), "k": pa.array([], pa.int32()), "items": pa.array([], pa.list_(pa.string()))}
            made = _judged(batch.column("text"), _Grams(pa.table(columns)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *made], names=schema.names)

    return joined.mapInArrow(judge, schema)


def remove_contamination(documents: DataFrame, benchmark: DataFrame, n: int = N, drop_share: float = 0.5, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """documents without benchmark passages, in their own columns.

    A document of whose words at least ``drop_share`` are hit goes whole. From the others the hit spans go, with
    the text from a span's first word up to the word after it; ``n_chars``, where it is a column, follows.
    """
    moved, own = aside(documents, [f.name for f in [*OUTPUT, SPANS]])
    judged = find_contamination(moved, benchmark, n, max_broadcast)
    names = moved.columns

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, spans = batch.column("text"), batch.column("hit_spans")
            hit = pc.greater(pc.list_value_length(spans), 0).fill_null(False)
            new = [_without(t.as_py(), own.as_py()) for t, own in zip(text.filter(hit), spans.filter(hit), strict=True)]
            columns = dict(zip(batch.schema.names, batch.columns, strict=True)) | {"text": pc.replace_with_mask(text, hit, pa.array(new, text.type))}
            yield pa.RecordBatch.from_arrays([columns[c] for c in names], names=names)

    keep = ~F.col("contaminated") | (F.col("n_hit") < drop_share * F.col("n_words"))
    out = judged.where(keep).select(*names, "hit_spans").mapInArrow(fn, moved.schema).select(*own)
    return out.withColumn("n_chars", F.length("text").cast(documents.schema["n_chars"].dataType)) if "n_chars" in documents.columns else out


def _without(text: str, spans: list[dict[str, int]]) -> str:
    data = np.frombuffer(text.encode(), np.uint8)
    words = Words(data, np.array([0, len(data)]), ALNUM, fold=True)
    out, at = [], 0
    for s in spans:
        out.append(data[at : words.start[s["first"]]].tobytes())
        at = words.start[s["last"] + 1] if s["last"] + 1 < len(words.start) else len(data)
    out.append(data[at:].tobytes())
    return b"".join(out).decode()

"""Language identification by rank-order profiles.

Letters are lower-cased; other characters are word boundaries. A profile ranks the ``PROFILE`` most frequent
1-, 2- and 3-grams of a language, boundaries included; a document ranks its own ``TOP``. The distance is the sum over the
document's n-grams of how far out of place each is in the profile, ``PROFILE`` for one that it lacks; the language with the
least distance is predicted. The score is 1 minus the distance to it over the mean distance to the others, cut to 0..1.

Profiles are fitted on about ``per_language`` documents of each language, chosen by a hash of their id: a
documented bound. Their n-grams are summed by Spark, and only the profiles reach the driver: PROFILE rows for a language.

A null text and one without letters are ``und`` with score 0; ties go to the language that sorts first; repeated rows are alike;
without a language to learn from, all are ``und``. Long texts are read whole. Other columns pass through; those named
like an output are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.llm._frames import aside, map_column, small_batches
from tidegrid.llm._words import chunks

PROFILE, TOP = 400, 300
PER_LANGUAGE = 5000
#: N-grams that a task holds before it sums them.
AT_ONCE = 1_000_000
#: A document farther than this share of the greatest distance from every language is rejected by the pipeline's filter.
REJECT = 0.95
OUTPUT = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("distance", T.DoubleType())]

#: A word boundary within an n-gram: no code point, and not 0, so that n-grams of different lengths differ.
EDGE = np.uint64(0x1FFFFF)
_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """For each code point its lower-case letter, 0 for what is no letter."""
    if not _LETTERS:
        table = np.zeros(0x110000, np.uint32)
        for c in range(0x110000):
            x = chr(c)
            if x.isalpha():
                low = x.lower()
                table[c] = ord(low) if len(low) == 1 else c
        _LETTERS.append(table)
    return _LETTERS[0]


def grams_of(column: pa.Array) -> Iterator[np.ndarray]:
    """For each text its n-grams as integers, 21 bits a character."""
    table = _letters()
    for row, last, data, offsets in chunks(column):
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        at = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
        codes = table[points].astype(np.uint64)
        for d in range(last - row):
            own = codes[at[d] : at[d + 1]]
            own = np.concatenate([[0], own, [0]]).astype(np.uint64)
            own = own[np.concatenate([[True], (own[1:] != 0) | (own[:-1] != 0)])]
            if len(own) < 3:
                yield np.zeros(0, np.uint64)
                continue
            letter = own != 0
            own = np.where(letter, own, EDGE)
            two = (own[:-1] << np.uint64(21)) | own[1:]
            three = (two[:-1] << np.uint64(21)) | own[2:]
            yield np.concatenate([own[letter], two, three[letter[1:-1]]])


def ranked(grams: np.ndarray, top: int) -> np.ndarray:
    """The most frequent n-grams, by count, then by value."""
    values, counts = np.unique(grams, return_counts=True)
    return values[np.argsort(-counts, kind="stable")[:top]]


class Profiles:
    def __init__(self, ranks: dict[str, list[int]]):
        self.names = sorted(ranks)
        self.grams = np.unique(np.array([g for r in ranks.values() for g in r], np.uint64))
        self.ranks = np.full((len(self.names), len(self.grams) + 1), PROFILE, np.int64)
        self.has = np.zeros(self.ranks.shape, bool)
        for k, name in enumerate(self.names):
            at = np.searchsorted(self.grams, np.array(ranks[name], np.uint64))
            self.ranks[k, at] = np.arange(len(at))
            self.has[k, at] = True

    def distances(self, own: np.ndarray) -> np.ndarray:
        """Of each language, as a share of the greatest possible."""
        at = np.searchsorted(self.grams, own)
        at[(at == len(self.grams)) | (self.grams[np.minimum(at, len(self.grams) - 1)] != own)] = len(self.grams)
        off = np.where(self.has[:, at], np.abs(self.ranks[:, at] - np.arange(len(own))), PROFILE)
        return off.sum(1) / (PROFILE * len(own))


def learn_profiles(documents: DataFrame, per_language: int = PER_LANGUAGE) -> Profiles:
    """From doc_id, text and lang, as many rows as per_language allows; rows without lang teach nothing."""
    small_batches(documents.sparkSession)
    known = documents.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    rate = known.groupBy("lang").agg(F.least(F.lit(1.0), F.lit(float(per_language)) / F.count("*")).alias("_rate"))
    drawn = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 20)) < F.col("_rate") * (1 << 20)
    sample = known.join(F.broadcast(rate), "lang").where(drawn).select("lang", "text")

    def summed(held: dict[str, list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for lang, parts in held.items():
            values, counts = np.unique(np.concatenate(parts), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(values), pa.string()), pa.array(values.view(np.int64)), pa.array(counts)], names=["lang", "gram", "n"])
        held.clear()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[str, list[np.ndarray]] = {}
            size = 0
            for lang, own in zip(batch.column("lang").to_pylist(), grams_of(batch.column("text")), strict=True):
                held.setdefault(lang, []).append(own)
                size += len(own)
                if size > AT_ONCE:
                    yield from summed(held)
                    size = 0
            yield from summed(held)

    counted = sample.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    rows = counted.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= PROFILE).select("lang", "gram", "rank").collect()
    ranks: dict[str, list[int]] = {}
    for r in sorted(rows, key=lambda r: r["rank"]):
        ranks.setdefault(r["lang"], []).append(r["gram"])
    return Profiles(ranks)


def predict_language(documents: DataFrame, profiles: Profiles) -> DataFrame:
    """documents with lang_pred, score and distance (of the prediction, as a share of the greatest; null for und)."""

    def fn(column: pa.Array) -> list[pa.Array]:
        names, scores, least = [], [], []
        for grams in grams_of(column):
            if not len(grams) or not profiles.names:
                names.append("und"), scores.append(0.0), least.append(None)
                continue
            d = profiles.distances(ranked(grams, TOP))
            k = int(np.argmin(d))
            rest = (d.sum() - d[k]) / (len(d) - 1) if len(d) > 1 else 1.0
            names.append(profiles.names[k]), scores.append(float(min(1.0, max(0.0, 1 - d[k] / rest))) if rest else 0.0), least.append(float(d[k]))
        return [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(least, pa.float64())]

    return map_column(documents, "text", OUTPUT, fn)


def held_out(column: str, folds: int, fold: int) -> Column:
    return F.coalesce(F.crc32(F.col(column).cast("string")) % folds == fold, F.lit(False))


def keep_known_languages(documents: DataFrame, reject: float = REJECT, per_language: int = PER_LANGUAGE) -> DataFrame:
    """documents, in their own columns, without those that have no letter or are near to no language learnt from them."""
    moved, own = aside(documents, [f.name for f in OUTPUT])
    found = predict_language(moved, learn_profiles(documents, per_language))
    return found.where((F.col("lang_pred") != "und") & (F.col("distance") <= reject)).select(*own)

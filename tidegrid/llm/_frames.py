"""Helpers that several operators share."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.llm._words import mix
from tidegrid.sources.scratch import alone, discard, folder, saved

__all__ = ["alone", "aside", "discard", "folder", "free_name", "key_sketch", "map_column", "may_hold", "saved", "small_batches"]


#: Rows and bytes of an Arrow batch: whole texts are in it, in the JVM and in Python, several times over.
BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20


def small_batches(spark: SparkSession) -> None:
    """Keeps the session's Arrow batches of texts within an executor's memory, whatever the texts' lengths; smaller settings
    stand. Plans read the settings when they run, after the operator has returned, so they are the session's."""
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{name}"
        have = re.match(r"-?[0-9]+", spark.conf.get(name) or "")
        if have is None or not 0 < int(have[0]) <= most:
            spark.conf.set(name, str(most))


def free_name(df: DataFrame, name: str) -> str:
    """name, with underscores before it until no column of df has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def aside(df: DataFrame, names: list[str]) -> tuple[DataFrame, list[Column]]:
    """df with columns of these names renamed out of an operator's way, and the columns that give df's own back."""
    taken = {n.lower() for n in names}
    moved = {c: f"__tg_in_{c}" for c in df.columns if c.lower() in taken}
    return df.withColumnsRenamed(moved), [F.col(f"`{moved.get(c, c)}`").alias(c) for c in df.columns]


def map_column(df: DataFrame, column: str, new: list[T.StructField], fn: Callable[[pa.Array], list[pa.Array]]) -> DataFrame:
    """df with the columns that fn makes from one column, batch by batch; the other columns pass through unread.

    A new column takes the place of one with its name.
    """
    small_batches(df.sparkSession)
    names = {f.name.lower() for f in new}
    kept = [c for c in df.columns if c.lower() not in names or c == column]
    made = {f.name: f for f in new}
    schema = T.StructType([*(made.get(c, df.schema[c]) for c in kept), *(f for f in new if f.name not in kept)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arrays = dict(zip(batch.schema.names, batch.columns, strict=True))
            arrays |= dict(zip((f.name for f in new), fn(arrays[column]), strict=True))
            yield pa.RecordBatch.from_arrays([arrays[f.name] for f in schema.fields], names=[f.name for f in schema.fields])

    return df.select(*(F.col(f"`{c}`") for c in dict.fromkeys([*kept, column]))).mapInArrow(run, schema)


#: Bits of a key sketch: 8 MB, however many keys there are. A full sketch lets every row pass, and costs no row.
SKETCH_BITS = 26


def _places(keys: np.ndarray) -> Iterator[np.ndarray]:
    for salt in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
        yield mix(keys.view(np.uint64) ^ np.uint64(salt)) >> np.uint64(64 - SKETCH_BITS)


def key_sketch(keys: DataFrame) -> np.ndarray:
    """A bitmap of the keys, a long column k. Tasks set bits, Spark joins them, and 2^20 words at the most are collected."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = np.concatenate(list(_places(batch.column(0).to_numpy())))
            words, where = np.unique(places >> np.uint64(6), return_inverse=True)
            bits = np.zeros(len(words), np.uint64)
            np.bitwise_or.at(bits, where, np.uint64(1) << (places & np.uint64(63)))
            yield pa.RecordBatch.from_arrays([pa.array(words.astype(np.int64)), pa.array(bits.view(np.int64))], names=["word", "bits"])

    found = keys.mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (SKETCH_BITS - 6), np.uint64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def may_hold(sketch: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """False only for keys that the sketch was not made of."""
    out = np.ones(len(keys), bool)
    for p in _places(keys):
        out &= (sketch[p >> np.uint64(6)] >> (p & np.uint64(63))) & np.uint64(1) == 1
    return out

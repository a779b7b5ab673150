"""Token counts through a digest cache.

A text's key is the SHA-256 of its normalised content (null is empty; nothing else is changed, as the count is
that of the text as it stands) with the SHA-256 of the tokenizer file. Known keys are joined to stored
counts; of the others, distinct ones only are encoded, and their counts are appended to the cache. One row for each key stands
for its text, so texts are moved once, by (doc_id, key), which no hot text makes uneven. Counts come back to the rows
in a join on the key; keys of so many rows that there can be ``HOT_KEYS`` of them at the most are broadcast instead.

Encoding: a tokenizer that splits texts by the byte-level pattern never merges across a change between letters, signs
and white space, so the count of a text is the sum over its pieces. Pieces are cut where the pattern is sure to cut,
between ASCII characters and Latin-1 letters only; a worker remembers the counts of up to ``REMEMBERED`` pieces. A
text that holds one of the tokenizer's added strings, and every text of another kind of tokenizer, is encoded as a whole.

The cache is a Parquet folder, one partition for each tokenizer version; its rows are a key's digest and
counts, so it may be shared by runs. A repeated append does no harm: keys are made distinct when read.

Special strings in texts count as the library's default has it: for .json, as the special token. Null and empty texts
have no tokens; rows without id count like others; repeated rows share a key; an empty table gives no rows. Long texts
are encoded whole. Columns other than ``text`` pass through; those named like an output are replaced.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.llm._frames import folder as new_folder
from tidegrid.llm._frames import saved, small_batches
from tidegrid.llm._words import chunks, equal_spans, span_hashes

LIMIT = 1024
STORED = T.StructType([T.StructField("digest", T.BinaryType()), T.StructField("n_tokens", T.LongType())])
OUTPUT = ("n_bytes", "n_tokens", "over_limit")


#: Bytes of text that are cut into pieces, or handed to the library, at once.
AT_ONCE = 1 << 20
#: Pieces whose counts a worker remembers: some 120 MB.
REMEMBERED = 1_000_000
#: Keys that may be broadcast with their counts: those of at least that fraction of the rows, so there are no more.
HOT_KEYS = 20_000
#: Rows below which a key is never hot.
HOT_ROWS = 100

#: Kinds of bytes: a letter or digit, a sign, an apostrophe (which may begin a contraction), a space, other ASCII white
#: space, and bytes of which nothing is said.
_LETTER, _SIGN, _QUOTE, _SPACE, _BLANK, _OTHER = range(6)
_KIND = np.full(256, _OTHER, np.int8)
_KIND[33:127] = _SIGN
_KIND[48:58] = _KIND[65:91] = _KIND[97:123] = _LETTER
_KIND[39], _KIND[32], _KIND[9:14] = _QUOTE, _SPACE, _BLANK
#: [kind before, kind after] between which the byte-level pattern always cuts.
_CUT = np.zeros((6, 6), bool)
for _before, _after in ((_LETTER, (_SIGN, _QUOTE, _SPACE, _BLANK)), (_SIGN, (_LETTER, _SPACE, _BLANK)), (_QUOTE, (_SPACE, _BLANK)), (_BLANK, (_LETTER, _SIGN, _QUOTE))):
    _CUT[_before, _after] = True


def piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The places at which texts (UTF-8 bytes, see ``chunks``) are cut into pieces that are encoded apart."""
    kind = _KIND[data]
    latin = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7))  # letters of two bytes, but for the signs of times and division
    kind[latin] = kind[latin + 1] = _LETTER
    cut = _CUT[kind[:-1], kind[1:]]
    cut[1:] &= (kind[1:-1] != _BLANK) | _CUT[kind[:-2], kind[1:-1]]  # the last of several blanks is apart from those before it
    cut[:1] &= kind[:1] != _BLANK
    cut = np.concatenate([[True], cut])[: len(data)]
    cut[offsets[:-1][offsets[:-1] < len(data)]] = True
    return np.flatnonzero(cut)


class Encoder:
    """Counts of tokens as the library gives them, for the content of a tokenizer file."""

    def __init__(self, content: bytes, kind: str):
        self.memo: dict[bytes, int] = {}
        self.added: list[bytes] = []
        if kind == ".model":
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_proto=content)
            self.by_pieces = False
            self.whole: Callable[[list[str]], list[int]] = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
            return
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(content.decode())
        tokenizer.no_truncation()
        tokenizer.no_padding()
        self.whole = lambda texts: [len(x) for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        stated = json.loads(content)
        split, model = stated.get("pre_tokenizer") or {}, stated["model"]
        self.by_pieces = (split.get("type"), split.get("use_regex"), split.get("add_prefix_space"), stated.get("normalizer"), model.get("type"), model.get("dropout")) == ("ByteLevel", True, False, None, "BPE", None)
        self.added = [t["content"].encode() for t in stated.get("added_tokens") or []]

    def counts(self, column: pa.Array) -> np.ndarray:
        """The tokens of each text."""
        column = column.fill_null("")
        out = [np.zeros(0, np.int64)]
        for row, last, data, offsets in chunks(column, AT_ONCE):
            if self.by_pieces:
                out.append(self._summed(data, offsets))
            else:
                out.append(np.array(self.whole(column[row:last].to_pylist()), np.int64))
        return np.concatenate(out)

    def _summed(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        content = data.tobytes()
        starts = piece_starts(data, offsets)
        ends = np.append(starts[1:], len(data))
        first = np.searchsorted(starts, offsets)
        _, pick, own = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        lengths = ends - starts
        if (lengths != lengths[pick][own]).any() or not equal_spans(data, starts, starts[pick][own], lengths):
            pick = own = np.arange(len(starts))  # unlike pieces of one hash
        pieces = [content[a:b] for a, b in zip(starts[pick].tolist(), ends[pick].tolist(), strict=True)]
        sizes = list(map(self.memo.get, pieces))
        new = [i for i, n in enumerate(sizes) if n is None]
        if len(self.memo) + len(new) > REMEMBERED:
            self.memo.clear()
        for i, n in zip(new, self.whole([pieces[i].decode() for i in new]) if new else (), strict=True):
            sizes[i] = self.memo[pieces[i]] = n
        sizes = np.array(sizes, np.int64)
        sums = np.concatenate([[0], np.cumsum(sizes[own])]) if len(starts) else np.zeros(1, np.int64)
        out = sums[first[1:]] - sums[first[:-1]]
        if any(a in content for a in self.added):
            texts = [content[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            special = [i for i, t in enumerate(texts) if any(a in t for a in self.added)]
            out[special] = self.whole([texts[i].decode() for i in special]) if special else []
        return out


#: The encoders of a Python worker, by tokenizer version: later tasks find the pieces that earlier ones met.
_ENCODERS: dict[str, Encoder] = {}


def _encoder(version: str, content: bytes, kind: str) -> Encoder:
    if version not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[version] = Encoder(content, kind)
    return _ENCODERS[version]


def _stored(documents: DataFrame, folder: str) -> DataFrame:
    spark = documents.sparkSession
    try:
        return spark.read.schema(STORED).parquet(folder).dropDuplicates(["digest"])
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing.getCondition()):
            raise
        return spark.createDataFrame([], STORED)


def count_tokens(documents: DataFrame, tokenizer: str, cache: str | None = None, limit: int = LIMIT) -> DataFrame:
    """documents with n_bytes, n_tokens and over_limit. tokenizer: a path that the driver reads; its content is
    broadcast, as a vocabulary is a few MB whatever the corpus. cache: a shared folder; None makes a new one."""
    spark = documents.sparkSession
    small_batches(spark)
    content, kind = Path(tokenizer).read_bytes(), Path(tokenizer).suffix
    version = hashlib.sha256(content).hexdigest()
    folder = f"{cache or new_folder(spark, 'token-cache')}/version={version}"
    shared = spark.sparkContext.broadcast(content)
    digest = F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))

    rows = documents.select(F.col("doc_id").cast("long").alias("_id"), digest.alias("__tg_digest"))
    wanted = saved(rows.groupBy("__tg_digest").agg(F.min("_id").alias("_rep"), F.count("*").alias("_n")), "token-keys")
    missed = wanted.join(_stored(documents, folder).select(F.col("digest").alias("__tg_digest")), "__tg_digest", "left_anti")
    texts = documents.select(F.col("doc_id").cast("long").alias("_id"), F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.join(missed, F.col("_id").eqNullSafe(F.col("_rep")) & (F.unhex(F.sha2("text", 256)) == F.col("__tg_digest")))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(version, shared.value, kind)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("__tg_digest"), pa.array(encoder.counts(batch.column("text")))], names=["digest", "n_tokens"])

    texts.select("__tg_digest", "text").mapInArrow(encode, STORED).write.mode("append").parquet(folder)
    counts = _stored(documents, folder).withColumnRenamed("digest", "__tg_digest")
    n_rows = wanted.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    hot = counts.join(wanted.where(F.col("_n") >= max(HOT_ROWS, n_rows / HOT_KEYS)), "__tg_digest").select(F.col("__tg_digest").alias("__tg_hot"), F.col("n_tokens").alias("__tg_n"))
    kept = [c for c in documents.columns if c.lower() not in OUTPUT]
    out = documents.select(*(F.col(f"`{c}`") for c in kept), F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), digest.alias("__tg_key"))
    out = out.join(F.broadcast(hot), F.col("__tg_key") == F.col("__tg_hot"), "left")
    # a row that has its count goes anywhere: no digest has 16 bytes
    out = out.withColumn("__tg_key", F.when(F.col("__tg_hot").isNull(), F.col("__tg_key")).otherwise(F.unhex(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.uuid())))))
    out = out.join(counts, F.col("__tg_key") == F.col("__tg_digest"), "left").withColumn("__tg_n", F.coalesce("__tg_n", "n_tokens"))
    return out.select(*(F.col(f"`{c}`") for c in kept), "n_bytes", F.col("__tg_n").alias("n_tokens"), (F.col("__tg_n") > limit).alias("over_limit"))

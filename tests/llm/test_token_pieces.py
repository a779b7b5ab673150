"""Token counts by pieces against the library's counts of whole texts."""

import random
from pathlib import Path

import pyarrow as pa
import pytest
import public_tokenizers

from tidegrid.llm import token_counts

PARTS = ["a", "B", "é", "ß", "×", "÷", " ", "  ", "\n", "\t", "\r", "'", "'s", "'ll", "’", " ", " ", "\x1c", "\x85", "1", "22", "²", "-", "!!", "<|endoftext|>", "<|", "ı", "中", "\U0001f600", "́", "Ã", "_", "don't", "I'VE", ".", "\x0b", "\x00", " "]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_counts_equal_the_library(spark, name):
    draw = random.Random(3)
    texts = ["".join(draw.choice(PARTS) for _ in range(draw.randrange(40))) for _ in range(20_000)] + [None, "", "\n", "\n\nb", "x" * 5000]
    texts += [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    encoder = token_counts.Encoder(Path(public_tokenizers.path(name)).read_bytes(), ".json")
    assert encoder.by_pieces == (name == "byte_bpe_50k.json")
    assert encoder.counts(pa.array(texts)).tolist() == encoder.whole([t or "" for t in texts])


def test_a_full_memory_changes_no_count(monkeypatch):
    monkeypatch.setattr(token_counts, "REMEMBERED", 3)
    encoder = token_counts.Encoder(Path(public_tokenizers.path("byte_bpe_50k.json")).read_bytes(), ".json")
    texts = [f"one two {k} three, four" for k in range(50)]
    for _ in range(2):
        assert encoder.counts(pa.array(texts)).tolist() == encoder.whole(texts)


def test_hot_texts_and_rows_without_id(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "HOT_ROWS", 5)
    rows = [(k, "the same text") for k in range(40)] + [(None, "the same text")] * 10 + [(None, "another"), (None, "another"), (None, None), (99, "other words"), (99, "other words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json")).collect()
    assert sorted(r["n_tokens"] for r in out) == sorted(3 if t == "the same text" else 2 if t == "other words" else 1 if t else 0 for _, t in rows)

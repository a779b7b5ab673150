"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing names: each operator's defined results."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidegrid.llm import decontaminate, jaccard_join, language_id, license_scan, mixing, pii, quality_neighbours, quality_rules, substring_dedup, token_counts, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_words string, score string, spans string, size string, _n string, _t string, taken string, n_tokens string"
CLEAN = "The cat and the dog of the house were in the garden, and it was a fine day for all. " * 6
LONG = " ".join(f"word{i % 4000}" for i in range(30_000))


def documents(spark):
    extra = ("x",) * 8
    rows = [
        (1, CLEAN, "en", "a", *extra),
        (2, None, None, None, *extra),
        (3, "", "en", "a", *extra),
        (4, " \n\t ", "de", "b", *extra),
        (5, CLEAN, None, "a", *extra),
        (5, CLEAN, None, "a", *extra),
        (None, CLEAN + " tail", "en", None, *extra),
        (6, LONG, "en", "b", *extra),
        (7, "mail a@b.org, löße \U0001f600 #", "de", "b", *extra),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def benchmark(spark):
    return spark.createDataFrame([(1, CLEAN), (2, None), (3, ""), (4, "two words")], "item_id long, text string")


def decoder(docs):
    return toxicity.Decoder(toxicity.count_trigrams(docs))


def tokenizer():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def toxic(docs):
    own = decoder(docs)
    labels = docs.sparkSession.createDataFrame([(1, 1), (6, 0), (None, 1), (7, None)], "doc_id long, toxic int")
    return toxicity.score_toxicity(docs, own, toxicity.learn(docs, labels, own))


def neighbours(docs):
    labels = docs.sparkSession.createDataFrame([(1, 1), (6, 0), (None, 1), (7, None)], "doc_id long, quality int")
    return quality_neighbours.score_quality(docs, quality_neighbours.learn(docs, labels))


OPERATORS = {
    "quality": quality_rules.apply_rules,
    "substring": substring_dedup.remove_repeats,
    "toxicity": toxic,
    "license": license_scan.scan_licenses,
    "language": lambda docs: language_id.predict_language(docs, language_id.learn_profiles(docs)),
    "tokens": lambda docs: token_counts.count_tokens(docs, tokenizer()),
    "decontaminate": lambda docs: decontaminate.find_contamination(docs, benchmark(docs.sparkSession)),
    "pii": lambda docs: pii.find_spans(docs, pii.learn_spans(docs)),
    "jaccard": jaccard_join.near_duplicate_groups,
    "mixing": mixing.mix_documents,
    "neighbours": neighbours,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_every_row_has_a_result(spark, name):
    docs = documents(spark)
    out = OPERATORS[name](docs)
    rows = out.collect()
    assert len(rows) == docs.count()
    assert len({c.lower() for c in out.columns}) == len(out.columns)
    if name != "jaccard":
        assert {"lang", "source", "_n"} <= set(out.columns)
        assert sorted(str(r["source"]) for r in rows) == sorted(str(r["source"]) for r in docs.collect())


@pytest.mark.parametrize("name", OPERATORS)
def test_an_empty_table_gives_no_rows(spark, name):
    assert OPERATORS[name](documents(spark).where("false")).collect() == []


STAGES = {
    "language": language_id.keep_known_languages,
    "jaccard": jaccard_join.keep_one_of_each_group,
    "decontaminate": lambda docs: decontaminate.remove_contamination(docs, benchmark(docs.sparkSession)),
    "pii": pii.mask_spans,
}


@pytest.mark.parametrize("name", STAGES)
def test_stages_keep_columns(spark, name):
    docs = documents(spark).withColumn("n_chars", F.length("text").cast("long"))
    out = STAGES[name](docs)
    assert out.dtypes == docs.dtypes
    assert out.where("length(text) <> n_chars").count() == 0
    assert STAGES[name](docs.where("false")).collect() == []


def test_defined_results(spark):
    docs = documents(spark).select("doc_id", "text", "source")
    by = lambda df: {r["doc_id"]: r for r in df.collect()}
    q = by(quality_rules.apply_rules(docs))
    assert q[1]["kept"] is False and q[1]["n_repeat_words"] == q[1]["n_words"]  # six equal sentences
    assert (q[2]["n_words"], q[2]["base_failed"], q[4]["n_words"]) == (0, True, 0)
    s = substring_dedup.remove_repeats(docs).collect()
    gone = {(r["doc_id"], r["n_removed"] == r["n_words"]) for r in s if r["doc_id"] in (1, 5)}
    assert gone == {(1, False), (5, True)}  # both rows of 5 lose what 1 has; equal ids lose nothing to each other
    assert next(r for r in s if r["doc_id"] is None)["kept_text"].endswith("tail")
    j = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.near_duplicate_groups(docs).collect()]
    assert (2, 0, 2) in j and (3, 0, 3) in j and [c for i, _, c in j if i == 5] == [1, 1] and next(c for i, _, c in j if i is None) is None
    d = by(decontaminate.find_contamination(docs, benchmark(spark)))
    assert d[1]["n_hit"] == d[1]["n_words"] and d[1]["n_items"] == 1 and d[2]["n_hit"] == 0 and d[6]["contaminated"] is False
    m = by(mixing.mix_documents(docs))
    assert m[2]["size"] == m[2]["taken"] == 0
    assert all(r["taken"] <= 2 * r["size"] for r in mixing.mix_documents(docs).collect())
    x = by(language_id.predict_language(docs, language_id.Profiles({})))
    assert {r["lang_pred"] for r in x.values()} == {"und"}
    t = by(token_counts.count_tokens(docs, tokenizer()))
    assert t[2]["n_tokens"] == 0 and t[6]["over_limit"] is True
    p = by(pii.find_spans(docs, {}))
    assert [tuple(s) for s in p[7]["spans"]] == [("email", 5, 12)] and p[2]["spans"] == []


def test_one_of_each_group_stays(spark):
    docs = documents(spark).select("doc_id", "text")
    kept = sorted(str(r["doc_id"]) for r in jaccard_join.keep_one_of_each_group(docs).collect())
    assert kept == ["1", "2", "3", "4", "6", "7", "None"]


def test_pipeline_on_odd_and_empty_tables(spark, tmp_path):
    """Texts without a letter go, of equal rows and near copies the least id stays, rows without id are judged by their text, other columns stay."""
    benchmark(spark).write.parquet(f"{tmp_path}/odd/benchmark.parquet")
    documents(spark).write.parquet(f"{tmp_path}/odd/documents.parquet")
    out = corpus_pipeline.run(spark, f"{tmp_path}/odd")
    rows = {r["doc_id"]: r for r in out.collect()}
    assert out.count() == len(rows) and set(rows) == {6, 7}  # 1, 5 and the one without id are the benchmark's item, over and over
    assert rows[7]["text"] == "mail [EMAIL], löße \U0001f600 #" and rows[6]["text"] == LONG and rows[7]["lang"] == "de"
    assert {"size", "taken", "position", "_n", "spans"} <= set(out.columns)
    benchmark(spark).where("false").write.parquet(f"{tmp_path}/clean/benchmark.parquet")
    documents(spark).write.parquet(f"{tmp_path}/clean/documents.parquet")
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, f"{tmp_path}/clean").collect()} == {1, 6, 7, None}  # a row without id goes with equal sets only
    benchmark(spark).write.parquet(f"{tmp_path}/empty/benchmark.parquet")
    documents(spark).where("false").write.parquet(f"{tmp_path}/empty/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty").collect() == []


def test_an_id_with_two_labels_is_toxic(spark):
    docs = spark.createDataFrame([(i, "you idiot of a moron" if i % 3 == 0 else f"fine words number {i} here") for i in range(300)], "doc_id long, text string")
    own = decoder(docs)
    one = [(i, int(i % 3 == 0)) for i in range(300)]
    both = one + [(i, 0) for i in range(300)]
    first, second = (toxicity.learn(docs, spark.createDataFrame(rows, "doc_id long, toxic int"), own) for rows in (one, both))
    assert first.bias.tolist() == second.bias.tolist() and first.features.tolist() == second.features.tolist()

"""One query for each operator of this subpackage, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.llm import decontaminate, jaccard_join, language_id, lexical_search, license_scan, mixing, pii, prefix_trie, quality_neighbours, quality_rules, substring_dedup, token_counts, toxicity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.apply_rules(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = language_id.held_out("doc_id", 3, 1)
    decoder = toxicity.Decoder(toxicity.count_trigrams(documents))
    model = toxicity.learn(documents, table(spark, sf_dir, "labels").where(~out), decoder)
    scored = toxicity.score_toxicity(documents, decoder, model)
    return scored.select("doc_id", out.alias("held_out"), "score", "predicted")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    out = language_id.held_out("doc_id", 4, 2)
    profiles = language_id.learn_profiles(documents.where(~out).select("doc_id", "text", "lang"))
    found = language_id.predict_language(documents.select("doc_id", "text"), profiles)
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a new cache each time, so every distinct text is encoded."""
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find_spans(documents, pii.learn_spans(documents))
    count = lambda kind: F.size(F.filter("base_spans", lambda c: c["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *(count(k) for k in pii.BASE), F.sha2(pii.listed("base_spans"), 256).alias("base_sha256"), pii.listed("spans").alias("spans"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicate_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.place_documents(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "position")


def op11_quality_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = language_id.held_out("doc_id", 3, 1)
    model = quality_neighbours.learn(documents, table(spark, sf_dir, "labels").where(~out))
    return quality_neighbours.score_quality(documents, model).select("doc_id", out.alias("held_out"), "score", "predicted")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_license_scan": op4_license_scan,
    "op5_language_id": op5_language_id,
    "op6_token_counts": op6_token_counts,
    "op7_decontamination": op7_decontamination,
    "op8_pii": op8_pii,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_mixing": op10_mixing,
    "op11_quality_neighbours": op11_quality_neighbours,
    "op12_lexical_search": op12_lexical_search,
    "op13_prefix_trie": op13_prefix_trie,
}

MATCHES = ",\n    ".join(f"CASE WHEN regexp_matches(s, ' {license_scan.as_regex(wording)}') THEN '{label}' END" for label, wording in license_scan.TEMPLATES)
WHOLE = ", ".join(f"'{label}'" for label in sorted(license_scan.WHOLE))
STOPS = ", ".join(f"'{w}'" for w in quality_rules.STOP_WORDS)

ORACLE_SQL: dict[str, str] = {
    "op1_quality_rules": rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l,
         row_number() OVER () AS row
  FROM documents),
win AS (
  SELECT row, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT row, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
rep AS (
  SELECT row, count(DISTINCT p) AS n FROM (
    SELECT row, unnest([i, i + 1, i + 2]) AS p
    FROM (SELECT row, i, count(*) OVER (PARTITION BY row, g) AS c FROM win) WHERE c > 1) GROUP BY row),
m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
         length(regexp_replace(t, '[^A-Z]', '', 'g')) AS caps, length(regexp_replace(t, '[^A-Za-z]', '', 'g')) AS letters,
         len(list_filter(w, lambda x: lower(x) IN ({STOPS}))) AS stops, len(l) AS lines,
         len(list_filter(l, lambda x: regexp_matches(x, '[.!?:;…。！？"''»”’)\]][\x20\x09-\x0D]*$'))) AS ended
  FROM d LEFT JOIN rep USING (row)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars / n_words BETWEEN 2 AND 20 AND n_symbols / n_words <= 0.1
       AND coalesce(caps / nullif(letters, 0), 0) <= 0.3 AND stops / n_words >= 0.01 AND ended / lines >= 0.5
       AND n_dup_lines / lines <= 0.3 AND n_repeat_words / n_words <= 0.3 AS kept
FROM b""",
    "op2_substring_dedup": r"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(doc_id, 9223372036854775807) AS id, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT row, id, i, min(id) OVER (PARTITION BY array_to_string(w[i:i + 49], ' ')) AS owner
  FROM (SELECT row, id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
gone AS (SELECT DISTINCT row, unnest(range(i, i + 50)) AS p FROM win WHERE owner < id),
word AS (SELECT row, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
left_over AS (SELECT row, string_agg(x, ' ' ORDER BY p) AS t FROM word ANTI JOIN gone USING (row, p) GROUP BY row),
n AS (SELECT row, count(*) AS n FROM gone GROUP BY row)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN n USING (row) LEFT JOIN left_over USING (row)""",
    "op4_license_scan": rf"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
t AS (SELECT *, ' ' || array_to_string(w, ' ') || ' ' AS s FROM d),
p AS (
  SELECT row, i - 1 AS i, CASE WHEN w[i] = 'cc' THEN 'cc-by' WHEN w[i] = 'all' THEN 'reserved' ELSE 'gpl' END AS label
  FROM (SELECT row, w, unnest(range(1, len(w))) AS i FROM d WHERE len(w) > 1)
  WHERE (w[i] = 'cc' AND w[i + 1] = 'by') OR (w[i] = 'all' AND w[i + 1] = 'rights' AND w[i + 2] = 'reserved')
     OR (w[i] = 'general' AND w[i + 1] = 'public' AND w[i + 2] = 'license')),
b AS (SELECT row, count(*) AS n, min(i) AS lo, max(i) AS hi, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM p GROUP BY row),
m AS (
  SELECT row, unnest([
    {MATCHES}]) AS label
  FROM t),
l AS (SELECT row, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score
      FROM (SELECT row, label, CASE WHEN label IN ({WHOLE}) THEN 1 ELSE 0.8 END AS score FROM m WHERE label IS NOT NULL UNION ALL SELECT row, label, 0.6 FROM p) GROUP BY row)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(b.n, 0) AS BIGINT) AS n_base, CAST(b.lo AS BIGINT) AS first_word, CAST(b.hi AS BIGINT) AS last_word,
       coalesce(b.labels, '') AS base_labels, coalesce(l.labels, '') AS labels,
       CAST(coalesce(l.score, 0) AS DOUBLE) AS score
FROM d LEFT JOIN b USING (row) LEFT JOIN l USING (row)""",
    "op7_decontamination": r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
g AS (
  SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS gram
  FROM (SELECT item, w, least(len(w), 10) AS k, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM g),
h AS (
  SELECT row, i, k, gram FROM (
    SELECT row, i, k, array_to_string(w[i:i + k - 1], ' ') AS gram
    FROM (SELECT row, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks))
  WHERE gram IN (SELECT gram FROM g)),
p AS (SELECT row, count(DISTINCT p) AS n FROM (SELECT row, unnest(range(i, i + k)) AS p FROM h) GROUP BY row),
s AS (SELECT row, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM h JOIN g USING (gram, k) GROUP BY row)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(p.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(s.n, 0) AS BIGINT) AS n_items,
       sha256(coalesce(s.ids, '')) AS items_sha256, coalesce(p.n, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (row) LEFT JOIN s USING (row)""",
    "op9_jaccard_join": r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT row, doc_id, array_to_string(w[i:i + 2], ' ') AS g
  FROM (SELECT row, doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT row, doc_id, count(*) AS n FROM s GROUP BY row, doc_id),
o AS (SELECT a.row AS a, b.row AS b, count(*) AS hits FROM s a JOIN s b ON a.g = b.g AND a.row < b.row GROUP BY a.row, b.row),
e AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM o JOIN n x ON x.row = o.a JOIN n y ON y.row = o.b
  WHERE 100 * hits >= 90 * (x.n + y.n - hits)),
l AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id
FROM d LEFT JOIN n USING (row) JOIN (SELECT a, min(b) AS component_id FROM r GROUP BY a) c ON c.a = d.doc_id""",
    "op10_mixing": r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (
  SELECT *, 2.0::DOUBLE * source_size AS cap, CAST([3, 1, 2][rank % 3 + 1] AS DOUBLE) AS weight, CAST([-0.5, 0, 0.5][rank % 3 + 1] AS DOUBLE) AS slope
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM d GROUP BY source)),
f AS (
  SELECT *, (sum(CAST(source_size AS DOUBLE)) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER o, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0)) AS level
  FROM s WINDOW o AS (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
v AS (SELECT arg_min(level, (cap / weight, rank)) AS level FROM f WHERE level * weight <= cap),
t AS (SELECT source, source_size, slope, least(cap, coalesce(v.level * weight, cap)) AS target FROM f CROSS JOIN v),
c AS (
  SELECT d.doc_id, size, source_size, target, slope, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS r,
         sum(size) OVER (PARTITION BY d.source ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), '')), doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
x AS (
  SELECT *, CAST(floor(upto * r) AS BIGINT) AS b, CAST(floor((upto - size) * r) AS BIGINT) AS a FROM c),
y AS (SELECT *, least(1.0, CASE WHEN target > 0 THEN (a + b) / (2.0::DOUBLE * target) ELSE 0 END) AS m FROM x)
SELECT doc_id, size, source_size, target, CASE WHEN size > 0 THEN b - a ELSE 0 END AS taken,
       round(CASE WHEN slope = 0 THEN m ELSE (slope - 1 + sqrt((1 - slope) * (1 - slope) + 4 * slope * m)) / (2 * slope) END, 6) AS position
FROM y""",
    "op12_lexical_search": r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT row_number() OVER () AS item, item_id,
         list_distinct(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS w FROM benchmark),
q AS (SELECT item, item_id, unnest(w) AS term FROM b),
n AS (SELECT count(*) AS docs, CAST(sum(len(w)) AS BIGINT) AS total FROM d WHERE len(w) > 0),
tf AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY row, term),
wt AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS wt FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), n),
x AS (
  SELECT tf.row, tf.term, wt.wt * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * len(d.w) * docs) // total))) AS v
  FROM tf JOIN d USING (row) JOIN wt USING (term), n),
s AS (SELECT q.item, any_value(item_id) AS item_id, x.row, CAST(sum(v) AS BIGINT) AS score FROM q JOIN x USING (term) GROUP BY q.item, x.row)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s JOIN d USING (row) WHERE score > 0)
WHERE rank <= 50""",
    "op13_prefix_trie": r"""
WITH RECURSIVE crc_bits AS (
  SELECT i AS b, CAST(i AS BIGINT) AS v, 0 AS k FROM range(256) r(i)
  UNION ALL SELECT b, CASE WHEN v % 2 = 1 THEN xor(3988292384, v // 2) ELSE v // 2 END, k + 1 FROM crc_bits WHERE k < 8),
crc AS (SELECT list(v ORDER BY b) AS tab FROM crc_bits WHERE k = 8),
x AS (
  SELECT conv_id, turn, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS b
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, list(id ORDER BY turn NULLS FIRST, id) AS ids, list(b ORDER BY turn NULLS FIRST, id) AS bs FROM x GROUP BY conv_id),
h AS (
  SELECT o.*, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
           lambda v, c: xor(tab[(xor(v, c) % 256) + 1], v // 256)), 4294967295) % 9 AS h
  FROM o, crc),
r AS (
  SELECT h.conv_id, list_concat(coalesce(p.ids[1:h.h], []), h.ids[h.h + 1:]) AS ids, list_concat(coalesce(p.bs[1:h.h], []), h.bs[h.h + 1:]) AS bs
  FROM h LEFT JOIN o p ON p.conv_id = h.conv_id - h.conv_id % 5),
m AS (SELECT conv_id, d, len(ids) = d AS ends, ids[1:d] AS node, CASE WHEN d = 0 THEN 0 ELSE bs[d] END AS b FROM (SELECT *, unnest(range(len(ids) + 1)) AS d FROM r)),
n AS (
  SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs, max(b) AS b, coalesce(string_agg(CASE WHEN ends THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '') AS ends
  FROM m GROUP BY node, d),
k AS (SELECT node[1:d - 1] AS node, count(*) AS n FROM n WHERE d > 0 GROUP BY 1),
v AS (SELECT n.*, coalesce(k.n, 0) AS n_children FROM n LEFT JOIN k USING (node)),
s AS (
  SELECT node[1:e] AS node, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * b) AS saved_tokens
  FROM (SELECT *, unnest(range(d + 1)) AS e FROM v) GROUP BY 1)
SELECT v.conv_id, CAST(v.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, v.n_convs, CAST(v.n_children AS BIGINT) AS n_children, s.n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens,
       sha256(v.ends) AS ends_sha256
FROM v JOIN s USING (node) LEFT JOIN v p ON v.d > 0 AND p.d = v.d - 1 AND p.node = v.node[1:v.d - 1]""",
}

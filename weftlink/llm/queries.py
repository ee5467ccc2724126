"""Registered queries of this subpackage: name -> function of (spark, sf_dir), and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import byte_bpe, html_text, katz, kneser_ney, language_id, line_dedup, phrase_index, quality_ratio, shingle_join, unigram_counts

BPE_FILE = "byte_bpe_multi_50k.tiktoken"
PIECE_FILE = "piece_bpe_32k.model"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_ratio.judged(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_texts(read(spark, sf_dir, "pages"))


def op3_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score(read(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(read(spark, sf_dir, "documents"))


def op5_unigram_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return unigram_counts.report(read(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_FILE))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return byte_bpe.digests(read(spark, sf_dir, "documents"), public_tokenizers.path(BPE_FILE), public_tokenizers.PATTERN)


def op7_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.groups(read(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(read(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_index.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_ratio": op1_quality_ratio,
    "op2_html_text": op2_html_text,
    "op3_katz": op3_katz,
    "op4_language_id": op4_language_id,
    "op5_unigram_counts": op5_unigram_counts,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_kneser_ney": op7_kneser_ney,
    "op8_shingle_join": op8_shingle_join,
    "op9_line_dedup": op9_line_dedup,
    "op10_decontamination": op10_decontamination,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL: dict[str, str] = {
    "op8_shingle_join": rf"""WITH RECURSIVE w AS MATERIALIZED (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM w),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS MATERIALIZED (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 75 * (x.n + y.n - o)),
e AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT DISTINCT a AS v, a AS u FROM e UNION SELECT r.v, e.b FROM r JOIN e ON e.a = r.u)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.low, w.doc_id) AS component_id FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT v, min(u) AS low FROM r GROUP BY 1) c ON c.v = w.doc_id""",
    "op10_decontamination": rf"""WITH d AS MATERIALIZED (SELECT doc_id, regexp_extract_all({_LOWER}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM documents),
q AS (SELECT item_id::VARCHAR AS item, regexp_extract_all({_LOWER}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM benchmark),
k AS MATERIALIZED (SELECT DISTINCT item, least(len(w), 10) AS n, unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: array_to_string(w[i:i + 9], ' '))) AS g FROM q WHERE len(w) > 0),
p AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM d, (SELECT DISTINCT n FROM k)),
h AS MATERIALIZED (SELECT doc_id, i, p.n, item FROM p JOIN k ON k.n = p.n AND k.g = array_to_string(w[i:i + p.n - 1], ' ')),
c AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM h) GROUP BY 1),
t AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM h GROUP BY 1)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)""",
}

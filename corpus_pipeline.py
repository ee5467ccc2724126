"""Corpus pipeline: language ID, line dedup, near-duplicate removal, decontamination, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and reread as the next one's docs.  All but the last return the columns
of documents.

Defined cases are those of the operators.  Besides: the first stage drops texts without a letter, nulls
included, and texts of which the predicted language has a probability below 0.3; the second drops a document when all its
lines are repeats; an empty table stays empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from weftlink.llm import byte_bpe, language_id, line_dedup, phrase_index, shingle_join
from weftlink.llm.common import stored
from weftlink.llm.queries import BPE_FILE


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is determined; the others go."""
    return language_id.accepted(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier line repeats; n_chars follows the text."""
    out = line_dedup.cleaned(docs)
    return out.selectExpr(*["cast(char_length(text) as bigint) as n_chars" if c == "n_chars" else f"`{c}`" for c in out.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones."""
    return shingle_join.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no passage of the benchmark occurs."""
    return phrase_index.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of what is left."""
    return byte_bpe.digests(docs, public_tokenizers.path(BPE_FILE), public_tokenizers.PATTERN)


STAGES = [("language_id", language), ("line_dedup", lines), ("shingle_join", near_duplicates), ("decontamination", decontamination), ("byte_bpe", tokens)]

#: The learned and the hashed stages have no SQL form; tests/llm/test_pipeline.py holds run() against a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

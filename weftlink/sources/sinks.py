"""Sinks: Parquet candidates, TSV results, JSON dictionaries and metadata, CSV and text reports."""

from __future__ import annotations

import json
import logging

from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

log = logging.getLogger("weftlink")


def write_candidates(candidates: DataFrame, path: str) -> None:
    candidates.write.mode("overwrite").parquet(path)


def write_tsv(rows: DataFrame, path: str) -> None:
    """Tab-separated strings with a header, nothing quoted or escaped, empty strings empty.

    Rebalanced, so that no empty or tiny part files with a header alone stand beside the others.
    """
    rows.na.fill("").hint("rebalance").write.mode("overwrite").csv(path, sep="\t", header=True, quote="\u0000", emptyValue="", escapeQuotes=False)


def result_rows(s1: DataFrame, pairs: DataFrame, column: str) -> DataFrame:
    """One row for each S1 id with its comma-joined, sorted ids; an S1 without any has an empty list."""
    lists = pairs.groupBy("source1_entity_id").agg(F.array_join(F.sort_array(F.collect_set("candidate_entity_id")), ",").alias(column))
    return s1.select("source1_entity_id").distinct().join(lists, "source1_entity_id", "left").na.fill("")


def write_results(s1: DataFrame, matches: DataFrame, candidates: DataFrame, out_dir: str) -> None:
    """matching_results and candidate_pairs as TSV folders."""
    write_tsv(result_rows(s1, matches, "matched_entity_ids"), f"{out_dir}/matching_results.tsv")
    write_tsv(result_rows(s1, candidates, "candidate_entity_ids"), f"{out_dir}/candidate_pairs.tsv")


def write_text(spark, path: str, text: str) -> None:
    """A small file made by the driver, in whatever store the path names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).create(p, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def write_dictionary(dictionary: DataFrame, path: str) -> None:
    """One JSON object (the mined dictionary is small: one entry for each kept token), and a Parquet twin for joins."""
    dictionary.write.mode("overwrite").parquet(f"{path}.parquet")
    rows = {r["native"]: r["latin"] for r in dictionary.orderBy("native").toLocalIterator()}
    write_text(dictionary.sparkSession, path, json.dumps(rows, ensure_ascii=False, indent=1))


def write_model(model: GBTClassificationModel, path: str) -> None:
    """A fitted matcher, for read_model in a later session."""
    model.write().overwrite().save(path)


def write_metadata(spark, path: str, metadata: dict) -> None:
    write_text(spark, path, json.dumps(metadata, indent=1, sort_keys=True))


def write_report(report: DataFrame, path: str, rows: int = 40) -> None:
    """A report of few rows as one CSV file, and in the log."""
    report.coalesce(1).write.mode("overwrite").csv(path, header=True)
    for r in report.limit(rows).collect():
        log.info("%s", r.asDict())

"""Rules for result files: one table of violations (rule, level, s1, id, detail)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip
from ..sources.records import exists, parse_results, read_ids, read_result_lines

# Headers of the two result files.
MATCH_HEADER = ["source1_entity_id", "matched_entity_ids"]
CANDIDATE_HEADER = ["source1_entity_id", "candidate_entity_ids"]
SCHEMA = "rule string, level string, s1 string, id string, detail string"


def _rows(rows: DataFrame, rule: str, s1: Column | None = None, id_: Column | None = None, detail: Column | None = None, level: str = "error") -> DataFrame:
    none = F.lit("")
    return rows.select(F.lit(rule).alias("rule"), F.lit(level).alias("level"), (none if s1 is None else s1).alias("s1"), (none if id_ is None else id_).alias("id"), (none if detail is None else detail.cast("string")).alias("detail"))


def violations(results: DataFrame, required: DataFrame, valid_ids: DataFrame | None = None) -> DataFrame:
    """Violations of parsed rows (line, s1, has_tab, ids); required: entity_id of S1; valid_ids: entity_id that may be named."""
    listed = results.where("has_tab")
    each = listed.select("s1", F.explode("ids").alias("id"))
    known = listed.select("s1").distinct()
    need = required.select(F.col("entity_id").alias("s1")).distinct()
    out = _rows(results.where("not has_tab"), "row_without_tab", detail=F.col("line"))
    out = out.unionByName(_rows(listed.groupBy("s1").agg(F.count("*").alias("n")).where("n > 1"), "duplicate_s1", F.col("s1"), detail=F.col("n")))
    out = out.unionByName(_rows(listed.where("size(ids) <> size(array_distinct(ids))"), "repeated_id", F.col("s1")))
    out = out.unionByName(_rows(each.where("startswith(id, 'S1-')").distinct(), "s1_in_list", F.col("s1"), F.col("id")))
    out = out.unionByName(_rows(each.where("not (startswith(id, 'S1-') or startswith(id, 'S2-') or startswith(id, 'S3-'))").distinct(), "bad_prefix", F.col("s1"), F.col("id")))
    if valid_ids is not None:
        valid = valid_ids.select(F.col("entity_id").alias("id")).distinct()
        out = out.unionByName(_rows(each.where("startswith(id, 'S2-') or startswith(id, 'S3-')").distinct().join(valid, "id", "left_anti"), "unknown_id", F.col("s1"), F.col("id")))
    out = out.unionByName(_rows(need.join(known, "s1", "left_anti"), "missing_s1", F.col("s1")))
    return out.unionByName(_rows(known.join(need, "s1", "left_anti"), "unexpected_s1", F.col("s1")))


def last_lists(results: DataFrame) -> DataFrame:
    """s1, id out of the last row of each S1."""
    last = results.where("has_tab").groupBy("s1").agg(F.max_by("ids", "line").alias("ids"))
    return last.select("s1", F.explode("ids").alias("id")).distinct()


def not_subset(matching: DataFrame, candidates: DataFrame) -> DataFrame:
    """Warnings for matches that are not among the candidates."""
    return _rows(last_lists(matching).join(last_lists(candidates), ["s1", "id"], "left_anti"), "match_not_candidate", F.col("s1"), F.col("id"), level="warning")


def header_violations(spark: SparkSession, path: str, header: list[str]) -> DataFrame:
    """File-level rules: missing or empty file, bytes that are not UTF-8, commas instead of tabs, an unexpected header."""
    def one(rule: str, detail: str = "") -> DataFrame:
        return spark.createDataFrame([(rule, "error", "", "", detail)], SCHEMA)

    if not exists(spark, path):
        return one("file_missing", path)
    lines = spark.read.text(path)
    first = lines.limit(1).collect()
    if not first or not first[0]["value"].strip():
        return one("file_empty", path)
    text = first[0]["value"].lstrip("﻿")
    out = spark.createDataFrame([], SCHEMA)
    if not lines.where(F.contains("value", F.lit("�"))).isEmpty():
        out = out.unionByName(one("not_utf8", path))
    if "\t" not in text and "," in text:
        return out.unionByName(one("header_commas", text))
    if [x.strip().lower() for x in text.split("\t")] != header:
        out = out.unionByName(one("header_unexpected", text))
    return out


def validate(spark: SparkSession, matching_path: str, candidate_path: str | None, s1_path: str, id_paths: list[str] | None = None) -> tuple[bool, DataFrame]:
    """Whether result files pass (warnings allowed), and all violations.  ``id_paths`` turns the check of unknown ids on."""
    if not exists(spark, s1_path):
        return False, spark.createDataFrame([("required_missing", "error", "", "", s1_path)], SCHEMA)
    required = read_ids(spark, s1_path)
    valid = None
    for path in id_paths or []:
        ids = read_ids(spark, path)
        valid = ids if valid is None else valid.unionByName(ids)
    found = header_violations(spark, matching_path, MATCH_HEADER)
    if not found.where("rule in ('file_missing', 'file_empty', 'header_commas', 'header_unexpected')").isEmpty():
        return False, found
    matching = parse_results(read_result_lines(spark, matching_path))
    found = found.unionByName(violations(matching, required, valid))
    if candidate_path is None or not exists(spark, candidate_path):
        found = found.unionByName(spark.createDataFrame([("candidates_absent", "warning", "", "", candidate_path or "")], SCHEMA))
    else:
        head = header_violations(spark, candidate_path, CANDIDATE_HEADER)
        found = found.unionByName(head)
        if head.where("rule in ('file_empty', 'header_commas', 'header_unexpected')").isEmpty():
            candidates = parse_results(read_result_lines(spark, candidate_path))
            found = found.unionByName(violations(candidates, required, valid)).unionByName(not_subset(matching, candidates))
    return found.where("level = 'error'").isEmpty(), found


def examples(rows: DataFrame, column: str, n: int = 5) -> DataFrame:
    """rule, n and the first n values of ``column`` for messages."""
    return rows.groupBy("rule").agg(F.count("*").alias("n"), F.slice(F.array_sort(F.collect_set(strip(F.col(column)))), 1, n).alias("examples"))

"""Scans of record tables, ground truth, dictionaries, candidates and result files."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import strip

RECORD = T.StructType([T.StructField(c, T.StringType()) for c in ("entity_id", "business_name", "business_address", "country")])
TRUTH = T.StructType([T.StructField(c, T.StringType()) for c in ("source1_entity_id", "matched_entity_ids")])
CORRUPT = "_malformed"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, in whatever store it lies."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(p)


def read_tsv(spark: SparkSession, path: str, schema: T.StructType = RECORD) -> DataFrame:
    """Tab-separated strings with a header and no quoting; an empty field is an empty string, never null."""
    return spark.read.csv(path, schema=schema, sep="\t", header=True, quote="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).na.fill("")


def read_tsv_tolerant(spark: SparkSession, path: str, schema: T.StructType = RECORD) -> tuple[DataFrame, DataFrame]:
    """Well-formed rows, and the malformed lines that were dropped."""
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    rows = spark.read.csv(path, schema=wide, sep="\t", header=True, quote="", mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, encoding="UTF-8")
    return rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT).na.fill(""), rows.where(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def filtered_read_tsv(spark: SparkSession, path: str, ids: DataFrame) -> DataFrame:
    """Rows whose entity_id is among ``ids`` (first column)."""
    wanted = ids.select(F.col(ids.columns[0]).alias("entity_id")).distinct()
    return read_tsv(spark, path).join(wanted, "entity_id", "left_semi")


def load_all(spark: SparkSession, data_dir: str) -> DataFrame:
    """Every ``{split}_source{1,2,3}.tsv`` that is there, tagged with split and src; missing files are skipped."""
    out = None
    for split in ("train", "test"):
        for i in (1, 2, 3):
            path = f"{data_dir}/{split}/{split}_source{i}.tsv"
            if exists(spark, path):
                rows = read_tsv_tolerant(spark, path)[0].withColumns({"split": F.lit(split), "src": F.lit(f"S{i}")})
                out = rows if out is None else out.unionByName(rows)
    if out is None:
        schema = T.StructType([*RECORD.fields, T.StructField("split", T.StringType()), T.StructField("src", T.StringType())])
        return spark.createDataFrame([], schema)
    return out


def id_list(x: Column) -> Column:
    """Comma-separated ids, stripped, without blanks."""
    return F.filter(F.transform(F.split(x, ",", -1), strip), lambda i: i != "")


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    """source1_entity_id and the array ids."""
    return read_tsv(spark, path, TRUTH).select("source1_entity_id", id_list(F.col("matched_entity_ids")).alias("ids"))


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """native and latin tokens of a JSON object."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.explode(F.from_json("value", "map<string,string>")).alias("native", "latin"))


def read_candidates(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_model(path: str) -> GBTClassificationModel:
    """A matcher that write_model saved."""
    return GBTClassificationModel.load(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Distinct first fields of the lines after the header, stripped; blank lines are left out."""
    rows = spark.read.csv(path, schema="entity_id string", sep="\t", header=True, quote="", mode="PERMISSIVE")
    return rows.select(strip(F.coalesce("entity_id", F.lit(""))).alias("entity_id")).where("entity_id <> ''").distinct()


def read_result_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a result file with their numbers from 1: line, value."""
    rows = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("f"), F.monotonically_increasing_id().alias("i"))
    numbered = rows.rdd.zipWithIndex().map(lambda x: (x[1] + 1, x[0]["value"]))  # numbers are for messages only
    return spark.createDataFrame(numbered, "line long, value string")


def parse_results(lines: DataFrame) -> DataFrame:
    """line, s1, has_tab and the raw id list of the rows after the header.

    Nothing is stripped and blank ids stay, so that the rules see them; a blank list has no ids, and blank lines without a tab are left out.
    """
    has_tab = F.contains("value", F.lit("\t"))
    rows = lines.where("line > 1").where(has_tab | (strip(F.col("value")) != ""))
    parts = F.split("value", "\t", 2)
    raw = F.coalesce(F.get(parts, F.lit(1)), F.lit(""))
    ids = F.when(strip(raw) == "", F.array().cast("array<string>")).otherwise(F.split(raw, ",", -1))
    return rows.select("line", parts[0].alias("s1"), has_tab.alias("has_tab"), ids.alias("ids"))

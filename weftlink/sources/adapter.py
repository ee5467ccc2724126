"""Records out of the ``documents`` table, so that linkage runs on the driver's data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity_id, business_name (first line), business_address (all the rest of the text), country, src, split."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    src = F.concat(F.lit("S"), (1 + F.col("doc_id") % 3).cast("string"))
    return docs.select(
        F.concat(src, F.lit("-"), F.col("doc_id").cast("string")).alias("entity_id"),
        F.split_part("text", F.lit("\n"), F.lit(1)).alias("business_name"),
        F.array_join(F.slice(F.split("text", "\n"), 2, 2**31 - 1), "\n").alias("business_address"),
        F.col("lang").alias("country"),
        src.alias("src"),
        F.when(F.col("doc_id") % 2 == 0, "train").otherwise("test").alias("split"),
    )


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """source1_entity_id and match_id: S1 documents and the documents of S2 and S3 that have the same text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.sha2("text", 256).alias("h"))
    src = (1 + F.col("doc_id") % 3).cast("string")
    name = F.concat(F.lit("S"), src, F.lit("-"), F.col("doc_id").cast("string"))
    one = docs.where("doc_id % 3 = 0").select("h", name.alias("source1_entity_id"))
    rest = docs.where("doc_id % 3 <> 0").select("h", name.alias("match_id"))
    return one.join(rest, "h").select("source1_entity_id", "match_id")

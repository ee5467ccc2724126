"""Mining and using a dictionary from native-script to Latin words."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X

MIN_COUNT = 3


def alignments(truth: DataFrame, names: DataFrame) -> DataFrame:
    """For each true pair: latin and native word arrays and why it is used or not (status).

    truth: source1_entity_id, match_id; names: entity_id, business_name.  Pairs of a native-script or wordless S1 are left out.
    """
    names = names.withColumn("cased", X.casefold("business_name")).select("entity_id", "business_name", X.name_words(F.col("cased")).alias("words"), X.is_native(F.col("business_name")).alias("native"))
    one = names.where("not native and size(words) > 0").select(F.col("entity_id").alias("source1_entity_id"), F.col("words").alias("latin"))
    other = names.select(F.col("entity_id").alias("match_id"), F.col("words").alias("native_words"), "native")
    rows = truth.join(one, "source1_entity_id").join(other, "match_id", "left")
    status = F.when(~F.coalesce("native", F.lit(False)), "no_native").when(F.size("latin") != F.size("native_words"), "mismatch").otherwise("aligned")
    return rows.withColumn("status", status)


def counts(aligned: DataFrame) -> DataFrame:
    """native, latin, n over positions of equally long names."""
    pairs = aligned.where("status = 'aligned'").select(F.inline(F.arrays_zip(F.col("native_words").alias("native"), F.col("latin").alias("latin"))))
    return pairs.groupBy("native", "latin").agg(F.count("*").alias("n"))


def dictionary(counted: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """native and its most frequent latin word (ties: the smaller), for natives seen ``min_count`` times in all."""
    over = Window.partitionBy("native")
    rows = counted.withColumns({"total": F.sum("n").over(over), "rn": F.row_number().over(over.orderBy(F.desc("n"), "latin"))})
    return rows.where(f"rn = 1 and total >= {min_count}").select("native", "latin")


def statistics(aligned: DataFrame, counted: DataFrame, kept: DataFrame) -> DataFrame:
    """One row with the five counters of a mining run."""
    row = aligned.agg(F.count_if(F.col("status") == "aligned").alias("aligned_name_pairs"), F.count_if(F.col("status") == "mismatch").alias("skipped_token_count_mismatch"), F.count_if(F.col("status") == "no_native").alias("matches_with_no_native_script"))
    return row.join(F.broadcast(kept.agg(F.count("*").alias("distinct_native_tokens_kept")))).join(F.broadcast(counted.agg(F.count_distinct("native").alias("distinct_native_tokens_seen"))))


def latinised(records: DataFrame, dictionary: DataFrame) -> DataFrame:
    """``records`` with latin_name: each word of a native-script name replaced where the dictionary knows it.

    Look-up is a join on words in their order, so the dictionary may be of any size.
    """
    words = records.where(X.is_native(F.col("business_name"))).select("entity_id", F.posexplode(X.pieces(F.col("business_name"))).alias("pos", "raw"))
    keyed = words.withColumn("native", F.regexp_replace(X.casefold("raw"), r"""^[.,()\[\]{}'"]+|[.,()\[\]{}'"]+$""", ""))
    found = keyed.join(dictionary.select("native", "latin"), "native", "left").select("entity_id", "pos", F.coalesce("latin", "raw").alias("word"))
    names = found.groupBy("entity_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "word"))), lambda x: x["word"]), " ").alias("latin_name"))
    rows = records.join(names, "entity_id", "left")
    return rows.withColumn("latin_name", F.coalesce("latin_name", "business_name"))

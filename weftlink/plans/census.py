"""Profiles of record tables: scripts, noise, train-test shift, ground-truth structure, samples of groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scripts as S

MIX = ["name_multi_script", "name_mixed_in_token", "latin_accent", "fr_like_heuristic"]
FLAGS = ["f_name_empty", "f_addr_empty", "f_addr_null_token", "f_addr_hash", "f_addr_state_first", "f_addr_allcaps", "f_name_allcaps", "f_name_domain_like", "f_name_bracket", "f_name_letter_digit"]


def enriched(records: DataFrame) -> DataFrame:
    """Records with script profiles, script mixture, French hints and noise flags."""
    name, address = F.col("business_name"), F.col("business_address")
    rows = records.withColumns({"_n": S.scripts_of("business_name"), "_a": S.scripts_of("business_address"), "latin_accent": S.has_latin_accent(F.concat("business_name", F.lit(" "), "business_address")), "name_mixed_in_token": S.mixed_inside_token("business_name")})
    rows = rows.withColumns({"country": S.country_clean(F.col("country")), "name_script": S.profile(F.col("_n")), "addr_script": S.profile(F.col("_a")), "name_multi_script": F.size("_n") > 1, "fr_like_heuristic": S.french_like(name, address, F.col("latin_accent")), **S.noise_flags(name, address)})
    return rows.drop("_n", "_a")


def rows_pivot(rows: DataFrame) -> DataFrame:
    """Rows by split and source, a column for each country, 0 where there is none."""
    return rows.groupBy("split", "src").pivot("country").count().na.fill(0)


def script_shares(rows: DataFrame, column: str) -> DataFrame:
    """split, src, country, script, n and its percentage of the group, to one decimal."""
    keys = ["split", "src", "country"]
    counted = rows.groupBy(*keys, F.col(column).alias("script")).agg(F.count("*").alias("n"))
    return counted.withColumn("pct", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy(*keys)), 1))


def rates(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Percentage of rows with each flag, to one decimal, by split, source and country."""
    return rows.groupBy("split", "src", "country").agg(*[F.round(100 * F.avg(F.col(c).cast("int")), 1).alias(c) for c in columns])


def characters(rows: DataFrame) -> DataFrame:
    """split, ch, n of every character of names and addresses; counted before anything else touches them."""
    text = F.concat("business_name", F.lit(" "), "business_address")
    return rows.select("split", F.explode(F.split(text, "")).alias("ch")).groupBy("split", "ch").agg(F.count("*").alias("n"))


def scripts_seen(rows: DataFrame) -> DataFrame:
    """script and n_chars over all letters and marks, most frequent first."""
    table = S.script_table(rows.sparkSession)
    return characters(rows).join(table, "ch").groupBy("script").agg(F.sum("n").alias("n_chars")).orderBy(F.desc("n_chars"), "script")


def non_ascii(rows: DataFrame) -> DataFrame:
    return characters(rows).where(F.ascii("ch") > 127)


def only_in_test(rows: DataFrame, column: Column) -> DataFrame:
    """Values of ``column`` in test rows that no train row has."""
    values = rows.select("split", column.alias("value")).distinct()
    return values.where("split = 'test'").select("value").join(values.where("split = 'train'").select("value"), "value", "left_anti")


def shift(rows: DataFrame, top: int = 40) -> DataFrame:
    """kind, value, n of what test has and train has not: countries, scripts of names and addresses, non-ASCII characters."""
    countries = only_in_test(rows, F.col("country")).select(F.lit("country").alias("kind"), "value", F.lit(None).cast("bigint").alias("n"))
    out = countries
    for column in ("name_script", "addr_script"):
        new = only_in_test(rows, F.explode(F.split(column, r"\+"))).where("value <> '(none)'")
        out = out.unionByName(new.select(F.lit(column).alias("kind"), "value", F.lit(None).cast("bigint").alias("n")))
    chars = non_ascii(rows)
    new = chars.where("split = 'test'").join(chars.where("split = 'train'").select("ch"), "ch", "left_anti").orderBy(F.desc("n"), "ch").limit(top)
    return out.unionByName(new.select(F.lit("char").alias("kind"), F.col("ch").alias("value"), "n"))


def match_sizes(s1: DataFrame, truth: DataFrame) -> DataFrame:
    """source1_entity_id, n matches, n2 and n3 of either source; S1 records without matches have 0."""
    n = truth.distinct().groupBy("source1_entity_id").agg(F.count("*").alias("n"), F.count_if(F.startswith("match_id", F.lit("S2-"))).alias("n2"), F.count_if(F.startswith("match_id", F.lit("S3-"))).alias("n3"))
    return s1.select(F.col("entity_id").alias("source1_entity_id")).join(n, "source1_entity_id", "left").na.fill(0)


def size_histogram(s1: DataFrame, truth: DataFrame, top: int = 12) -> DataFrame:
    return match_sizes(s1, truth).groupBy(F.col("n").alias("matches")).agg(F.count("*").alias("entities")).orderBy("matches").limit(top)


def truth_structure(records: DataFrame, truth: DataFrame) -> DataFrame:
    """One row: entities, singleton share, shares with matches in either source, owners, orphans and cross-country pairs."""
    sizes = match_sizes(records.where("src = 'S1'"), truth).agg(F.count("*").alias("s1_entities"), (100 * F.avg((F.col("n") == 0).cast("int"))).alias("singleton_pct"), (100 * F.avg((F.col("n2") > 0).cast("int"))).alias("with_s2_pct"), (100 * F.avg((F.col("n3") > 0).cast("int"))).alias("with_s3_pct"))
    owners = truth.distinct().groupBy("match_id").agg(F.count("*").alias("o")).agg(F.count("*").alias("matched_ids"), F.count_if(F.col("o") > 1).alias("multi_owner_ids"))
    lone = orphans(records, truth).select("entity_id", F.lit(1).alias("lone"))
    rest = records.where("src <> 'S1'").join(lone, "entity_id", "left").agg((100 * F.avg(F.when(F.col("src") == "S2", F.coalesce("lone", F.lit(0))))).alias("s2_orphan_pct"), (100 * F.avg(F.when(F.col("src") == "S3", F.coalesce("lone", F.lit(0))))).alias("s3_orphan_pct"))
    pairs = attributed(records, truth).agg((100 * F.avg((F.col("a_country") != F.col("b_country")).cast("int"))).alias("cross_country_pct"))
    out = sizes
    for one_row in (owners, rest, pairs):
        out = out.join(F.broadcast(one_row))  # one row each
    return out


def attributed(records: DataFrame, truth: DataFrame) -> DataFrame:
    """True pairs with country and scripts of both ends; pairs with unknown ids are left out."""
    held = [c for c in ("country", "name_script", "addr_script") if c in records.columns]
    one = records.select(F.col("entity_id").alias("source1_entity_id"), *[F.col(c).alias(f"a_{c}") for c in held])
    other = records.select(F.col("entity_id").alias("match_id"), *[F.col(c).alias(f"b_{c}") for c in held])
    return truth.join(one, "source1_entity_id").join(other, "match_id")


def pair_scripts(records: DataFrame, truth: DataFrame, column: str) -> DataFrame:
    """Source of the match, coarse script of S1 and of the match, n."""
    rows = attributed(records, truth)
    return rows.groupBy(F.left("match_id", F.lit(2)).alias("src"), S.coarse(F.col(f"a_{column}")).alias("s1_script"), S.coarse(F.col(f"b_{column}")).alias("match_script")).agg(F.count("*").alias("n"))


def orphans(records: DataFrame, truth: DataFrame) -> DataFrame:
    """S2 and S3 records that match no S1."""
    return records.where("src <> 'S1'").join(truth.select(F.col("match_id").alias("entity_id")).distinct(), "entity_id", "left_anti")


def formatted() -> Column:
    return F.concat_ws(" | ", "entity_id", "business_name", "business_address", "country")


def group_samples(records: DataFrame, truth: DataFrame, n: int = 6, seed: int = 1, india: str = "India", us: str = "US") -> DataFrame:
    """stratum, rank, entity_id and text of sampled groups: A native matches, B Latin matches, C another country, D singletons, E orphans."""
    native = records.select(F.col("entity_id").alias("match_id"), F.col("business_name").rlike("[ऀ-ൿ]").alias("native"))
    has = truth.join(native, "match_id", "left").groupBy("source1_entity_id").agg(F.bool_or(F.coalesce("native", F.lit(False))).alias("has_native"))
    s1 = records.where("src = 'S1'")
    rows = s1.withColumnRenamed("entity_id", "source1_entity_id").join(match_sizes(s1, truth), "source1_entity_id").join(has, "source1_entity_id", "left").na.fill(False, ["has_native"]).withColumnRenamed("source1_entity_id", "entity_id")
    stratum = F.when((F.col("country") == india) & F.col("has_native") & (F.col("n") > 0), "A").when((F.col("country") == india) & ~F.col("has_native") & (F.col("n") > 1), "B").when((F.col("country") == us) & (F.col("n") > 1), "C").when(F.col("n") == 0, "D")
    picked = rows.select(stratum.alias("stratum"), "entity_id", formatted().alias("text")).where("stratum is not null")
    picked = picked.unionByName(orphans(records, truth).select(F.lit("E").alias("stratum"), "entity_id", formatted().alias("text")))
    order = Window.partitionBy("stratum").orderBy(F.md5(F.concat(F.lit(f"{seed}:"), "entity_id")), "entity_id")
    return picked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= F.when(F.col("stratum") == "E", 2 * n).otherwise(n))

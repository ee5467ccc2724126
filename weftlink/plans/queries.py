"""Registered queries of record linkage and profiling, each with its DuckDB twin where SQL can say it.

Records come out of ``documents`` (see sources.adapter); arrays and maps are joined to strings, and doubles
rounded, so that results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import similarity as SIM
from ..functions import text as X
from ..operators import blocking as B
from ..operators import features as FE
from ..operators import coded, matcher, metrics, paired, translit, validate
from ..operators import names as names_of
from ..operators.normalise import blocking_keys, normalise, squashed_names
from ..sources.adapter import records, truth
from . import census
from . import oracle as O

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def bar(x: Column | str, by: str = "|") -> Column:
    return F.array_join(x, by)


def sorted_bar(x: Column | str) -> Column:
    return F.array_join(F.sort_array(x), "|")


def yes(x: Column | str) -> Column:
    return (F.col(x) if isinstance(x, str) else x).cast("int")


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(spark, sf_dir).select("entity_id", F.col("business_name").alias("x"))


R = O.RECORDS
NORM = (R, O.NORM)
BLK = (R, O.NORM, O.BLOCK)
FOUND = (*BLK, O.POSTINGS, O.FOUND)
RANKED = (*FOUND, O.RANK)
FOUND_TFIDF = (*BLK, O.POSTINGS, O.TFIDF, O.FOUND_TFIDF)
PAIRS = (R, ",\n", O.TRUTH, O.NORM, O.BLOCK, O.POSTINGS, O.FOUND, O.RANK, O.PAIRS)
VAL = (*PAIRS, O.PROB)


# Scans -------------------------------------------------------------------------------------------------


@query(O.sql(R, "SELECT entity_id, src, split, entity_id || ' | ' || business_name || ' | ' || business_address || ' | ' || country AS record FROM records"))
def scan_records(spark, sf_dir):
    return records(spark, sf_dir).select("entity_id", "src", "split", census.formatted().alias("record"))


@query(O.sql(R, ",\n", O.TRUTH, "SELECT entity_id, business_name FROM records WHERE entity_id IN (SELECT match_id FROM truth)"))
def filtered_scan(spark, sf_dir):
    wanted = truth(spark, sf_dir).select(F.col("match_id").alias("entity_id")).distinct()
    return records(spark, sf_dir).join(wanted, "entity_id", "left_semi").select("entity_id", "business_name")


@query(O.sql(R, ",\n", O.TRUTH, "SELECT r.entity_id AS source1_entity_id, coalesce(string_agg(t.match_id, ',' ORDER BY t.match_id), '') AS ids, count(t.match_id) AS n FROM records r LEFT JOIN truth t ON t.source1_entity_id = r.entity_id WHERE r.src = 'S1' GROUP BY 1"))
def truth_parse(spark, sf_dir):
    """Ground-truth lists as they lie in a file, with blanks and empty items, parsed again."""
    from ..sources.records import id_list

    lists = truth(spark, sf_dir).groupBy("source1_entity_id").agg(F.concat(F.lit(" ,"), F.array_join(F.collect_list("match_id"), " , "), F.lit(",")).alias("raw"))
    s1 = records(spark, sf_dir).where("src = 'S1'").select(F.col("entity_id").alias("source1_entity_id"))
    rows = s1.join(lists, "source1_entity_id", "left").withColumn("l", F.sort_array(id_list(F.coalesce("raw", F.lit("")))))
    return rows.select("source1_entity_id", bar("l", ",").alias("ids"), F.size("l").cast("long").alias("n"))


# Text primitives ---------------------------------------------------------------------------------------


@query(O.sql(R, f"SELECT entity_id, {O.junk('business_name')} AS out FROM records"))
def strip_junk(spark, sf_dir):
    return names(spark, sf_dir).select("entity_id", X.strip_leading_junk(F.col("x")).alias("out"))


def _marked() -> Column:
    """A name with a marker in the middle, for every second record."""
    return F.when(F.crc32("entity_id") % 2 < 2, F.concat(F.left("x", F.lit(8)), F.lit(" (ID: k-7) "), F.substring("x", 9, 2**31 - 1), F.lit(" [Co]")))


_MARKED = "left(business_name, 8) || ' (ID: k-7) ' || substring(business_name, 9) || ' [Co]'"


@query(O.sql(R, f"SELECT entity_id, {O.marker(_MARKED)} AS marker, {O.no_marker(_MARKED)} AS rest FROM records"))
def paren_id(spark, sf_dir):
    return names(spark, sf_dir).withColumn("m", _marked()).select("entity_id", X.id_marker(F.col("m")).alias("marker"), X.without_id_marker(F.col("m")).alias("rest"))


_SITE = "split_part(url, '//', 2) || CASE WHEN page_id % 2 = 0 THEN ' - 5550001234' ELSE '' END"


@query(f"SELECT page_id, {O.core('x')} AS core, ({O.domain('x')})::INT AS is_domain, ({O.phone('x')})::INT AS has_phone FROM (SELECT page_id, {_SITE} AS x FROM pages)")
def domain_phone(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    x = F.concat(F.split_part("url", F.lit("//"), F.lit(2)), F.when(F.col("page_id") % 2 == 0, " - 5550001234").otherwise(""))
    return pages.select("page_id", x.alias("x")).select("page_id", X.domain_core(F.col("x")).alias("core"), yes(X.is_domain_like(F.col("x"))).alias("is_domain"), yes(X.has_trailing_phone(F.col("x"))).alias("has_phone"))


_AKA = "left(business_name, 20) || ' d/b/a ' || substring(business_name, 21) || ', formerly ' || country"


@query(O.sql(R, f"SELECT entity_id, array_to_string(p, '|') AS parts, len(p) AS n FROM (SELECT entity_id, {O.alias('x')} AS p FROM (SELECT entity_id, {_AKA} AS x FROM records))"))
def alias_split(spark, sf_dir):
    x = F.concat(F.left("business_name", F.lit(20)), F.lit(" d/b/a "), F.substring("business_name", 21, 2**31 - 1), F.lit(", formerly "), "country")
    rows = records(spark, sf_dir).select("entity_id", x.alias("x")).withColumn("p", X.alias_parts(F.col("x")))
    return rows.select("entity_id", bar("p").alias("parts"), F.size("p").cast("long").alias("n"))


@query(O.sql(R, f"SELECT entity_id, {O.no_brackets(_MARKED + " || '(a) {b}'")} AS out FROM records"))
def bracket_noise(spark, sf_dir):
    rows = names(spark, sf_dir).withColumn("m", F.concat(_marked(), F.lit("(a) {b}")))
    return rows.select("entity_id", X.without_brackets(F.col("m")).alias("out"))


@query(O.sql(R, f"SELECT entity_id, strip_accents(business_name) AS folded, {O.casefold('business_name')} AS cased FROM records"))
def fold_case(spark, sf_dir):
    return names(spark, sf_dir).select("entity_id", X.fold_accents("x").alias("folded"), X.casefold("x").alias("cased"))


_TWICE = "split_part(business_name, ' ', 1) || ' ' || lower(split_part(business_name, ' ', 1)) || ' ' || business_name"


@query(O.sql(R, f", pc AS (SELECT entity_id, regexp_extract_all(strip_accents({_TWICE}), '{O.W}+|{O.NW}+') AS p FROM records)", f"SELECT entity_id, array_to_string(list_filter(p, lambda w, i: NOT {O._DUP}), '') AS out FROM pc"))
def collapse_duplicates(spark, sf_dir):
    first = F.split_part("x", F.lit(" "), F.lit(1))
    rows = names(spark, sf_dir).withColumn("t", X.fold_accents(F.concat(first, F.lit(" "), F.lower(first), F.lit(" "), "x")))
    return rows.select("entity_id", X.collapse_duplicates(F.col("t")).alias("out"))


@query("SELECT doc_id, regexp_replace(lower(text), '[^a-z0-9]', '', 'g') AS out FROM documents")
def squash(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", X.squash(F.lower("text")).alias("out"))


_LEGAL = "lower(c_name) || CASE WHEN c_custkey % 3 = 0 THEN ' pvt. ltd.' WHEN c_custkey % 3 = 1 THEN ' co, works' ELSE '' END"


@query(f"SELECT c_custkey, {O.legal('x')} AS out FROM (SELECT c_custkey, {_LEGAL} AS x FROM customer UNION ALL SELECT -1, 'limited company')")
def no_suffix(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", F.concat(F.lower("c_name"), F.when(F.col("c_custkey") % 3 == 0, " pvt. ltd.").when(F.col("c_custkey") % 3 == 1, " co, works").otherwise("")).alias("x"))
    rows = rows.unionByName(spark.createDataFrame([(-1, "limited company")], "c_custkey bigint, x string"))
    return rows.select("c_custkey", X.without_legal_words(F.col("x")).alias("out"))


@query(O.sql(*NORM, "SELECT entity_id, array_to_string(folded, '|') AS folded, array_to_string(squashed, '|') AS squashed, array_to_string(no_suffix, '|') AS no_suffix, is_domain::INT AS is_domain_like, had_phone::INT AS had_phone_suffix, had_alias::INT AS had_alias_marker FROM norm"))
def clean_name(spark, sf_dir):
    rows = normalise(records(spark, sf_dir))
    return rows.select("entity_id", bar("folded").alias("folded"), bar("squashed").alias("squashed"), bar("no_suffix").alias("no_suffix"), yes("is_domain_like").alias("is_domain_like"), yes("had_phone_suffix").alias("had_phone_suffix"), yes("had_alias_marker").alias("had_alias_marker"))


@query(O.sql(*NORM, "SELECT entity_id, addr, array_to_string(numbers, '|') AS numbers, array_to_string(list_sort(words), '|') AS words, addr_empty::INT AS is_empty, had_null::INT AS had_null_token, had_hash::INT AS had_hash, had_id::INT AS had_id_marker FROM norm"))
def clean_address(spark, sf_dir):
    rows = normalise(records(spark, sf_dir))
    return rows.select("entity_id", "addr", bar("addr_numbers").alias("numbers"), sorted_bar("addr_words").alias("words"), yes("addr_is_empty").alias("is_empty"), yes("had_null_token").alias("had_null_token"), yes("had_hash").alias("had_hash"), yes("had_id_marker").alias("had_id_marker"))


@query("SELECT doc_id, array_to_string(list_sort(list_distinct(regexp_extract_all(text, '[a-z]{2,}'))), '|') AS words FROM documents")
def word_bag(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", sorted_bar(X.word_bag(F.col("text"))).alias("words"))


@query("SELECT doc_id, array_to_string(regexp_extract_all(text, '\\d+'), '|') AS numbers FROM documents")
def numeric_tokens(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", bar(X.numeric_tokens(F.col("text"))).alias("numbers"))


@query("SELECT doc_id, array_to_string(list_transform(list_filter(n, lambda x: length(x) >= 3), lambda x: right(x, 4)), '|') AS num_keys, array_to_string(list_filter(n, lambda x: length(x) >= 5), '|') AS pin_keys FROM (SELECT doc_id, regexp_extract_all(text, '\\d+') AS n FROM documents)")
def number_keys(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", X.numeric_tokens(F.col("text")).alias("n"))
    return rows.select("doc_id", bar(X.number_keys(F.col("n"))).alias("num_keys"), bar(X.pin_keys(F.col("n"))).alias("pin_keys"))


@query(f"SELECT s_suppkey, array_to_string({O.ngrams('s', 4)}, '|') AS grams FROM (SELECT s_suppkey, CASE WHEN s_suppkey % 7 = 0 THEN left(lower(s_name), 3) ELSE lower(s_name) END AS s FROM supplier)")
def char_ngrams(spark, sf_dir):
    s = F.when(F.col("s_suppkey") % 7 == 0, F.left(F.lower("s_name"), F.lit(3))).otherwise(F.lower("s_name"))
    return spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey", s.alias("s")).select("s_suppkey", bar(X.char_ngrams(F.col("s"), 4)).alias("grams"))


@query(f"SELECT s_suppkey, array_to_string(list_concat({O.ngrams('s', 3)}, {O.ngrams('s', 4)}), '|') AS grams FROM (SELECT s_suppkey, ' ' || lower(s_name) || ' ' AS s FROM supplier)")
def char_wb_ngrams(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey", bar(X.char_wb_ngrams(F.lower("s_name"))).alias("grams"))


@query(O.sql(*NORM, "SELECT entity_id, array_to_string(list_sort(toks[1]), '|') AS toks FROM norm"))
def name_tokens(spark, sf_dir):
    return normalise(records(spark, sf_dir)).select("entity_id", sorted_bar(F.col("name_tokens")[0]).alias("toks"))


@query(O.sql(R, f"SELECT entity_id, {', '.join(f'({e})::INT AS {n}' for n, e in O.FLAGS.items())} FROM records"))
def noise_flags(spark, sf_dir):
    from ..functions.scripts import noise_flags as flags

    return records(spark, sf_dir).select("entity_id", *[yes(c).alias(n) for n, c in flags(F.col("business_name"), F.col("business_address")).items()])


@query(O.sql(R, f"SELECT entity_id, {O.script('business_name')} AS name_script, {O.script('business_address')} AS addr_script, {', '.join(f'({e})::INT AS {n}' for n, e in O.MIX.items())} FROM records"))
def script_profile(spark, sf_dir):
    return census.enriched(records(spark, sf_dir)).select("entity_id", "name_script", "addr_script", *[yes(c).alias(c) for c in census.MIX])


# Frequencies, keys, candidates --------------------------------------------------------------------------


_KEPT: list[DataFrame] = []


def kept(rows: DataFrame) -> DataFrame:
    """Normalised rows are read by many branches of a query: compute them once, and let go of those of earlier queries."""
    while len(_KEPT) > 7:
        _KEPT.pop(0).unpersist()
    _KEPT.append(rows.persist(StorageLevel.MEMORY_AND_DISK))
    return rows


def blocked(spark, sf_dir) -> DataFrame:
    return kept(blocking_keys(records(spark, sf_dir)))


def normalised(spark, sf_dir) -> DataFrame:
    return kept(normalise(records(spark, sf_dir)))


@query(O.sql(*BLK, f"SELECT 'name' AS family, * FROM ({O.frequency('name_tokens')}) UNION ALL SELECT 'ngram', * FROM ({O.frequency('name_ngrams')}) UNION ALL SELECT 'addr', * FROM ({O.frequency('addr_tokens')})"))
def doc_freq(spark, sf_dir):
    rows = blocked(spark, sf_dir)
    out = None
    for family, column in (("name", "name_tokens"), ("ngram", "name_ngrams"), ("addr", "addr_tokens")):
        one = B.document_frequency(rows, column).select(F.lit(family).alias("family"), "*")
        out = one if out is None else out.unionByName(one)
    return out


@query(O.sql(*BLK, f"SELECT 'name' AS family, entity_id, tok, n FROM ({O.rarest('name_tokens', 3)}) UNION ALL SELECT 'ngram', entity_id, tok, n FROM ({O.rarest('name_ngrams', 2)})"))
def rarest_k(spark, sf_dir):
    rows = blocked(spark, sf_dir)
    name, gram = B.rarest(rows, "name_tokens", 3), B.rarest(rows, "name_ngrams", 2)
    return name.select(F.lit("name").alias("family"), "entity_id", "tok", "n").unionByName(gram.select(F.lit("ngram").alias("family"), "entity_id", "tok", "n"))


@query("""WITH p AS (SELECT p_brand AS country, 'S2' AS src, 'word' AS family, unnest(string_split(p_name, ' ')) AS key, p_partkey::VARCHAR AS entity_id FROM part)
SELECT DISTINCT country, src, family, key, entity_id FROM p JOIN (SELECT country, key FROM p GROUP BY ALL HAVING count(*) <= 20) USING (country, key)""")
def posting_cap(spark, sf_dir):
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    index = part.select(F.col("p_brand").alias("country"), F.lit("S2").alias("src"), F.lit("word").alias("family"), F.explode(F.split("p_name", " ")).alias("key"), F.col("p_partkey").cast("string").alias("entity_id"))
    return B.capped(index, 20)


@query(O.sql(*FOUND, "SELECT s1, country, src, cand FROM (SELECT *, row_number() OVER (PARTITION BY s1 ORDER BY src, cand) AS rn FROM (SELECT DISTINCT s1, country, src, cand FROM found WHERE family = 'squash')) WHERE rn <= 50"))
def block_squash_topk(spark, sf_dir):
    rows = blocked(spark, sf_dir)
    found = B.hits(rows.where("src = 'S1'"), rows.where("src <> 'S1'")).where(F.col("bit") == B.BIT["squash"])
    best = B.ranked(B.agreements(found).withColumn("score", F.lit(0.0)))
    return best.select("s1", "country", "src", "cand")


def flat_candidates(rows: DataFrame) -> DataFrame:
    def families(c: str) -> Column:
        return F.array_join(F.transform(F.sort_array(F.map_entries(c)), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")

    return rows.select("source1_entity_id", "country", bar("candidate_entity_ids", ",").alias("candidates"), bar(F.col("candidate_agreement").cast("array<string>"), ",").alias("agreements"), F.col("n_before_prune").cast("long").alias("n_before_prune"), families("by_key_s2").alias("by_key_s2"), families("by_key_s3").alias("by_key_s3"))


def candidates_of(spark, sf_dir, tfidf_k: int = 0) -> DataFrame:
    every, near = records(spark, sf_dir), None
    if tfidf_k:
        named = kept(squashed_names(every))
        near = names_of.tfidf_topk(named.where("src = 'S1'"), named.where("src <> 'S1'"), tfidf_k)
    found = coded.candidates(kept(coded.coded(every)), every.where("src = 'S1'"), kept, near=near)
    if found is not None:
        return found
    rows = blocked(spark, sf_dir)
    return B.candidates(rows.where("src = 'S1'"), rows.where("src <> 'S1'"), tfidf_k=tfidf_k, keep=kept)


@query(O.sql(*RANKED, O.CANDIDATES))
def block_candidates(spark, sf_dir):
    return flat_candidates(candidates_of(spark, sf_dir))


@query(O.sql(*BLK, O.TFIDF, "SELECT s1, country, src, cand, score FROM tf"))
def tfidf_topk(spark, sf_dir):
    rows = kept(squashed_names(records(spark, sf_dir)))
    return names_of.tfidf_topk(rows.where("src = 'S1'"), rows.where("src <> 'S1'")).select("s1", "country", "src", "cand", "score")


@query(O.sql(*FOUND_TFIDF, O.RANK, O.CANDIDATES))
def block_candidates_tfidf(spark, sf_dir):
    return flat_candidates(candidates_of(spark, sf_dir, B.TFIDF_K))


@query(O.sql(*RANKED, """, sz AS (SELECT r.entity_id, coalesce(m.n, 0) AS before_prune, coalesce(k.n, 0) AS after_prune FROM records r LEFT JOIN (SELECT s1, count(*) AS n FROM masks GROUP BY 1) m ON m.s1 = r.entity_id LEFT JOIN (SELECT s1, count(*) AS n FROM rk GROUP BY 1) k ON k.s1 = r.entity_id WHERE r.src = 'S1')""", """SELECT measure, round(avg(n), 6) AS mean, median(n)::DOUBLE AS median, round(quantile_cont(n, 0.95), 6) AS p95, round(avg((n = 0)::INT), 6) AS zero_share
FROM (SELECT 'before_prune' AS measure, before_prune AS n FROM sz UNION ALL SELECT 'after_prune', after_prune FROM sz) GROUP BY 1"""))
def candidate_volume_stats(spark, sf_dir):
    return metrics.volume(candidates_of(spark, sf_dir)).select("measure", F.round("mean", 6).alias("mean"), F.col("median").cast("double").alias("median"), F.round("p95", 6).alias("p95"), F.round("zero_share", 6).alias("zero_share"))


@query(O.sql(*PAIRS, """, pr AS (SELECT r.entity_id, (SELECT count(*) FROM truth t WHERE t.source1_entity_id = r.entity_id) AS nt, coalesce(sum(p.label), 0) AS hit, count(p.label) AS nc FROM records r LEFT JOIN pairs p ON p.source1_entity_id = r.entity_id WHERE r.src = 'S1' GROUP BY ALL)""", """SELECT round(avg(hit / nt) FILTER (nt > 0), 6) AS macro_recall, round((sum(hit) FILTER (nt > 0))::DOUBLE / sum(nt), 6) AS micro_recall, round(avg((hit < nt)::INT) FILTER (nt > 0), 6) AS share_below_one,
  round(avg((nc > 0)::INT) FILTER (nt = 0), 6) AS singletons_with_candidates, count(*) FILTER (nt > 0) AS n_with_truth, count(*) FILTER (nt = 0) AS n_singletons FROM pr"""))
def recall_report(spark, sf_dir):
    rows = metrics.recall(kept(candidates_of(spark, sf_dir)), truth(spark, sf_dir))  # read three times
    return rows.select(*[F.round(c, 6).alias(c) for c in ("macro_recall", "micro_recall", "share_below_one", "singletons_with_candidates")], "n_with_truth", "n_singletons")


# Pairs, features, metrics -------------------------------------------------------------------------------


def pairs_of(spark, sf_dir, detailed: bool = False) -> DataFrame:
    """Labelled pairs; with prob where the candidates were found by codes.  ``detailed`` if features are made of them."""
    rows = kept(coded.coded(records(spark, sf_dir), detailed))
    found = coded.best_pairs(rows, kept)
    if found is None:
        return FE.labelled(FE.exploded(candidates_of(spark, sf_dir)), truth(spark, sf_dir))
    pairs = found[0].select(F.col("s1").alias("source1_entity_id"), F.col("cand").alias("candidate_entity_id"), F.col("agreement").cast("bigint").alias("agreement_count"), "prob", "addr_jaccard")
    out = FE.labelled(pairs, truth(spark, sf_dir))
    if detailed:
        out = kept(out)
        out._weftlink_coded = rows
    return out


def features_of(pairs: DataFrame, spark, sf_dir, fuzzy: bool = True) -> DataFrame:
    """Features of labelled pairs: by blocks where these were found by codes, else from joined records."""
    rows = getattr(pairs, "_weftlink_coded", None)
    made = paired.features(pairs, rows, kept, fuzzy) if rows is not None else None
    return FE.features(pairs.drop("prob", "addr_jaccard"), normalised(spark, sf_dir), fuzzy) if made is None else made


@query(O.sql(*PAIRS, "SELECT source1_entity_id, candidate_entity_id, agreement_count, label::INT AS label FROM pairs"))
def explode_label(spark, sf_dir):
    return pairs_of(spark, sf_dir).select("source1_entity_id", "candidate_entity_id", F.col("agreement_count").cast("long").alias("agreement_count"), F.col("label").cast("int").alias("label"))


@query(O.sql(R, """, ids AS (SELECT DISTINCT entity_id AS source1_entity_id, row_number() OVER (ORDER BY md5('1:' || entity_id), entity_id) AS rn FROM records WHERE src = 'S1')""", "SELECT source1_entity_id, (rn <= floor((SELECT count(*) FROM ids) * 0.2))::INT AS is_val FROM ids"))
def entity_split(spark, sf_dir):
    s1 = records(spark, sf_dir).where("src = 'S1'").select(F.col("entity_id").alias("source1_entity_id"))
    return matcher.entity_split(s1).select("source1_entity_id", yes("is_val").alias("is_val"))


@query(O.sql(R, "SELECT entity_id FROM (SELECT entity_id, row_number() OVER (ORDER BY md5('1:' || entity_id), entity_id) AS rn FROM records WHERE src = 'S1') WHERE rn <= 100"))
def sample_s1(spark, sf_dir):
    return B.sample(records(spark, sf_dir).where("src = 'S1'"), 100).select("entity_id")


@query(O.sql(*NORM, ", tk AS (SELECT DISTINCT entity_id, unnest(flatten(toks)) AS tok FROM norm)", "SELECT tok, count(*) AS df, round(ln(1 + (SELECT count(*) FROM norm)::DOUBLE / (1 + count(*))), 6) AS idf FROM tk GROUP BY 1"))
def idf_table(spark, sf_dir):
    return FE.idf_table(normalise(records(spark, sf_dir))).select("tok", "df", F.round("idf", 6).alias("idf"))


_BEST_JAC = f"(SELECT max({O._jac('x.t', 'y.t')}) FROM (SELECT unnest(l.toks) AS t) x, (SELECT unnest(r.toks) AS t) y)"
_SUFFIX = """CASE WHEN len(a) = 0 OR len(b) = 0 THEN 0 ELSE len(list_filter(CASE WHEN len(a) <= len(b) THEN a ELSE b END, lambda x: length(x) >= 2 AND len(list_filter(CASE WHEN len(a) <= len(b) THEN b ELSE a END, lambda y: length(y) >= 2 AND (ends_with(x, y) OR ends_with(y, x)))) > 0))::DOUBLE / least(len(a), len(b)) END"""


@query(O.sql(*PAIRS, f""", ref AS (SELECT * FROM norm WHERE entity_id IN (SELECT source1_entity_id FROM pairs UNION SELECT candidate_entity_id FROM pairs)),
tk AS (SELECT DISTINCT entity_id, unnest(flatten(toks)) AS tok FROM ref), idft AS (SELECT tok, ln(1 + (SELECT count(*) FROM ref)::DOUBLE / (1 + count(*))) AS idf FROM tk GROUP BY 1),
lv AS (SELECT entity_id, unnest(toks) AS t, length(unnest(squashed)) AS n FROM ref),
best AS (SELECT source1_entity_id, candidate_entity_id, max({O._jac('x.t', 'y.t')}) AS jac, max(coalesce(least(x.n, y.n)::DOUBLE / nullif(greatest(x.n, y.n), 0), 0)) AS lr FROM pairs JOIN lv x ON x.entity_id = source1_entity_id JOIN lv y ON y.entity_id = candidate_entity_id GROUP BY ALL),
sh AS (SELECT source1_entity_id, candidate_entity_id, sum(idf) AS s FROM pairs JOIN tk x ON x.entity_id = source1_entity_id JOIN tk y ON y.entity_id = candidate_entity_id AND y.tok = x.tok JOIN idft ON idft.tok = x.tok GROUP BY ALL)""",
f"""SELECT p.source1_entity_id, p.candidate_entity_id, p.label::INT AS label, p.agreement_count::DOUBLE AS agreement_count, round(best.jac, 6) AS name_jaccard, round(best.lr, 6) AS name_len_ratio, round(coalesce(sh.s, 0), 6) AS idf_shared_name,
  round({O._jac('l.words', 'r.words')}, 6) AS addr_jaccard, round((SELECT {_SUFFIX} FROM (SELECT l.numbers AS a, r.numbers AS b)), 6) AS addr_numeric_suffix_overlap, round(coalesce(least(len(l.words), len(r.words))::DOUBLE / nullif(greatest(len(l.words), len(r.words)), 0), 0), 6) AS addr_len_ratio,
  (l.is_domain OR r.is_domain)::INT::DOUBLE AS either_domain_like, (l.had_alias OR r.had_alias)::INT::DOUBLE AS either_alias_marker, (l.had_phone OR r.had_phone)::INT::DOUBLE AS either_phone_suffix, (l.addr_empty OR r.addr_empty)::INT::DOUBLE AS either_addr_empty, 0.0::DOUBLE AS native_script_mismatch
FROM pairs p JOIN norm l ON l.entity_id = p.source1_entity_id JOIN norm r ON r.entity_id = p.candidate_entity_id LEFT JOIN best USING (source1_entity_id, candidate_entity_id) LEFT JOIN sh USING (source1_entity_id, candidate_entity_id)"""))
def pair_features_builtin(spark, sf_dir):
    rows = features_of(pairs_of(spark, sf_dir, True), spark, sf_dir, fuzzy=False)
    held = [f for f in FE.FEATURES if f not in FE.FUZZY]
    return rows.select("source1_entity_id", "candidate_entity_id", F.col("label").cast("int").alias("label"), *[F.round(c, 6).alias(c) for c in held])


@query(f"SELECT k, round({_SUFFIX}, 6) AS overlap FROM (SELECT c.c_custkey AS k, [c.c_custkey::VARCHAR, c.c_nationkey::VARCHAR] AS a, [s.s_suppkey::VARCHAR, right(c.c_custkey::VARCHAR, 2), '7'] AS b FROM customer c JOIN supplier s ON s.s_suppkey = (SELECT min(s_suppkey) FROM supplier) + c.c_custkey % (SELECT count(*) FROM supplier))")
def numeric_suffix_overlap(spark, sf_dir):
    c, s = spark.read.parquet(f"{sf_dir}/customer.parquet"), spark.read.parquet(f"{sf_dir}/supplier.parquet")
    first, n = s.agg(F.min("s_suppkey"), F.count("*")).first()  # every supplier has its turn
    rows = c.join(s, s.s_suppkey == F.lit(first) + c.c_custkey % F.lit(n))
    a, b = F.array(F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string")), F.array(F.col("s_suppkey").cast("string"), F.right(F.col("c_custkey").cast("string"), F.lit(2)), F.lit("7"))
    return rows.select(F.col("c_custkey").alias("k"), a.alias("a"), b.alias("b")).select("k", F.round(SIM.numeric_suffix_overlap(F.col("a"), F.col("b")), 6).alias("overlap"))


@query("SELECT a.p_partkey AS a, b.p_partkey AS b, round(jaro_winkler_similarity(a.p_name, b.p_name), 6) AS jw FROM part a JOIN part b ON a.p_brand = b.p_brand AND a.p_size = b.p_size AND a.p_partkey < b.p_partkey")
def jaro_winkler(spark, sf_dir):
    """Names are compared once in each group, however many parts bear them; their parts are paired in the JVM."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    a = part.select(F.col("p_partkey").alias("a"), "p_brand", "p_size", F.col("p_name").alias("x"))
    b = part.select(F.col("p_partkey").alias("b"), "p_brand", "p_size", F.col("p_name").alias("y"))
    names = a.select("p_brand", "p_size", "x").distinct().join(b.select("p_brand", "p_size", "y").distinct(), ["p_brand", "p_size"])
    met = names.select(F.col("x").alias("one"), F.col("y").alias("two")).distinct().withColumn("jw", F.round(SIM.best_jaro_winkler(F.array("one"), F.array("two")), 6))
    scored = names.join(met, F.col("x").eqNullSafe(F.col("one")) & F.col("y").eqNullSafe(F.col("two"))).select("p_brand", "p_size", F.col("x").alias("one"), F.col("y").alias("two"), "jw")
    left = a.join(scored, ["p_brand", "p_size"]).where(F.col("x").eqNullSafe(F.col("one"))).select("a", "p_brand", "p_size", "two", "jw")
    return left.join(b, ["p_brand", "p_size"]).where(F.col("two").eqNullSafe(F.col("y")) & (F.col("a") < F.col("b"))).select("a", "b", "jw")


@query()
def pair_features_fuzzy(spark, sf_dir):
    rows = features_of(pairs_of(spark, sf_dir, True), spark, sf_dir)
    return rows.select("source1_entity_id", "candidate_entity_id", *FE.FUZZY)


def val_pairs(spark, sf_dir) -> DataFrame:
    """Labelled pairs with a deterministic stand-in for the classifier's probability."""
    pairs = pairs_of(spark, sf_dir)
    if "prob" in pairs.columns:  # scored with the candidates: words do not travel with each pair
        return pairs.select("source1_entity_id", "candidate_entity_id", "label", F.round("prob", 6).alias("prob"))
    rows = normalised(spark, sf_dir).select("entity_id", F.col("name_tokens")[0].alias("t"), F.col("addr_words").alias("w"))
    left, right = rows.toDF("source1_entity_id", "lt", "lw"), rows.toDF("candidate_entity_id", "rt", "rw")
    joined = pairs.join(left, "source1_entity_id").join(right, "candidate_entity_id")
    prob = F.round(0.5 * SIM.jaccard(F.col("lt"), F.col("rt")) + 0.5 * SIM.jaccard(F.col("lw"), F.col("rw")), 6)
    return joined.select("source1_entity_id", "candidate_entity_id", "label", prob.alias("prob"))


@query(O.sql(*VAL, "SELECT source1_entity_id, candidate_entity_id, prob FROM (SELECT *, row_number() OVER (PARTITION BY candidate_entity_id ORDER BY prob DESC, source1_entity_id) AS rn FROM val WHERE prob >= 0.05) WHERE rn = 1"))
def owner_exclusive(spark, sf_dir):
    return matcher.matches(val_pairs(spark, sf_dir), 0.05, True)


_SWEPT = "SELECT threshold, owner_exclusive, round(f, 6) AS macro_f05, n_s1 FROM swept"


def rounded(rows: DataFrame) -> DataFrame:
    return rows.select("threshold", "owner_exclusive", F.round("macro_f05", 6).alias("macro_f05"), F.col("n_s1").cast("long").alias("n_s1"))


@query(O.sql(*VAL, O.sweep(O.CANDIDATE_SCOPE), _SWEPT))
def macro_f05_candidate_scope(spark, sf_dir):
    return rounded(metrics.sweep(kept(val_pairs(spark, sf_dir))))  # read twice


@query(O.sql(*VAL, O.sweep(O.FULL_SCOPE), _SWEPT))
def macro_f05_full(spark, sf_dir):
    s1 = records(spark, sf_dir).where("src = 'S1'").select(F.col("entity_id").alias("source1_entity_id"))
    return rounded(metrics.sweep(val_pairs(spark, sf_dir), s1, truth(spark, sf_dir)))


@query(O.sql(*VAL, O.sweep(O.CANDIDATE_SCOPE), _SWEPT + " ORDER BY round(f, 9) DESC, owner_exclusive DESC, threshold LIMIT 1"))
def threshold_sweep(spark, sf_dir):
    swept = metrics.sweep(kept(val_pairs(spark, sf_dir))).withColumn("macro_f05", F.round("macro_f05", 9))
    return rounded(metrics.best(swept))


@query()
def gbt_scores(spark, sf_dir):
    """Probabilities of the validation pairs under the boosted model."""
    pairs = pairs_of(spark, sf_dir, True)
    rows = features_of(pairs, spark, sf_dir).join(matcher.entity_split(pairs), "source1_entity_id")
    rows = kept(rows)
    model = matcher.train(rows)
    return matcher.scored(model, rows.where("is_val")).select("source1_entity_id", "candidate_entity_id", "label", "prob")


# Dictionary mining --------------------------------------------------------------------------------------

_MINE = r"""mined AS (SELECT n, l, count(*) AS c FROM (SELECT unnest(a) AS n, unnest(b) AS l FROM (SELECT string_split(x.p_name, ' ') AS a, string_split(y.p_name, ' ') AS b FROM part x JOIN part y ON y.p_partkey = x.p_partkey + 1 WHERE x.p_partkey % 2 = 1) WHERE len(a) = len(b)) GROUP BY ALL),
dict AS (SELECT n AS native, l AS latin FROM (SELECT *, row_number() OVER (PARTITION BY n ORDER BY c DESC, l) AS rn, sum(c) OVER (PARTITION BY n) AS total FROM mined) WHERE rn = 1 AND total >= 3)"""


def mined(spark, sf_dir) -> DataFrame:
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    a = part.where("p_partkey % 2 = 1").select((F.col("p_partkey") + 1).alias("k"), F.split("p_name", " ").alias("native_words"))
    b = part.select(F.col("p_partkey").alias("k"), F.split("p_name", " ").alias("latin"))
    rows = a.join(b, "k").withColumn("status", F.when(F.size("native_words") == F.size("latin"), "aligned").otherwise("mismatch"))
    return translit.dictionary(translit.counts(rows))


@query(f"WITH {_MINE} SELECT native, latin FROM dict")
def translit_mine(spark, sf_dir):
    """The mining rules on aligned words of neighbouring parts."""
    return mined(spark, sf_dir)


@query(f"WITH {_MINE}, w AS (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w, generate_subscripts(string_split(p_name, ' '), 1) AS i FROM part) SELECT p_partkey::VARCHAR AS entity_id, string_agg('क' || coalesce(latin, w), ' ' ORDER BY i) AS latin_name FROM w LEFT JOIN dict ON native = w GROUP BY 1")
def latinize(spark, sf_dir):
    """Dictionary look-up by word; a native letter before each word makes the names native."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    mark = lambda c: F.concat(F.lit("क"), c)
    dictionary = mined(spark, sf_dir).select(mark(F.col("native")).alias("native"), mark(F.col("latin")).alias("latin"))
    rows = part.select(F.col("p_partkey").cast("string").alias("entity_id"), F.array_join(F.transform(F.split("p_name", " "), mark), " ").alias("business_name"))
    return translit.latinised(rows, dictionary).select("entity_id", "latin_name")


# Reports ------------------------------------------------------------------------------------------------

_COUNTRIES = ["de", "en", "es", "fr"]


@query(O.sql(R, f"SELECT split, src, {', '.join(f"count(*) FILTER (country = '{c}') AS {c}" for c in _COUNTRIES)} FROM records GROUP BY ALL"))
def rows_pivot(spark, sf_dir):
    return census.rows_pivot(records(spark, sf_dir))


@query(O.sql(R, f"SELECT *, round(100.0 * n / sum(n) OVER (PARTITION BY split, src, country), 1) AS pct FROM (SELECT split, src, country, {O.script('business_name')} AS script, count(*) AS n FROM records GROUP BY ALL)"))
def script_crosstab(spark, sf_dir):
    return census.script_shares(census.enriched(records(spark, sf_dir)), "name_script")


@query(O.sql(R, O.rates(O.FLAGS)))
def flag_rates(spark, sf_dir):
    return census.rates(census.enriched(records(spark, sf_dir)), census.FLAGS)


@query(O.sql(R, O.rates(O.MIX)))
def script_mix_rates(spark, sf_dir):
    return census.rates(census.enriched(records(spark, sf_dir)), census.MIX)


@query(O.sql(R, O.CHARS, f"SELECT 'Latin' AS script, sum(n)::BIGINT AS n_chars FROM chars WHERE regexp_matches(ch, '{O.LATIN}')"))
def char_census(spark, sf_dir):
    return census.scripts_seen(records(spark, sf_dir))


@query(O.sql(R, O.CHARS, "SELECT split, ch, n FROM chars WHERE unicode(ch) > 127"))
def nonascii_census(spark, sf_dir):
    return census.non_ascii(records(spark, sf_dir))


_SHIFTED = R.replace("doc_id % 2 = 0", "doc_id % 3 <> 0 AND lang <> 'es'")


@query(O.sql(_SHIFTED, O.CHARS, """SELECT 'country' AS kind, country AS value, NULL::BIGINT AS n FROM (SELECT DISTINCT country FROM records WHERE split = 'test' EXCEPT SELECT country FROM records WHERE split = 'train')
UNION ALL SELECT 'char', ch, n FROM (SELECT ch, n FROM chars WHERE split = 'test' AND unicode(ch) > 127 AND ch NOT IN (SELECT ch FROM chars WHERE split = 'train') ORDER BY n DESC, ch LIMIT 40)"""))
def train_test_shift(spark, sf_dir):
    """Shift between documents of two kinds: a split that leaves a language out of train."""
    rows = records(spark, sf_dir).withColumn("split", F.when((F.col("src") != "S1") & (F.col("country") != "es"), "train").otherwise("test"))
    return census.shift(census.enriched(rows))


@query(O.sql(R, ",\n", O.TRUTH, """, sz AS (SELECT r.entity_id, count(t.match_id) AS n, count(t.match_id) FILTER (t.match_id LIKE 'S2-%') AS n2, count(t.match_id) FILTER (t.match_id LIKE 'S3-%') AS n3 FROM records r LEFT JOIN truth t ON t.source1_entity_id = r.entity_id WHERE r.src = 'S1' GROUP BY 1),
ow AS (SELECT match_id, count(*) AS o FROM truth GROUP BY 1), orph AS (SELECT src, (entity_id NOT IN (SELECT match_id FROM truth))::INT AS lone FROM records WHERE src <> 'S1')""", """SELECT (SELECT count(*) FROM sz) AS s1_entities, round((SELECT 100 * avg((n = 0)::INT) FROM sz), 6) AS singleton_pct, round((SELECT 100 * avg((n2 > 0)::INT) FROM sz), 6) AS with_s2_pct, round((SELECT 100 * avg((n3 > 0)::INT) FROM sz), 6) AS with_s3_pct,
  (SELECT count(*) FROM ow) AS matched_ids, (SELECT count(*) FROM ow WHERE o > 1) AS multi_owner_ids, round((SELECT 100 * avg(lone) FROM orph WHERE src = 'S2'), 6) AS s2_orphan_pct, round((SELECT 100 * avg(lone) FROM orph WHERE src = 'S3'), 6) AS s3_orphan_pct,
  round((SELECT 100 * avg((a.country <> b.country)::INT) FROM truth JOIN records a ON a.entity_id = source1_entity_id JOIN records b ON b.entity_id = match_id), 6) AS cross_country_pct"""))
def gt_structure(spark, sf_dir):
    rows = census.truth_structure(records(spark, sf_dir), truth(spark, sf_dir))
    return rows.select(*[F.round(c, 6).alias(c) if c.endswith("_pct") else c for c in rows.columns])


@query(O.sql(R, ",\n", O.TRUTH, "SELECT n AS matches, count(*) AS entities FROM (SELECT r.entity_id, count(t.match_id) AS n FROM records r LEFT JOIN truth t ON t.source1_entity_id = r.entity_id WHERE r.src = 'S1' GROUP BY 1) GROUP BY 1 ORDER BY 1 LIMIT 12"))
def match_histogram(spark, sf_dir):
    return census.size_histogram(records(spark, sf_dir).where("src = 'S1'"), truth(spark, sf_dir))


@query(O.sql(R, ",\n", O.TRUTH, f", sr AS (SELECT entity_id, {O.script('business_name')} AS s FROM records)", "SELECT left(match_id, 2) AS src, a.s AS s1_script, b.s AS match_script, count(*) AS n FROM truth JOIN sr a ON a.entity_id = source1_entity_id JOIN sr b ON b.entity_id = match_id GROUP BY ALL"))
def gt_pair_scripts(spark, sf_dir):
    return census.pair_scripts(census.enriched(records(spark, sf_dir)), truth(spark, sf_dir), "name_script")


@query(O.sql(R, ",\n", O.TRUTH, "SELECT entity_id, business_name FROM records WHERE src <> 'S1' AND entity_id NOT IN (SELECT match_id FROM truth)"))
def orphans(spark, sf_dir):
    return census.orphans(records(spark, sf_dir), truth(spark, sf_dir)).select("entity_id", "business_name")


@query(O.sql(R, ",\n", O.TRUTH, """, sz AS (SELECT r.entity_id, r.country, count(t.match_id) AS n FROM records r LEFT JOIN truth t ON t.source1_entity_id = r.entity_id WHERE r.src = 'S1' GROUP BY ALL),
pk AS (SELECT CASE WHEN country = 'fr' AND n > 1 THEN 'B' WHEN country = 'en' AND n > 1 THEN 'C' WHEN n = 0 THEN 'D' END AS stratum, entity_id FROM sz UNION ALL SELECT 'E', entity_id FROM records WHERE src <> 'S1' AND entity_id NOT IN (SELECT match_id FROM truth))""", """SELECT stratum, rank, entity_id, entity_id || ' | ' || business_name || ' | ' || business_address || ' | ' || country AS text FROM (SELECT stratum, entity_id, row_number() OVER (PARTITION BY stratum ORDER BY md5('1:' || entity_id), entity_id)::INT AS rank FROM pk WHERE stratum IS NOT NULL) JOIN records USING (entity_id) WHERE rank <= CASE WHEN stratum = 'E' THEN 12 ELSE 6 END"""))
def group_samples(spark, sf_dir):
    return census.group_samples(records(spark, sf_dir), truth(spark, sf_dir), india="fr", us="en").select("stratum", "rank", "entity_id", "text")


# Validation ---------------------------------------------------------------------------------------------

_RESULTS = """res AS MATERIALIZED (SELECT o_orderkey AS line, 'S1-' || (o_custkey % 1200) AS s1, CASE WHEN o_orderkey % 50 = 0 THEN ['S2-1', 'S2-1'] WHEN o_orderkey % 51 = 0 THEN ['S1-3'] WHEN o_orderkey % 53 = 0 THEN ['X9', 'S3-99999'] ELSE ['S2-' || (o_custkey % 90 + 1), 'S3-7'] END AS ids, o_orderkey % 97 <> 0 AS has_tab FROM orders),
need AS (SELECT 'S1-' || c_custkey AS s1 FROM customer), valid AS (SELECT 'S2-' || s_suppkey AS id FROM supplier UNION SELECT 'S3-7'), ls AS (SELECT * FROM res WHERE has_tab), ea AS (SELECT s1, unnest(ids) AS id FROM ls)"""


@query(f"""WITH {_RESULTS} SELECT 'row_without_tab' AS rule, 'error' AS level, '' AS s1, '' AS id, line::VARCHAR AS detail FROM res WHERE NOT has_tab
UNION ALL SELECT 'duplicate_s1', 'error', s1, '', count(*)::VARCHAR FROM ls GROUP BY s1 HAVING count(*) > 1
UNION ALL SELECT 'repeated_id', 'error', s1, '', '' FROM ls WHERE len(ids) <> len(list_distinct(ids))
UNION ALL SELECT DISTINCT 's1_in_list', 'error', s1, id, '' FROM ea WHERE id LIKE 'S1-%'
UNION ALL SELECT DISTINCT 'bad_prefix', 'error', s1, id, '' FROM ea WHERE NOT regexp_matches(id, '^S[123]-')
UNION ALL SELECT DISTINCT 'unknown_id', 'error', s1, id, '' FROM ea WHERE regexp_matches(id, '^S[23]-') AND id NOT IN (SELECT id FROM valid)
UNION ALL SELECT 'missing_s1', 'error', s1, '', '' FROM need WHERE s1 NOT IN (SELECT s1 FROM ls)
UNION ALL SELECT DISTINCT 'unexpected_s1', 'error', s1, '', '' FROM ls WHERE s1 NOT IN (SELECT s1 FROM need)""")
def validate_results(spark, sf_dir):
    o, c, s = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("orders", "customer", "supplier"))
    lit = lambda *x: F.array(*map(F.lit, x))
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    ids = F.when(key % 50 == 0, lit("S2-1", "S2-1")).when(key % 51 == 0, lit("S1-3")).when(key % 53 == 0, lit("X9", "S3-99999")).otherwise(F.array(F.concat(F.lit("S2-"), (cust % 90 + 1).cast("string")), F.lit("S3-7")))
    results = o.select(key.alias("line"), F.concat(F.lit("S1-"), (cust % 1200).cast("string")).alias("s1"), ids.alias("ids"), (key % 97 != 0).alias("has_tab"))
    required = c.select(F.concat(F.lit("S1-"), F.col("c_custkey").cast("string")).alias("entity_id"))
    valid = s.select(F.concat(F.lit("S2-"), F.col("s_suppkey").cast("string")).alias("entity_id")).unionByName(spark.createDataFrame([("S3-7",)], "entity_id string"))
    return validate.violations(results, required, valid)


@query(f"""WITH {_RESULTS}, last AS (SELECT DISTINCT s1, unnest(ids) AS id FROM (SELECT s1, arg_max(ids, line) AS ids FROM ls GROUP BY 1)), cd AS (SELECT DISTINCT s1, id FROM ea WHERE id LIKE 'S2-%')
SELECT 'match_not_candidate' AS rule, 'warning' AS level, s1, id, '' AS detail FROM last WHERE (s1, id) NOT IN (SELECT (s1, id) FROM cd)""")
def validate_subset(spark, sf_dir):
    """Matches that are not among candidates; the candidates here are the S2 ids of each S1's rows."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    lit = lambda *x: F.array(*map(F.lit, x))
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    ids = F.when(key % 50 == 0, lit("S2-1", "S2-1")).when(key % 51 == 0, lit("S1-3")).when(key % 53 == 0, lit("X9", "S3-99999")).otherwise(F.array(F.concat(F.lit("S2-"), (cust % 90 + 1).cast("string")), F.lit("S3-7")))
    results = o.select(key.alias("line"), F.concat(F.lit("S1-"), (cust % 1200).cast("string")).alias("s1"), ids.alias("ids"), (key % 97 != 0).alias("has_tab"))
    every = results.where("has_tab").groupBy("s1").agg(F.flatten(F.collect_list("ids")).alias("ids")).select(F.lit(2).cast("long").alias("line"), "s1", F.filter("ids", lambda i: F.startswith(i, F.lit("S2-"))).alias("ids"), F.lit(True).alias("has_tab"))
    return validate.not_subset(results, every)


@query(O.sql(R, ",\n", O.TRUTH, "SELECT r.entity_id AS source1_entity_id, coalesce(string_agg(DISTINCT t.match_id, ',' ORDER BY t.match_id), '') AS matched_entity_ids FROM records r LEFT JOIN truth t ON t.source1_entity_id = r.entity_id WHERE r.src = 'S1' GROUP BY 1"))
def result_rows(spark, sf_dir):
    from ..sources.sinks import result_rows as rows

    s1 = records(spark, sf_dir).where("src = 'S1'").select(F.col("entity_id").alias("source1_entity_id"))
    return rows(s1, truth(spark, sf_dir).withColumnRenamed("match_id", "candidate_entity_id"), "matched_entity_ids")

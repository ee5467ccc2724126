"""Candidate generation: capped inverted-index joins, TF-IDF retrieval, agreement ranking and top-k.

Country is part of every join key.  Keys are one long table, so all families are
one join; agreement is a bit per family, summed by partial aggregation.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import char_wb_ngrams
from ..workers import ship

FAMILIES = ["squash", "rare_name", "rare_ngram", "addr_num", "addr_pin", "rare_addr", "tfidf"]
BIT = {f: 1 << i for i, f in enumerate(FAMILIES)}
RARE_K, RARE_K_NGRAM, CAP, TOP_K, TFIDF_K = 3, 2, 300, 50, 50
#: Records of one side that a task scores together, and candidates of a record that it scores at once.
BLOCK, STEP = 32_768, 1_024


def document_frequency(rows: DataFrame, column: str) -> DataFrame:
    """country, src, tok, n: how often each token occurs; repeats inside an array count."""
    return rows.select("country", "src", F.explode(column).alias("tok")).groupBy("country", "src", "tok").agg(F.count("*").alias("n"))


def rarest(rows: DataFrame, column: str, k: int) -> DataFrame:
    """country, src, entity_id, tok, n: the k rarest distinct tokens of each record; ties go to the smaller token."""
    own = rows.select("country", "src", "entity_id", F.explode(F.array_distinct(column)).alias("tok"))
    ranked = own.join(document_frequency(rows, column), ["country", "src", "tok"])
    order = Window.partitionBy("entity_id").orderBy("n", "tok")
    return ranked.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= k).drop("rn")


def postings(rows: DataFrame, rare_k: int = RARE_K, rare_k_ngram: int = RARE_K_NGRAM) -> DataFrame:
    """country, src, family, key, entity_id of the index side, repeats included."""
    def listed(family: str, keys: Column) -> DataFrame:
        return rows.select("country", "src", F.lit(family).alias("family"), F.explode(keys).alias("key"), "entity_id")

    out = listed("squash", F.filter(F.array("squash", "squash_alt"), lambda x: x != ""))
    out = out.unionByName(listed("addr_num", F.col("addr_num_keys"))).unionByName(listed("addr_pin", F.col("addr_pin_keys")))
    for family, column, k in (("rare_name", "name_tokens", rare_k), ("rare_ngram", "name_ngrams", rare_k_ngram), ("rare_addr", "addr_tokens", rare_k)):
        out = out.unionByName(rarest(rows, column, k).select("country", "src", F.lit(family).alias("family"), F.col("tok").alias("key"), "entity_id"))
    return out


def capped(index: DataFrame, cap: int = CAP) -> DataFrame:
    """Distinct postings of the keys with at most ``cap`` postings, repeats counted."""
    held = index.groupBy("country", "src", "family", "key").agg(F.count("*").alias("n")).where(F.col("n") <= cap).drop("n")
    return index.join(held, ["country", "src", "family", "key"], "left_semi").distinct()


def probes(rows: DataFrame) -> DataFrame:
    """country, family, key, s1 of the probing side: all its keys."""
    keys = {"squash": F.filter(F.array("squash", "squash_alt"), lambda x: x != ""), "rare_name": F.col("name_tokens"), "rare_ngram": F.col("name_ngrams"), "addr_num": F.col("addr_num_keys"), "addr_pin": F.col("addr_pin_keys"), "rare_addr": F.col("addr_tokens")}

    def tagged_with(family: str):
        return lambda key: F.struct(F.lit(family).alias("family"), key.alias("key"))

    tagged = F.concat(*[F.transform(F.array_distinct(c), tagged_with(f)) for f, c in keys.items()])
    return rows.select("country", F.col("entity_id").alias("s1"), F.explode(tagged).alias("k")).select("country", "k.family", "k.key", "s1")


def hits(s1: DataFrame, others: DataFrame, cap: int = CAP, rare_k: int = RARE_K, rare_k_ngram: int = RARE_K_NGRAM, keep: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """s1, country, src, cand, bit: every family in which a candidate is found.

    Postings are read twice, to count and to filter; ``keep`` may persist them.
    """
    index = capped(keep(postings(others, rare_k, rare_k_ngram)), cap)
    bit = F.create_map(*[x for f, b in BIT.items() for x in (F.lit(f), F.lit(b))])
    found = probes(s1).join(index, ["country", "family", "key"])
    return found.select("s1", "country", "src", F.col("entity_id").alias("cand"), bit[F.col("family")].alias("bit"))


def tfidf_weights(others: DataFrame, s1: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(country, gram, src, cand, w) of the corpus and (country, gram, s1, w) of the queries: smoothed idf, unit length."""
    def grams(rows: DataFrame) -> DataFrame:
        return rows.select("country", "src", "entity_id", F.explode(char_wb_ngrams(F.col("squash"))).alias("gram")).groupBy("country", "src", "entity_id", "gram").agg(F.count("*").alias("tf"))

    corpus = grams(others)
    size = others.groupBy("country").agg(F.count("*").alias("docs"))
    idf = corpus.groupBy("country", "gram").agg(F.count("*").alias("df")).join(size, "country").select("country", "gram", (F.log((1 + F.col("docs")) / (1 + F.col("df"))) + 1).alias("idf"))

    def weighted(rows: DataFrame) -> DataFrame:
        raw = rows.join(idf, ["country", "gram"]).withColumn("x", F.col("tf") * F.col("idf"))
        norm = raw.groupBy("entity_id").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
        return raw.join(norm, "entity_id").select("country", "gram", "src", "entity_id", (F.col("x") / F.col("norm")).alias("w"))

    return weighted(corpus).withColumnRenamed("entity_id", "cand"), weighted(grams(s1)).drop("src").withColumnRenamed("entity_id", "s1")


def tfidf_topk(s1: DataFrame, others: DataFrame, k: int = TFIDF_K) -> DataFrame:
    """s1, country, src, cand, score: the k most similar squashed names, S2 and S3 in one list."""
    corpus, queries = tfidf_weights(others, s1)
    scored = queries.withColumnRenamed("w", "q").join(corpus, ["country", "gram"]).groupBy("s1", "country", "src", "cand").agg(F.round(F.sum(F.col("w") * F.col("q")), 6).alias("score")).where("score > 0")
    order = Window.partitionBy("s1").orderBy(F.desc("score"), "cand")
    return scored.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= k).drop("rn")


def agreements(found: DataFrame) -> DataFrame:
    """s1, country, src, cand, mask, agreement: one row for each candidate; map-side partial aggregation."""
    masks = found.groupBy("s1", "country", "src", "cand").agg(F.bit_or("bit").alias("mask"))
    return masks.withColumn("agreement", F.bit_count("mask"))


def coarse_scores(pairs: DataFrame, s1: DataFrame, others: DataFrame) -> DataFrame:
    """``pairs`` with score: half the Jaccard similarity of names and half of addresses.

    Words of S1 that no S2 or S3 record of the country has, in name or address, are left out.
    """
    vocabulary = others.select("country", F.explode(F.array_union("name_tokens", "addr_tokens")).alias("tok")).distinct()

    def known(column: str) -> DataFrame:
        rows = s1.select("country", "entity_id", F.explode(column).alias("tok")).join(vocabulary, ["country", "tok"], "left_semi")
        return rows.groupBy("entity_id").agg(F.collect_set("tok").alias(f"s1_{column}"))

    hashed = lambda c: F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda w: F.xxhash64(w))
    left = s1.select("entity_id").join(known("name_tokens"), "entity_id", "left").join(known("addr_tokens"), "entity_id", "left")
    left = left.select(F.col("entity_id").alias("s1"), *[hashed(F.col(f"s1_{c}")).alias(c) for c in ("name_tokens", "addr_tokens")])
    right = others.select(F.col("entity_id").alias("cand"), *[hashed(F.col(c)).alias(c) for c in ("name_tokens", "addr_tokens")])
    # Words travel once for each block of the other side, not once for each pair.
    rows, columns = max(2, -(-s1.count() // BLOCK)), max(4, -(-others.count() // BLOCK))
    row, column = F.pmod(F.xxhash64("s1"), F.lit(rows)), F.pmod(F.xxhash64("cand"), F.lit(columns))
    lists = pairs.groupBy("s1", column.alias("column")).agg(F.collect_list(F.struct(*[F.col(c) for c in pairs.columns])).alias("pairs"))
    left = lists.join(left, "s1").select((row * columns + F.col("column")).alias("cell"), "pairs", "name_tokens", "addr_tokens")
    right = right.withColumn("cell", F.explode(F.transform(F.sequence(F.lit(0), F.lit(rows - 1)), lambda r: r * columns + column)))
    ship()
    inner = pairs.schema.simpleString()
    scores = left.groupBy("cell").cogroup(right.groupBy("cell")).applyInArrow(_cell_scores, f"pairs array<{inner}>, scores array<double>")
    zipped = scores.select(F.explode(F.arrays_zip("pairs", "scores")).alias("z")).where("z.scores IS NOT NULL")
    return zipped.select("z.pairs.*", F.col("z.scores").alias("score"))


def _lists(table: pa.Table, name: str) -> tuple[pa.Array, np.ndarray]:
    """The items of a column of lists in one array, and where each list begins, with the end."""
    whole = table[name].combine_chunks()
    if isinstance(whole, pa.ChunkedArray):
        whole = pa.concat_arrays(whole.chunks)
    return whole.flatten(), np.concatenate([[0], np.cumsum(pc.list_value_length(whole).to_numpy(zero_copy_only=False))]).astype(np.int64)


def _cell_scores(left: pa.Table, right: pa.Table) -> pa.Table:
    """Lists of pairs as they came, with the scores of each list; null for a candidate that has no record."""
    pairs, first = _lists(left, "pairs")
    names, fields = [f.name for f in pairs.type], pairs.flatten()
    at = pc.fill_null(pc.index_in(fields[names.index("cand")], value_set=right["cand"].combine_chunks()), -1).to_numpy(zero_copy_only=False)
    score = np.zeros(len(at))
    for name in ("name_tokens", "addr_tokens"):
        (mine, begin), (theirs, start) = _lists(left, name), _lists(right, name)
        words, ids = np.unique(theirs.to_numpy(zero_copy_only=False), return_inverse=True)
        mine, sizes, seen = mine.to_numpy(zero_copy_only=False), np.diff(start), np.zeros(len(words), bool)
        place = np.searchsorted(words, mine)
        shared = place < len(words)
        shared[shared] = words[place[shared]] == mine[shared]
        for i in range(left.num_rows):
            own = slice(begin[i], begin[i + 1])
            marked = place[own][shared[own]]
            seen[marked] = True
            for k in range(first[i], first[i + 1], STEP):
                found = k + np.flatnonzero(at[k : min(k + STEP, first[i + 1])] >= 0)
                n = sizes[at[found]]
                ends = np.cumsum(n)
                hits = seen[ids[np.repeat(start[at[found]] - ends + n, n) + np.arange(n.sum())]]
                total = np.concatenate([[0], np.cumsum(hits)])
                both = total[ends] - total[ends - n]
                union = (begin[i + 1] - begin[i]) + n - both
                score[found] += 0.5 * np.divide(both, union, out=np.zeros(len(n)), where=union > 0)
            seen[marked] = False
    ends = pa.array(first, pa.int32())
    scores = pa.array(score, pa.float64(), mask=at < 0)
    return pa.table({"pairs": pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(fields, names)), "scores": pa.ListArray.from_arrays(ends, scores)})


def ranked(pairs: DataFrame, k: int = TOP_K) -> DataFrame:
    """The k best candidates of each S1 with their rank: agreement, then score, then S2 before S3, then id."""
    order = Window.partitionBy("s1").orderBy(F.desc("agreement"), F.desc(F.round("score", 9)), "src", "cand")
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def by_family(masks: DataFrame, src: str) -> Column:
    """Map of families to the distinct candidates of one source found by them; families without any are left out."""
    counts = [F.struct(F.lit(f).alias("key"), F.sum(F.when((F.col("src") == src) & (F.col("mask").bitwiseAND(b) > 0), 1).otherwise(0)).alias("value")) for f, b in BIT.items()]
    return F.map_from_entries(F.filter(F.array(*counts), lambda e: e["value"] > 0))


def candidates(s1: DataFrame, others: DataFrame, top_k: int = TOP_K, tfidf_k: int = TFIDF_K, cap: int = CAP, rare_k: int = RARE_K, rare_k_ngram: int = RARE_K_NGRAM, keep: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """One row for each S1 record: its ranked candidates and agreements, the size of the raw union and hits by family.

    An S1 record without candidates has empty lists.  ``tfidf_k`` of 0 leaves TF-IDF out.
    Candidates are read twice, to be ranked and to be counted; ``keep`` may persist them, as the postings.
    """
    found = hits(s1, others, cap, rare_k, rare_k_ngram, keep)
    if tfidf_k:
        from .names import tfidf_topk as retrieved

        found = found.unionByName(retrieved(s1, others, tfidf_k).select("s1", "country", "src", "cand", F.lit(BIT["tfidf"]).alias("bit")))
    masks = keep(agreements(found))
    best = ranked(coarse_scores(masks, s1, others), top_k)
    lists = best.groupBy("s1").agg(F.sort_array(F.collect_list(F.struct("rank", "cand", "agreement"))).alias("best"))
    volume = masks.groupBy("s1").agg(F.count("*").alias("n"), by_family(masks, "S2").alias("k2"), by_family(masks, "S3").alias("k3"))
    none, empty = F.array().cast("array<string>"), F.create_map().cast("map<string,bigint>")
    rows = s1.select(F.col("entity_id").alias("s1"), "country").join(lists, "s1", "left").join(volume, "s1", "left")
    return rows.select(
        F.col("s1").alias("source1_entity_id"), "country",
        F.coalesce(F.col("best.cand"), none).alias("candidate_entity_ids"),
        F.coalesce(F.transform("best", lambda b: b["agreement"].cast("bigint")), F.array().cast("array<bigint>")).alias("candidate_agreement"),
        F.coalesce("n", F.lit(0)).alias("n_before_prune"),
        F.coalesce(F.col("k2").cast("map<string,bigint>"), empty).alias("by_key_s2"), F.coalesce(F.col("k3").cast("map<string,bigint>"), empty).alias("by_key_s3"),
    )


def sample(s1: DataFrame, n: int, seed: int = 1) -> DataFrame:
    """n records without replacement in the order of a seeded hash; 0 keeps all."""
    if not n:
        return s1
    return s1.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), "entity_id")), "entity_id").limit(n)

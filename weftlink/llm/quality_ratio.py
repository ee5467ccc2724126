"""Quality rules: base counts and a hashed n-gram log-likelihood ratio, in DataFrame functions only.

Words and word pairs are hashed into ``BUCKETS`` by Murmur3.  Two smoothed multinomials
over the buckets, one of the trusted documents (good quality, not toxic by their labels) and
one of all documents, give each bucket a log ratio; a document's score is the mean ratio of its
n-grams.  Trusted documents whose crc32(id as text) mod ``SPLIT`` is 0 are left out of the trusted
multinomial; the threshold is a quantile of their scores, on a grid of thousandths, so it holds for
trusted text that was not learned.  Every document is held against it: no random draws.

Everything about one document is computed inside its row from arrays; what is
shuffled are bucket counts and grid counts, whose sizes are fixed.  Repeated
windows are found by sorting packed values (hash above, position below); where
two different windows agree in the hash's upper bits, that row takes the exact
comparison of strings instead, so results never hang on a hash.

Defined cases: a null text has no words, lines or symbols and fails; texts are
read whole; where none of the documents left out has a word, all trusted ones set the
threshold; without trusted documents the ratio judges nothing and the base rules decide; repeated rows are judged one by one; labels that repeat must all trust.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

BUCKETS = 1 << 14
QUANTILE = 0.005
SPLIT = 5
LEAST_WORDS = 50
BROADCAST_IDS = 1_000_000
_SPACE = r"[\x20\x09-\x0D]+"
#: Bits of a packed window that hold its position.
_BITS = 24


def with_words(docs: DataFrame) -> DataFrame:
    return docs.withColumn("words", F.array_remove(F.split(F.coalesce("text", F.lit("")), _SPACE), ""))


def repeated_words() -> Column:
    """Words of ``words`` inside 3-word windows that occur twice or more; reads ``neighbours``, the sorted packed windows whose hash another one has."""
    high = lambda x: f"shiftright({x}, {_BITS})"
    low = lambda x: f"cast({x} & {(1 << _BITS) - 1} as int)"
    covered = "aggregate(sort_array(%s), named_struct('n', 0L, 'last', -3), (a, p) -> named_struct('n', a.n + least(3, p - a.last), 'last', p)).n"
    fast = covered % f"transform(neighbours, x -> {low('x')})"
    same = " and ".join(f"get(words, {low('x')} + {k}) <=> get(words, {low('get(neighbours, i - 1)')} + {k})" for k in range(3))
    clash = f"size(words) > {1 << _BITS} or exists(transform(neighbours, (x, i) -> i > 0 and {high('x')} = {high('get(neighbours, i - 1)')} and not ({same})), b -> b)"
    spelled = "sort_array(transform(sequence(0, size(words) - 3), i -> named_struct('w', concat_ws(' ', get(words, i), get(words, i + 1), get(words, i + 2)), 'p', i)))"
    exact = covered % f"transform(filter(transform(array({spelled}), s -> transform(s, (x, i) -> named_struct('p', x.p, 'twice', coalesce(x.w = get(s, i - 1).w, false) or coalesce(x.w = get(s, i + 1).w, false))))[0], x -> x.twice), x -> x.p)"
    return F.expr(f"case when size(words) < 3 then 0L when {clash} then {exact} else {fast} end")


def base(docs: DataFrame) -> DataFrame:
    """``docs`` with the base counts; ``words`` stays."""
    text = F.coalesce("text", F.lit(""))
    packed = f"case when size(words) < 3 then cast(array() as array<bigint>) else sort_array(transform(sequence(0, size(words) - 3), i -> shiftleft(shiftright(xxhash64(get(words, i), get(words, i + 1), get(words, i + 2)), {_BITS}), {_BITS}) | i)) end"
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.translate(x, " \t\n\x0b\x0c\r", "")) > 0)
    alike = " or ".join(f"shiftright(x ^ get(packed, i {k} 1), {_BITS}) = 0" for k in "-+")
    rows = with_words(docs).withColumns({"packed": F.expr(packed), "lines": lines}).withColumn("neighbours", F.expr(f"filter(packed, (x, i) -> {alike})"))
    return rows.withColumns({
        "n_words": F.size("words").cast("long"),
        "word_chars": F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long"),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        "n_repeat_words": repeated_words(),
    }).drop("packed", "neighbours", "lines")


def buckets() -> Column:
    """Buckets of all words and word pairs of ``words``."""
    one = f"transform(words, w -> hash(w) & {BUCKETS - 1})"
    two = f"transform(slice(words, 2, size(words)), (w, i) -> hash(get(words, i), w) & {BUCKETS - 1})"
    return F.expr(f"case when size(words) < 2 then {one} else concat({one}, {two}) end")


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids whose every label is of good quality and not toxic."""
    good = F.when((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0), 1).otherwise(0)
    return labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.min(good).alias("ok")).where("ok = 1").select("id")


def weights(docs: DataFrame, trusted: DataFrame) -> list[float]:
    """Log ratio of each bucket: a list of fixed length."""
    rows = with_words(docs.select("doc_id", "text")).join(trusted, F.col("doc_id") == F.col("id"), "left")
    counted = rows.select(F.col("id").isNotNull().cast("long").alias("good"), F.explode(buckets()).alias("b")).groupBy("b").agg(F.count("*").alias("raw"), F.sum("good").alias("target"))
    counted = stored(counted, "buckets")
    totals = counted.agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).first()
    raw, target = totals["raw"] or 0, totals["target"] or 0
    ratio = F.log((F.col("target") + 1) / F.lit(float(target + BUCKETS))) - F.log((F.col("raw") + 1) / F.lit(float(raw + BUCKETS)))
    unseen = ratio_of_none(raw, target)
    out = [unseen] * BUCKETS
    for r in counted.select("b", ratio.alias("w")).collect():  # BUCKETS rows at most
        out[r["b"]] = r["w"]
    return out


def ratio_of_none(raw: int, target: int) -> float:
    from math import log

    return log((raw + BUCKETS) / (target + BUCKETS))


def set_aside(doc_id: Column) -> Column:
    """Whether a trusted document sets the threshold instead of teaching the trusted multinomial."""
    return F.crc32(doc_id.cast("string").cast("binary")) % SPLIT == 0


def limit_of(scored: DataFrame, ids: DataFrame, few: bool) -> int | None:
    """The grid step at which the share QUANTILE of the scores of ``ids`` is reached; None without any score."""
    own = scored.join(F.broadcast(ids) if few else ids, F.col("doc_id") == F.col("id")).where("score is not null")
    steps = own.groupBy(F.floor(F.col("score") * 1000).alias("step")).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    upto = F.sum("n").over(Window.orderBy("step"))  # a row for each step of the grid
    return steps.select("step", total.alias("total"), upto.alias("upto")).where(F.col("upto") >= F.col("total") * QUANTILE).agg(F.min("step")).first()[0]


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_failed, score and kept of every document."""
    ids = stored(trusted_ids(labels), "trusted")
    few = ids.count() <= BROADCAST_IDS
    learned = ids.where(~set_aside(F.col("id")))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    table = F.from_json(F.lit(str(weights(docs, F.broadcast(learned) if few else learned))), "array<double>")
    rows = base(docs).withColumn("buckets", buckets()).withColumn("table_", table)
    scored = rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", F.expr("try_divide(aggregate(buckets, 0D, (s, b) -> s + get(table_, b)), size(buckets))").alias("score"))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    scored = stored(scored.withColumn("base_failed", failed), "scored")
    limit = limit_of(scored, ids.where(set_aside(F.col("id"))), few)
    if limit is None:
        limit = limit_of(scored, ids, few)
    good = F.lit(True) if limit is None else F.coalesce(F.floor(F.col("score") * 1000) >= limit, F.lit(False))
    return scored.withColumn("kept", ~F.col("base_failed") & good)

"""Quality classifier: perplexity under an interpolated modified Kneser-Ney n-gram model of trusted text.

The model is over characters (code points), order ``ORDER``: every n-gram of the trusted
texts is counted, without a vocabulary to cap.  Counts, continuation counts, count-of-count
discounts, context sums and interpolation all are shuffled joins and sums of tables that are sharded by
n-gram.  Each document gets its perplexity; a language's threshold is a quantile of the perplexities of
its trusted documents, and documents above it are rejected.  Trusted documents whose crc32(id as text) mod
``SPLIT`` is 0 are left out of the model and alone set the thresholds, so these hold for text that the
model has not seen; where none of them has a perplexity, all trusted documents set them.

Scoring.  While the model has at most ``BROADCAST_GRAMS`` rows it travels to the
tasks as an open-addressing table; beyond that the distinct n-grams of each
document are joined with the sharded tables (``scored_by_join``).  Both give the same sums.

Defined cases: a null or empty text has perplexity null and is rejected; a null
language is a language of its own; a language with fewer than ``LEAST_TRUSTED``
documents that set thresholds takes the threshold of all; without any trusted text nothing is
kept; repeated rows are judged one by one (labels that repeat count once).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import U64, discard, mixed, passes, prepare, runs, stored

ORDER = 5
QUANTILE = 0.99
SPLIT = 5
LEAST_TRUSTED = 20
BROADCAST_GRAMS = 2_500_000
BROADCAST_IDS = 1_000_000
#: Stands ORDER - 1 times before every text.
START = 2
_FACTOR = U64(0x9E3779B97F4A7C15)


def code_points(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts with ORDER - 1 start marks before each, and the offsets of the texts."""
    chars = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
    ends = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[at]
    pad = ORDER - 1
    out = np.full(len(chars) + pad * (len(at) - 1), START, dtype=np.uint32)
    sizes = np.diff(ends)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[np.arange(len(chars)) + pad * (row + 1)] = chars
    return out, ends + pad * np.arange(len(at))


def gram_hashes(chars: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n code points that end at each position from n - 1 on."""
    h = np.full(max(len(chars) - n + 1, 0), n, dtype=U64)
    for k in range(n):
        h = mixed(h * _FACTOR + chars[k : len(chars) - n + 1 + k].astype(U64))
    return h


def predicted(at: np.ndarray, length: int) -> np.ndarray:
    """Whether each position is predicted, not a start mark."""
    out = np.ones(length, dtype=bool)
    for k in range(ORDER - 1):
        out[at[:-1] + k] = False
    return out


def counts(texts: DataFrame) -> DataFrame:
    """gram (string of ORDER characters) and its count c."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, at in passes(batch.column(0), 4 << 20):
                chars, bounds = code_points(data, at)
                if len(chars) < ORDER:
                    continue
                h = gram_hashes(chars, ORDER)
                use = np.flatnonzero(predicted(bounds, len(chars))[ORDER - 1 :])
                order = use[np.argsort(h[use], kind="stable")]
                edges = runs(h[order])
                if not len(order):
                    continue
                first = order[edges[:-1]]
                grams = chars[first[:, None] + np.arange(ORDER)].astype("<u4")
                texts_ = grams.view(f"<U{ORDER}").reshape(-1).tolist()
                yield pa.RecordBatch.from_arrays([pa.array(texts_, pa.string()), pa.array(np.diff(edges))], ["gram", "c"])

    return texts.select("text").mapInArrow(run, "gram string, c long").groupBy("gram").agg(F.sum("c").alias("c"))


def discounts(table: DataFrame) -> list[float]:
    """Modified Kneser-Ney discounts for counts of 1, 2 and 3 or more; from the counts of counts."""
    n = {r["c"]: r["n"] for r in table.where("c <= 4").groupBy("c").agg(F.count("*").alias("n")).collect()}
    n1, n2, n3, n4 = (n.get(i, 0) for i in range(1, 5))
    if not n1 or not n2 or not n3:
        return [0.5, 0.75, 0.9]
    y = n1 / (n1 + 2 * n2)
    raw = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return [min(max(d, 0.05), 0.95 * (i + 1)) for i, d in enumerate(raw)]


def fit(texts: DataFrame) -> DataFrame:
    """The model: rows (gram, p, gamma) of every n-gram of orders 1 to ORDER.

    p is the interpolated probability of the gram's last character after the others; gamma is the share that the gram,
    as a context, leaves to the next lower order (null if it is never a context).  The empty gram holds p of an unseen character.
    """
    prepare(texts.sparkSession)
    tables = {ORDER: stored(counts(texts), "grams")}
    for n in range(ORDER - 1, 0, -1):  # continuation counts: distinct characters to the left
        tables[n] = stored(tables[n + 1].groupBy(F.substring("gram", 2, n).alias("gram")).agg(F.count("*").alias("c")), "grams")
    alphabet = tables[1].count()
    uniform = 1.0 / (alphabet + 1)
    lower, out, gammas = None, [], {}
    for n in range(1, ORDER + 1):
        d1, d2, d3 = discounts(tables[n])
        cut = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
        context = F.substring("gram", 1, n - 1)
        sums = tables[n].groupBy(context.alias("context")).agg(F.sum("c").alias("total"), F.sum(cut).alias("spare"))
        sums = sums.select("context", "total", (F.col("spare") / F.col("total")).alias("gamma"))
        joined = tables[n].withColumn("context", context).join(sums, "context")
        if n == 1:
            p = (F.col("c") - cut) / F.col("total") + F.col("gamma") * uniform
            level = joined.select("gram", p.alias("p"))
        else:
            below = lower.select(F.col("gram").alias("suffix"), F.col("p").alias("q"))
            level = joined.withColumn("suffix", F.substring("gram", 2, n - 1)).join(below, "suffix").select("gram", ((F.col("c") - cut) / F.col("total") + F.col("gamma") * F.col("q")).alias("p"))
        gammas[n - 1] = sums.select(F.col("context").alias("gram"), "gamma")
        lower = stored(level, "level")
        out.append(lower)
    rows = out[-1].withColumn("gamma", F.lit(None).cast("double"))
    for n in range(1, ORDER):
        own = gammas[n].withColumnRenamed("gram", "g")
        rows = rows.unionByName(out[n - 1].join(own, F.col("gram") == F.col("g"), "full").select(F.coalesce("gram", "g").alias("gram"), "p", "gamma"))
    empty = gammas[0].select("gram", (F.col("gamma") * uniform).alias("p"), "gamma")
    model = stored(rows.unionByName(empty), "model")
    discard(*tables.values(), *out)
    return model


class Table:
    """Open-addressing hash table from 64-bit hashes to two floats."""

    def __init__(self, hashes: np.ndarray, logp: np.ndarray, gamma: np.ndarray):
        bits = max(10, int(np.ceil(np.log2(max(len(hashes), 1) * 1.6))))
        self.shift, size = U64(64 - bits), 1 << bits
        self.slots, self.logp, self.gamma = np.zeros(size, dtype=U64), np.zeros(size, np.float32), np.zeros(size, np.float32)
        self.probes = 0
        left, slot = np.arange(len(hashes)), (hashes >> self.shift).astype(np.int64)
        while len(left):
            self.probes += 1
            free = self.slots[slot] == 0
            self.slots[slot[free]] = hashes[left[free]]  # of several for one slot the last stays
            won = self.slots[slot] == hashes[left]
            self.logp[slot[won]], self.gamma[slot[won]] = logp[left[won]], gamma[left[won]]
            left, slot = left[~won], (slot[~won] + 1) & (size - 1)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Slot of each hash, or -1."""
        slot = (h >> self.shift).astype(np.int64)
        got = self.slots[slot]
        out = np.where(got == h, slot, -1)
        left = np.flatnonzero((got != h) & (got != 0))
        for k in range(1, self.probes):
            if not len(left):
                break
            s = (slot[left] + k) & (len(self.slots) - 1)
            got = self.slots[s]
            same = got == h[left]
            out[left[same]] = s[same]
            left = left[~same & (got != 0)]
        return out


class Compiled:
    """The model as compact arrays; the table is built once in each worker."""

    def __init__(self, hashes: np.ndarray, logp: np.ndarray, gamma: np.ndarray, unseen: float):
        self.arrays, self.unseen, self.built = (hashes, logp, gamma), unseen, None

    def table(self) -> Table:
        if self.built is None:
            self.built, self.arrays = Table(*self.arrays), None
        return self.built


def compiled(model: DataFrame) -> Compiled:
    """Hash, log p and log gamma of each n-gram; the caller has checked the size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = np.array(batch.column(0).to_pylist(), dtype=f"<U{ORDER}")
            sizes = np.char.str_len(grams)
            hashes = np.zeros(len(grams), dtype=U64)
            for n in range(1, ORDER + 1):
                own = np.flatnonzero(sizes == n)
                chars = grams[own].astype(f"<U{n}").view(np.uint32).reshape(-1, n)
                h = np.full(len(own), n, dtype=U64)
                for k in range(n):
                    h = mixed(h * _FACTOR + chars[:, k].astype(U64))
                hashes[own] = h
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), batch.column(1), batch.column(2)], ["h", "logp", "gamma"])

    logs = model.where("gram <> ''").select("gram", F.log("p").cast("float").alias("logp"), F.log(F.coalesce("gamma", F.lit(1.0))).cast("float").alias("gamma"))
    rows = logs.mapInArrow(run, "h long, logp float, gamma float").toArrow()
    unseen = model.where("gram = ''").select(F.log("p")).first()
    # log p is missing for a context that holds start marks only
    return Compiled(rows["h"].to_numpy().view(np.uint64), rows["logp"].to_numpy().astype(np.float32), rows["gamma"].to_numpy().astype(np.float32), unseen[0] if unseen and unseen[0] is not None else 0.0)


def log_probabilities(chars: np.ndarray, table: Table, unseen: float) -> np.ndarray:
    """log p of each code point after the ORDER - 1 before it."""
    out = np.zeros(len(chars))
    left = np.arange(ORDER - 1, len(chars))
    spent = np.zeros(len(left))
    for n in range(ORDER, 0, -1):
        if not len(left):
            return out
        h = gram_hashes(chars, n)
        slot = table.find(h[left - n + 1])
        seen = (slot >= 0) & ~np.isnan(table.logp[slot])
        out[left[seen]] = spent[seen] + table.logp[slot[seen]]
        left, spent = left[~seen], spent[~seen]
        if n > 1 and len(left):
            context = table.find(gram_hashes(chars, n - 1)[left - n + 1])
            spent = spent + np.where(context >= 0, table.gamma[context], 0.0)
    out[left] = spent + unseen
    return out


def scored_by_broadcast(docs: DataFrame, model: DataFrame) -> DataFrame:
    """All columns of ``docs`` but text, with n_chars and logp, from a copy of the model in each task."""
    shared = docs.sparkSession.sparkContext.broadcast(compiled(model))
    frame = docs.withColumns({"n_chars": F.lit(None).cast("long"), "logp": F.lit(None).cast("double")})
    schema = frame.drop("text").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, unseen = shared.value.table(), shared.value.unseen
        for batch in batches:
            n_chars, sums = [], []
            for _, _, data, at in passes(batch.column("text")):
                chars, bounds = code_points(data, at)
                logp = log_probabilities(chars, table, unseen)
                logp[~predicted(bounds, len(chars))] = 0
                total = np.concatenate([[0], np.cumsum(logp)])
                sums += (total[bounds[1:]] - total[bounds[:-1]]).tolist()
                n_chars += (np.diff(bounds) - ORDER + 1).tolist()
            made = {"n_chars": pa.array(n_chars, pa.int64()), "logp": pa.array(sums, pa.float64())}
            names = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([made.get(c, batch.column(c)) for c in names], names=names)

    return frame.mapInArrow(run, schema)


def scored_by_join(docs: DataFrame, model: DataFrame) -> DataFrame:
    """As scored_by_broadcast, by joining the documents' distinct n-grams with the sharded model; for models of any size."""
    rows = stored(docs.withColumn("row", F.monotonically_increasing_id()), "rows")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, _, data, at in passes(batch.column(1), 1 << 18):
                chars, bounds = code_points(data, at)
                use = np.flatnonzero(predicted(bounds, len(chars)))
                of = np.searchsorted(bounds, use, "right") - 1
                grams = chars[use[:, None] + np.arange(1 - ORDER, 1)].astype("<u4").view(f"<U{ORDER}").reshape(-1)
                pairs: dict = {}
                for r, g in zip(of.tolist(), grams.tolist(), strict=True):
                    pairs[r, g] = pairs.get((r, g), 0) + 1
                ids = batch.column(0).slice(low, len(at) - 1).to_pylist()
                yield pa.RecordBatch.from_arrays([pa.array([ids[r] for r, _ in pairs], pa.int64()), pa.array([g for _, g in pairs], pa.string()), pa.array(list(pairs.values()), pa.int64())], ["row", "gram", "times"])

    wanted = stored(rows.select("row", "text").mapInArrow(run, "row long, gram string, times long"), "wanted")
    left = wanted.groupBy("gram").agg(F.count("*").alias("n")).select("gram", F.col("gram").alias("at"), F.lit(0.0).alias("spent"))
    found = []
    for n in range(ORDER, 0, -1):
        hit = left.join(model.where(F.char_length("gram") == n).select(F.col("gram").alias("at"), "p"), "at", "left")
        found.append(hit.where("p is not null").select("gram", (F.col("spent") + F.log("p")).alias("value")))
        left = hit.where("p is null").select("gram", "at", "spent")
        context = model.where("gamma is not null and gram <> ''").select(F.col("gram").alias("context"), "gamma")
        left = left.withColumn("context", F.substring("at", 1, n - 1)).join(context, "context", "left")
        left = left.select("gram", F.substring("at", 2, n - 1).alias("at"), (F.col("spent") + F.coalesce(F.log("gamma"), F.lit(0.0))).alias("spent"))
    unseen = model.where("gram = ''").select(F.log("p").alias("u"))
    value = found[0]
    for f in found[1:]:
        value = value.unionByName(f)
    value = value.unionByName(left.join(unseen).select("gram", (F.col("spent") + F.col("u")).alias("value")))
    sums = wanted.join(value, "gram").groupBy("row").agg(F.sum(F.col("times") * F.col("value")).alias("logp"))
    return rows.join(sums, "row", "left").withColumns({"n_chars": F.coalesce(F.char_length("text").cast("long"), F.lit(0)), "logp": F.coalesce("logp", F.lit(0.0))}).drop("row", "text")


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids labelled as of good quality and not toxic by every label they have."""
    return labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.min(F.when((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0), 1).otherwise(0)).alias("ok")).where("ok = 1").select("id")


def set_aside(doc_id: Column) -> Column:
    """Whether a trusted document sets thresholds instead of teaching the model."""
    return F.crc32(doc_id.cast("string").cast("binary")) % SPLIT == 0


def thresholds(scored: DataFrame, quantile: float, judge: str = "judge") -> DataFrame:
    """lang and its threshold: the quantile of log perplexity of its documents that ``judge`` names, on a grid of thousandths.

    One row for each language and grid step is all that is sorted.
    """
    steps = scored.where(F.col(judge) & F.col("lp").isNotNull()).withColumn("step", F.ceil(F.col("lp") * 1000))
    own = steps.groupBy("lang", "step").agg(F.count("*").alias("n"))

    def lowest(grid: DataFrame, *keys: str) -> DataFrame:
        every = grid.withColumn("all", F.sum("n").over(Window.partitionBy(*keys)))
        return every.withColumn("upto", F.sum("n").over(Window.partitionBy(*keys).orderBy("step"))).where(F.col("upto") >= F.col("all") * quantile).groupBy(*keys).agg((F.min("step") / 1000.0).alias("limit"), F.max("all").alias("trusted_n"))

    whole = lowest(own.groupBy("step").agg(F.sum("n").alias("n"))).select(F.col("limit").alias("whole")).first()
    whole = whole["whole"] if whole else None
    if whole is None and judge != "trusted":
        return thresholds(scored, quantile, "trusted")
    langs = scored.select("lang").distinct()
    mine = lowest(own, "lang").withColumnRenamed("lang", "l")
    limit = F.when(F.coalesce("trusted_n", F.lit(0)) >= LEAST_TRUSTED, F.col("limit")).otherwise(F.lit(whole).cast("double"))
    return langs.join(mine, F.col("lang").eqNullSafe(F.col("l")), "left").select(F.col("lang").alias("of"), limit.alias("limit"))


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """doc_id, lang, n_chars, perplexity, threshold and kept of every document."""
    prepare(docs.sparkSession)
    ids = stored(trusted_ids(labels), "trusted")
    few = ids.count() <= BROADCAST_IDS
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text")
    learned = ids.where(~set_aside(F.col("id")))
    learned = F.broadcast(learned) if few else learned
    model = fit(rows.join(learned, F.col("doc_id") == F.col("id"), "left_semi"))
    scorer = scored_by_broadcast if model.count() <= BROADCAST_GRAMS else scored_by_join
    scored = stored(scorer(rows, model), "scored")
    lp = F.when(F.col("n_chars") > 0, -F.col("logp") / F.col("n_chars"))
    scored = scored.join(ids, F.col("doc_id") == F.col("id"), "left").select("doc_id", "lang", "n_chars", lp.alias("lp"), F.col("id").isNotNull().alias("trusted"), F.coalesce(set_aside(F.col("id")), F.lit(False)).alias("judge"))
    limits = stored(thresholds(scored, quantile), "limits")
    limits = F.broadcast(limits) if limits.count() <= BROADCAST_IDS else limits  # a row for each language
    out = scored.join(limits, F.col("lang").eqNullSafe(F.col("of")), "left")
    return out.select("doc_id", "lang", "n_chars", F.exp("lp").alias("perplexity"), F.exp("limit").alias("threshold"), F.coalesce(F.col("lp") <= F.col("limit"), F.lit(False)).alias("kept"))

"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are hashed 1- to 3-grams of lower-cased letters, other characters being
one space.  Inverse document frequencies are counted over every document that
may be learned from; the weights are fitted by follow-the-regularised-leader
(FTRL-proximal) with elastic-net penalties on a bounded sample of labelled
documents, and a temperature is then calibrated on a part of that sample which
the weights have not seen.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
without any learned language every text is ``und``; a null label is not learned
from; a null id counts as a document to learn from; texts are read whole;
repeated rows are judged one by one; other columns are left alone.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import U64, mixed, passes, prepare, shielded, trim

UNDETERMINED = "und"
#: log2 of the number of hashed features.
FEATURE_BITS = 14
#: Bound of the sample that the weights and the temperature are fitted on, over all languages.
SAMPLE_ROWS = 1600
EPOCHS, ALPHA, BETA, L1, L2 = 4, 0.5, 1.0, 0.02, 0.05
_ROWS_AT_ONCE = 64

_TABLES: dict[str, np.ndarray] = {}


def letter_table() -> np.ndarray:
    """For each code point its lower-cased letter, or a space for what is no letter or mark."""
    if "letters" not in _TABLES:
        table = np.full(sys.maxunicode + 1, 32, dtype=np.uint32)
        for i in range(sys.maxunicode + 1):
            c = chr(i)
            if c.isalpha() or unicodedata.category(c)[0] == "M":
                low = c.lower()
                table[i] = ord(low) if len(low) == 1 else i
        _TABLES["letters"] = table
    return _TABLES["letters"]


def features(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Feature counts of runs of texts: first row, counts (rows x features), and whether each row has a letter."""
    table, size = letter_table(), 1 << FEATURE_BITS
    for low, high, data, at in passes(column):
        letters = table[np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)]
        chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[at]
        row = np.repeat(np.arange(high - low), np.diff(chars))
        blank = letters == 32
        alpha = np.bincount(row[~blank], minlength=high - low) > 0
        first = np.ones(len(row), dtype=bool)
        first[1:] = row[1:] != row[:-1]
        drop = blank.copy()  # of a run of blanks only the first counts, and none at the start of a text
        drop[1:] &= blank[:-1] | first[1:]
        letters, row = letters[~drop].astype(U64), row[~drop]
        grams, of = [], []
        for n in (1, 2, 3):
            if len(letters) < n:
                continue
            h = np.full(len(letters) - n + 1, n, dtype=U64)
            for k in range(n):
                h = h * U64(0x100000001B3) + letters[k : len(letters) - n + 1 + k]
            inside = row[n - 1 :] == row[: len(row) - n + 1]
            grams.append((mixed(h) >> U64(64 - FEATURE_BITS)).astype(np.int64)[inside])
            of.append(row[n - 1 :][inside])
        bounds = [np.searchsorted(x, np.arange(0, high - low + _ROWS_AT_ONCE, _ROWS_AT_ONCE)) for x in of]
        for part, start in enumerate(range(0, high - low, _ROWS_AT_ONCE)):
            rows = min(_ROWS_AT_ONCE, high - low - start)
            counts = np.zeros(rows * size, dtype=np.int64)
            for g, o, b in zip(grams, of, bounds, strict=True):
                a, z = b[part], b[part + 1]
                counts += np.bincount((o[a:z] - start) * size + g[a:z], minlength=rows * size)
            yield low + start, counts.reshape(rows, size), alpha[start : start + rows]


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF rows of unit length."""
    x = np.log1p(counts.astype(np.float32)) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


@dataclass
class Model:
    langs: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def predict(self, column: pa.Array) -> tuple[list[str], list[float]]:
        langs, scores = [UNDETERMINED] * len(column), [0.0] * len(column)
        if not self.langs:
            return langs, scores
        for first, counts, alpha in features(column):
            p = softmax(weighted(counts, self.idf) @ self.weights / self.temperature)
            best = p.argmax(axis=1)
            for i in np.flatnonzero(alpha).tolist():
                langs[first + i], scores[first + i] = self.langs[best[i]], float(p[i, best[i]])
        return langs, scores


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def follow_the_leader(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, n_features: int, n_langs: int) -> np.ndarray:
    """FTRL-proximal weights; rows are (feature numbers, values)."""
    z, n = np.zeros((n_features, n_langs)), np.zeros((n_features, n_langs))

    def leader(at):
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    for epoch in range(EPOCHS):
        for i in np.random.default_rng(epoch).permutation(len(rows)):
            at, x = rows[i]
            w = leader(at)
            p = softmax((x @ w)[None])[0]
            p[labels[i]] -= 1
            g = x[:, None] * p
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - step * w
            n[at] += g * g
    return leader(slice(None)).astype(np.float32)


def calibrated(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss, by golden-section search over its logarithm."""
    if not len(labels):
        return 1.0

    def loss(t):
        return -np.log(np.maximum(softmax(logits / np.exp(t))[np.arange(len(labels)), labels], 1e-12)).mean()

    low, high, golden = np.log(0.05), np.log(10.0), (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - golden * (high - low), low + golden * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def fit(docs: DataFrame, learnable: Column, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn from columns text and lang of the rows where ``learnable`` holds."""
    prepare(docs.sparkSession)
    rows = docs.where(learnable & F.col("text").isNotNull() & F.col("lang").isNotNull()).select(F.col("lang").cast("string").alias("lang"), "text", F.col("doc_id").cast("string").alias("id"))
    size = 1 << FEATURE_BITS
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    langs = sorted(counts)
    if not langs:
        return Model([], np.zeros(size, np.float32), np.zeros((size, 0), np.float32), 1.0)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(size, dtype=np.int64), 0
        for batch in batches:
            for _, c, alpha in features(batch.column(0)):
                df += (c > 0).sum(axis=0)
                n += int(alpha.sum())
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(held, -1)), pa.array(np.append(df[held], n))], ["feature", "n"])

    df = np.zeros(size + 1)
    for r in rows.select("text").mapInArrow(frequencies, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect():
        df[r["feature"]] = r["n"]
    idf = np.log((1 + df[size]) / (1 + df[:size])).astype(np.float32) + 1

    each = max(20, sample_rows // len(langs))
    share = F.create_map(*[x for lang in langs for x in (F.lit(lang), F.lit(min(1.0, 1.1 * each / counts[lang])))])
    chosen = rows.where(F.crc32(F.concat(F.coalesce("id", F.lit("")), F.lit(" sample"))) / 2.0**32 < share[F.col("lang")])

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, c, alpha in features(batch.column(1)):
                x = weighted(c, idf)
                keep = np.flatnonzero(alpha)
                at = [np.flatnonzero(c[i]) for i in keep]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(first + keep)), batch.column(2).take(pa.array(first + keep)), pa.array([a.astype(np.uint16).tobytes() for a in at], pa.binary()), pa.array([x[i][a].tobytes() for i, a in zip(keep, at, strict=True)], pa.binary())], ["lang", "id", "at", "x"])

    sample = chosen.mapInArrow(vectors, "lang string, id string, at binary, x binary").orderBy("id", "lang", "x").limit(2 * max(sample_rows, each * len(langs))).collect()
    if not sample:
        return Model([], idf, np.zeros((size, 0), np.float32), 1.0)
    langs = sorted({r["lang"] for r in sample})
    data = [(np.frombuffer(r["at"], np.uint16).astype(np.int64), np.frombuffer(r["x"], np.float32).astype(np.float64)) for r in sample]
    labels = np.array([langs.index(r["lang"]) for r in sample])
    seen = np.arange(len(data)) % 5 != 4
    weights = follow_the_leader([d for d, s in zip(data, seen, strict=True) if s], labels[seen], size, len(langs))
    held = [d for d, s in zip(data, seen, strict=True) if not s]
    logits = np.array([x @ weights[at] for at, x in held]).reshape(len(held), len(langs))
    return Model(langs, idf, weights, calibrated(logits, labels[~seen]))


def predict(docs: DataFrame, model: Model, lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """All columns of ``docs`` and the predicted language with its calibrated probability."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # features x languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = shared.value.predict(batch.column("text"))
            made = {lang: pa.array(langs, pa.string()), score: pa.array(scores, pa.float64())}
            yield pa.RecordBatch.from_arrays([made.get(c, batch.column(c)) for c in batch.schema.names], names=batch.schema.names)
        trim()

    out = docs.withColumns({lang: F.lit(None).cast("string"), score: F.lit(None).cast("double")})
    return out.mapInArrow(run, out.schema)


def held_out(modulus: int, remainder: int, key: str = "doc_id") -> Column:
    """Whether the crc32 of the id's text leaves ``remainder``; false for a null id."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score; learned from the documents whose crc32(doc_id) mod 4 is not 2."""
    model = fit(docs, ~held_out(4, 2))
    return predict(docs.select(F.col("doc_id").cast("long"), held_out(4, 2).alias("held_out"), "text"), model).select("doc_id", "held_out", "lang_pred", "score")


def accepted(docs: DataFrame, least: float = 0.3) -> DataFrame:
    """``docs`` without texts of undetermined language or of a score below ``least``; the columns stay as they are."""
    model = fit(docs, ~held_out(4, 2))
    safe, names = shielded(docs, ["lang_pred", "score"])
    rows = predict(safe, model).where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least))
    return rows.select(*safe.columns).toDF(*names)

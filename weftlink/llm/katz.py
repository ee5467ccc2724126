"""Language-model scoring: Katz backoff with Good-Turing discounts, from sharded n-gram counts.

Model.  Tokens are lower-cased words and one end per text; a text starts after a
start mark.  With counts c of the training texts, a word pair h w that was seen has
``d(c) c(hw) / c(h)``; any other falls back to ``alpha(h) p(w)``, where alpha makes the
distribution after h sum to exactly one, and ``p(w)`` is discounted likewise, the freed mass going to
one unknown word.  ``d`` is Katz's Good-Turing discount of counts up to ``K``; where the counts of counts
do not allow it, ``(r - 0.5) / r``.  A history after which nothing was freed gives one pseudo-count away;
a history that was never seen uses ``p(w)`` alone.

Scale.  Word counts are a table sharded by word.  Word pairs go to shards of
their history (of the whole pair where the history is a frequent one, so no shard holds
a hot key), except pairs that end in a rare word, which go to that word's shard, since only there its
count is known.  Each shard counts its pairs and evaluates its tokens: the log
score is a sum, so every token's parts can be added up per document wherever they become known:
``-log c(h)`` with the history, ``log c(hw)`` and the discount with the pair, ``log alpha(h)`` where all sums of h meet.
Only the ``FREQUENT`` most frequent words travel to every task.  Exchanges carry packed arrays, and all steps
are written to the shared folder.

Defined cases: a null text is empty and has the end token only; an empty training set gives score null;
repeated rows and ids are texts of their own; a null id counts as training text.  Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, SPACED_WORD, U64, crc_remainder, cut, discard, hash_bytes, mixed, pack, passes, prepare, runs, spans, stored, unpack, word_hashes

#: Counts up to K are discounted.
K = 5
#: Words whose counts every task holds.
FREQUENT = 1 << 19
#: Training tokens for each shard of word pairs: what a task holds at once.
SHARD_TOKENS = 1_000_000
#: Distinct words that a task counts before it passes them on.
HELD = 1 << 20
#: Fixed 64-bit names of the end token and the start mark; no word contains a blank.
END, START = U64(hash_bytes(b" end")), U64(hash_bytes(b" start"))


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token and history of every token of a batch, and the number of its row; rows end with END."""
    words, of, low_row = [], [], 0
    for low, high, data, at in passes(column):
        data = LOWER[data]
        starts, ends, first = spans(data, at, SPACED_WORD)
        sizes = np.diff(first)
        out = np.empty(len(starts) + high - low, dtype=U64)
        row = np.repeat(np.arange(high - low), sizes)
        out[np.arange(len(starts)) + row] = word_hashes(data, starts, ends)
        out[np.cumsum(sizes + 1) - 1] = END
        words.append(out)
        of.append(np.repeat(np.arange(low, high), sizes + 1))
        low_row = high
    if not low_row:
        return np.zeros(0, U64), np.zeros(0, U64), np.zeros(0, np.int64)
    w, row = np.concatenate(words), np.concatenate(of)
    h = np.concatenate([[START], w[:-1]])
    h[np.concatenate([[True], row[1:] != row[:-1]])] = START
    return w, h, row


def trained_on(ids) -> np.ndarray:
    return crc_remainder(ids, 7) != 2


def word_counts(docs: DataFrame) -> DataFrame:
    """word (64-bit hash) and its count c in the training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def summed(parts):
            words, n = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            order = np.argsort(words)
            at = runs(words[order])
            return words[order][at[:-1]], np.add.reduceat(n[order], at[:-1]) if len(words) else n

        parts: list = []
        for batch in batches:
            w, _, row = tokens(batch.column(1))
            w = w[trained_on(batch.column(0).to_pylist())[row]]
            parts.append(summed([(w, np.ones(len(w), dtype=np.int64))]))
            if len(parts) > 8:
                parts = [summed(parts)]
                if len(parts[0][0]) > HELD:
                    yield pa.RecordBatch.from_arrays([pa.array(parts[0][0].view(np.int64)), pa.array(parts[0][1])], ["word", "c"])
                    parts = []
        if parts:
            words, n = summed(parts)
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)], ["word", "c"])

    return docs.mapInArrow(run, "word long, c long").groupBy("word").agg(F.sum("c").alias("c"))


def discounts(n: dict[int, int]) -> np.ndarray:
    """d of counts 0 to K, from the numbers n of things counted r times."""
    d = np.ones(K + 1)
    usable = all(n.get(r, 0) > 0 for r in range(1, K + 2))
    if usable:
        spare = (K + 1) * n[K + 1] / n[1]
        for r in range(1, K + 1):
            d[r] = ((r + 1) * n[r + 1] / (r * n[r]) - spare) / (1 - spare) if spare != 1 else 0
    if not usable or not ((d[1:] > 0) & (d[1:] < 1)).all():
        d[1:] = (np.arange(1, K + 1) - 0.5) / np.arange(1, K + 1)
    return d


class Unigrams:
    """What every task knows: totals, discounts and the counts of the frequent words."""

    def __init__(self, total: int, vocabulary: int, texts: int, d: np.ndarray, freed: float, words: np.ndarray, counts: np.ndarray):
        self.total, self.vocabulary, self.texts, self.d = total, vocabulary, texts, d
        self.scale = 1.0 if freed > 0 else total / (total + 1.0)
        self.unknown = freed / total if freed > 0 else 1 / (total + 1.0)
        order = np.argsort(words)
        self.words, self.counts = words[order], counts[order]

    def find(self, words: np.ndarray) -> np.ndarray:
        """Number of each word among the frequent ones, or -1."""
        if not len(self.words):
            return np.full(len(words), -1)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[at] == words, at, -1)

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 1) / (self.total + self.vocabulary + 1.0))

    def p(self, c: np.ndarray) -> np.ndarray:
        return np.where(c > 0, np.where(c <= K, self.d[np.minimum(c, K)], 1.0) * c / self.total * self.scale, self.unknown)


def unigrams(table: DataFrame, texts: int) -> Unigrams:
    """Totals of the word table and its most frequent words: never more than FREQUENT."""
    step = F.floor(F.log2("c") * 8).alias("step")
    rows = table.groupBy(step).agg(F.count("*").alias("n"), F.sum("c").alias("c")).collect()  # a few rows for each power of two
    total, vocabulary = sum(r["c"] for r in rows), sum(r["n"] for r in rows)
    n = {r["c"]: r["n"] for r in table.where(f"c <= {K + 1}").groupBy("c").agg(F.count("*").alias("n")).collect()}
    d = discounts(n)
    freed = sum((1 - d[r]) * r * n.get(r, 0) for r in range(1, K + 1))
    held, least = 0, None
    for r in sorted(rows, key=lambda r: -r["step"]):
        if held + r["n"] > FREQUENT:
            break
        held, least = held + r["n"], r["step"]
    own = table.withColumn("step", step).where(F.col("step") >= least).select("word", "c").toArrow() if least is not None else None
    words, counts = (own["word"].to_numpy().view(np.uint64), own["c"].to_numpy().astype(np.int32)) if own is not None else (np.zeros(0, U64), np.zeros(0, np.int64))
    return Unigrams(total, vocabulary, texts, d, freed, words, counts)


#: Rows that steps pass on: what they are, the shard or batch they go to, and a packed block.
PACKED = "kind string, key long, block binary"


def _rows(kind: list[str], key, block: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(kind, pa.string()), pa.array(key, pa.int64()), pa.array(block, pa.binary())], ["kind", "key", "block"])


def _dealt(to: np.ndarray, shards: int, *columns: np.ndarray):
    """(shard, its rows of the columns) for each shard that has any; ``columns`` stay in their order."""
    order = np.argsort(to, kind="stable")
    bounds = np.searchsorted(to[order], np.arange(shards + 1))
    for s in range(shards):
        if bounds[s] < bounds[s + 1]:
            own = order[bounds[s] : bounds[s + 1]]
            yield s, [c[own] for c in columns]


def occurrences(docs: DataFrame, shared, shards: int) -> DataFrame:
    """Packed rows: 'doc' for each batch with what its task knows of its documents; 'h' and 'w' with the pairs for shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Unigrams = shared.value
        hot = model.total / (4 * shards)
        for k, batch in enumerate(batches):
            name = TaskContext.get().partitionId() << 32 | k
            ids = batch.column(0).to_pylist()
            w, h, row = tokens(batch.column(1))
            train = trained_on(ids)
            fw, fh = model.find(w), model.find(h)
            cw, ch = np.where(fw >= 0, model.counts[fw], 0), np.where(fh >= 0, model.counts[fh], 0)
            ch = np.where(h == START, model.texts, ch)
            local = fw >= 0
            n = len(batch)
            spent = np.where(ch > 0, -np.log10(np.maximum(ch, 1)), 0.0)
            yield _rows(["doc"], [name], [pack(
                np.array([0 if i is None else i for i in ids], dtype=np.int64), np.array([i is not None for i in ids], dtype=np.uint8), (~train).astype(np.uint8), np.bincount(row, minlength=n),
                np.bincount(row[local & (cw > 0)], minlength=n), np.bincount(row[local], model.base(cw[local]), minlength=n), np.bincount(row, spent, minlength=n))])
            order = np.lexsort((fw, h))
            order = order[local[order]]
            salt = np.where(ch[order] > hot, mixed(w[order] + h[order]), mixed(h[order]))
            keys, blocks, kinds = [], [], []
            for s, (hs, ws, rs) in _dealt(cut(salt, shards), shards, h[order], fw[order], row[order]):
                at = runs(hs)
                keys.append(s)
                kinds.append("h")
                blocks.append(pack(hs[at[:-1]], np.diff(at).astype(np.uint32), ws.astype(np.uint32), rs.astype(np.uint16), train, np.array([name], dtype=np.int64)))
            order = np.lexsort((h, w))
            order = order[~local[order]]
            for s, (ws, hs, rs) in _dealt(cut(mixed(w[order]), shards), shards, w[order], h[order], row[order]):
                keys.append(s)
                kinds.append("w")
                blocks.append(pack(ws, hs, rs.astype(np.uint16), train, np.array([name], dtype=np.int64)))
            if keys:
                yield _rows(kinds, keys, blocks)

    return docs.mapInArrow(run, PACKED)


def evaluate(model: Unigrams, shards: int, h, w, cw, row, batch, train, names):
    """Count the pairs of a shard and give packed rows: 'part' by batch, 'sum' and 'event' by history's shard, 'coc'.

    h, w name the pairs (w in any numbering), cw is the count of w; row, batch (its number in names) and train tell each
    token's document.
    """
    order = np.lexsort((w, h))
    h, w, cw, row, batch, train = h[order], w[order], cw[order], row[order], batch[order], train[order]
    fresh = np.ones(len(h), dtype=bool)
    fresh[1:] = (h[1:] != h[:-1]) | (w[1:] != w[:-1])
    first = np.flatnonzero(fresh)
    c_pair = np.add.reduceat(train.astype(np.int64), first)
    c = c_pair[np.cumsum(fresh) - 1]
    seen, p = c > 0, model.p(cw)
    value = np.where(c > K, np.log10(np.maximum(c, 1)), 0.0)
    value = np.where(seen, value, np.log10(p))
    kinds, keys, blocks = [], [], []

    def add(kind, key, *arrays):
        kinds.append(kind)
        keys.append(key)
        blocks.append(pack(*arrays))

    small = np.where(seen & (c <= K), c, 0)
    for b, (rows, values, counts) in _by_batch(batch, row, value, small):
        docs, at = np.unique(rows, return_inverse=True)
        table = np.bincount(at * (K + 1) + counts, minlength=len(docs) * (K + 1)).reshape(len(docs), K + 1)
        add("part", int(names[b]), docs.astype(np.uint16), np.bincount(at, values), *(table[:, r].astype(np.uint32) for r in range(1, K + 1)))
    held = c_pair > 0
    hp, cp, pp = h[first][held], c_pair[held], p[first][held]
    at = runs(hp)
    if len(hp):
        start = at[:-1]
        stats = [np.add.reduceat(x, start) for x in (cp, *((cp == r).astype(np.int64) for r in range(1, K + 1)), np.where(cp > K, cp, 0), pp)]
        after = hp[start]
        for s, own in _dealt(cut(mixed(after), shards), shards, after, *stats):
            add("sum", s, own[0], *(x.astype(np.uint32) for x in own[1:-1]), own[-1])
        whole = stats[0] == stats[K + 1]  # here all that follows h is frequent, so perhaps nothing is freed
        lost = np.isin(h, after[whole]) & seen
    else:
        lost = np.zeros(len(h), dtype=bool)
    for mask, sign in ((~seen, 1), (lost, 0)):
        for s, (hs, bs, rs) in _dealt(cut(mixed(h[mask]), shards), shards, h[mask], batch[mask], row[mask]):
            add("event", s, hs, names[bs], rs.astype(np.uint16), np.full(len(hs), sign, dtype=np.uint8))
    add("coc", -1, np.array([(c_pair == r).sum() for r in range(1, K + 2)], dtype=np.int64))
    return kinds, keys, blocks


def _by_batch(batch, row, *columns):
    order = np.argsort(batch, kind="stable")
    at = runs(batch[order])
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        own = order[a:b]
        yield int(batch[own[0]]), [x[own] for x in (row, *columns)]


def of_histories(model: Unigrams, shards: int, blocks) -> tuple[list, list, list]:
    """Pairs that end in a frequent word, by history."""
    parts = [unpack(b.as_py()) for b in blocks]
    names = np.array([p[5][0] for p in parts])
    batch = np.repeat(np.arange(len(parts), dtype=np.int32), [len(p[2]) for p in parts])
    train = np.concatenate([p[4][p[3]] for p in parts])
    h, w, row = np.concatenate([np.repeat(p[0], p[1]) for p in parts]), np.concatenate([p[2] for p in parts]), np.concatenate([p[3] for p in parts])
    del parts
    return evaluate(model, shards, h, w, model.counts[w].astype(np.int64), row, batch, train, names)


def of_words(model: Unigrams, shards: int, blocks) -> tuple[list, list, list]:
    """Pairs that end in a rare word, by that word; its count, and all that hangs on it, is found here."""
    parts = [unpack(b.as_py()) for b in blocks]
    names = np.array([p[4][0] for p in parts])
    batch = np.repeat(np.arange(len(parts), dtype=np.int32), [len(p[0]) for p in parts])
    train = np.concatenate([p[3][p[2]] for p in parts])
    w, h, row = (np.concatenate([p[i] for p in parts]) for i in range(3))
    del parts
    words, at = np.unique(w, return_inverse=True)
    cw = np.bincount(at, train, minlength=len(words)).astype(np.int64)[at]
    kinds, keys, out = evaluate(model, shards, h, at.astype(np.int32), cw, row, batch, train, names)
    spent = np.where(cw > 0, -np.log10(np.maximum(cw, 1)), 0.0)  # each word is the history of the next token
    for b, (rows, known, base, left) in _by_batch(batch, row, (cw > 0).astype(np.int64), model.base(cw), spent):
        docs, which = np.unique(rows, return_inverse=True)
        kinds.append("word")
        keys.append(int(names[b]))
        out.append(pack(docs.astype(np.uint16), np.bincount(which, known).astype(np.uint32), np.bincount(which, base), np.bincount(which, left)))
    return kinds, keys, out


def evaluated(shared, shards: int):
    """What a shard's pairs come to; what a task knew of its documents passes through."""

    def run(table: pa.Table) -> pa.Table:
        kind = table.column("kind")[0].as_py()
        if kind == "doc":
            return table
        step = of_histories if kind == "h" else of_words
        return pa.Table.from_batches([_rows(*step(shared.value, shards, table.column("block")))])

    return run


def backoffs(d: np.ndarray):
    """All sums of a history meet: its backoff weight goes to the documents that need it, as 'back' rows by batch."""

    def run(table: pa.Table) -> pa.Table:
        sums, events = [], []
        for kind, block in zip(table.column("kind").to_pylist(), table.column("block"), strict=True):
            (sums if kind == "sum" else events).append(unpack(block.as_py()))
        if not events:
            return pa.Table.from_batches([_rows([], [], [])])
        h, batch, row, sign = (np.concatenate([e[i] for e in events]) for i in range(4))
        alpha, lost = np.zeros(len(h)), np.zeros(len(h))
        if sums:
            name = np.concatenate([s[0] for s in sums])
            order = np.argsort(name)
            at = runs(name[order])
            stats = [np.add.reduceat(np.concatenate([s[i] for s in sums]).astype(float)[order], at[:-1]) for i in range(1, K + 4)]
            name, total, big, covered = name[order][at[:-1]], stats[0], stats[K + 1], stats[K + 2]
            kept = big + sum(d[r] * r * stats[r] for r in range(1, K + 1))
            full = total == big
            freed = np.where(full, total / (total + 1), total - kept)
            weight = np.log10(freed / np.maximum(1 - covered, 1e-15))
            shrunk = np.where(full, np.log10(total / (total + 1)), 0.0)
            slot = np.minimum(np.searchsorted(name, h), len(name) - 1)
            hit = name[slot] == h
            alpha, lost = np.where(hit, weight[slot], 0.0), np.where(hit, shrunk[slot], 0.0)
        value = np.where(sign == 1, alpha, lost)
        keys, blocks = [], []
        for b, (rows, values) in _by_batch(batch, row, value):
            docs, which = np.unique(rows, return_inverse=True)
            keys.append(b)
            blocks.append(pack(docs.astype(np.uint16), np.bincount(which, values)))
        return pa.Table.from_batches([_rows(["back"] * len(keys), keys, blocks)])

    return run


RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def totals(d: np.ndarray, train_tokens: int):
    """Add up what is known of the documents of a batch."""
    logs = np.log10(d[1:] * np.arange(1, K + 1))

    def run(table: pa.Table) -> pa.Table:
        parts = [(k, unpack(b.as_py())) for k, b in zip(table.column("kind").to_pylist(), table.column("block"), strict=True)]
        ids, valid, held, n, known, base, score = next(p for k, p in parts if k == "doc")
        known, base, score = known.astype(np.int64), base.astype(float), score.astype(float)
        for kind, p in parts:
            if kind == "part":
                score[p[0]] += p[1] + sum(logs[r] * p[2 + r] for r in range(K))
            elif kind == "word":
                known[p[0]] += p[1]
                base[p[0]] += p[2]
                score[p[0]] += p[3]
            elif kind == "back":
                score[p[0]] += p[1]
        return pa.table({"doc_id": pa.array(ids, mask=valid == 0), "held_out": held.astype(bool), "n_tokens": n.astype(np.int64), "n_known": known, "train_tokens": np.full(len(ids), train_tokens), "base_score": base, "score": score if train_tokens else pa.nulls(len(ids), pa.float64())})

    return run


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document.

    Learns from the documents whose crc32(doc_id as text) mod 7 is not 2.
    """
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    texts = docs.where(F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2, F.lit(True))).count()
    words = stored(word_counts(docs), "words")
    model = unigrams(words, texts)
    shards = 2 + model.total // SHARD_TOKENS
    shared = spark.sparkContext.broadcast(model)  # FREQUENT words at most
    discard(words)
    second = stored(occurrences(docs, shared, shards).groupBy("kind", "key").applyInArrow(evaluated(shared, shards), PACKED), "evaluated")
    discard()
    counted = np.zeros(K + 1, dtype=np.int64)
    for r in second.where("kind = 'coc'").select("block").collect():  # one short row for each shard
        counted += unpack(r["block"])[0]
    d = discounts({i + 1: int(x) for i, x in enumerate(counted)})
    back = second.where("kind in ('sum', 'event')").groupBy("key").applyInArrow(backoffs(d), PACKED)
    parts = second.where("kind in ('doc', 'part', 'word')").unionByName(back)
    return parts.groupBy("key").applyInArrow(totals(d, model.total), RESULT)

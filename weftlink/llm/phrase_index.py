"""Benchmark decontamination with a distributed positional inverted index.

The index is partitioned by document: each task stores, for a segment of its
training texts, the positions of every term that the test set uses, ordered by
term.  A test window is looked up from the term with the fewest postings in the
segment; that list, less the term's offset, gives the possible starts, which are
then intersected with the offset-adjusted positions of the other terms from the
rarest on.  No postings cross the network, no document is joined with another,
and a passage that every document shares costs what its occurrences cost.

Test items travel to the tasks in blocks of at most ``BLOCK_BYTES`` of text; a
larger test set takes more blocks, one after the other, never a larger block.

Defined cases: a null text has no words and no hits; an item without words has
no windows; an item shorter than a window is one window of its own length; an
item whose id is null is ignored; repeated items with one id count once;
repeated document rows are judged one by one; other columns are left alone.
Words are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, PLAIN_WORD, passes, prepare, shielded, spans, text_buffer, trim, word_hashes

BLOCK_BYTES = 8 << 20

HITS = "array<struct<first:int,end:int>>"


class Windows:
    """Distinct windows of a block of test items as a matrix of term numbers."""

    def __init__(self, ids: list[str], texts: list[str], width: int):
        data, at = text_buffer(pa.array(texts, pa.large_string()))
        data = LOWER[data]
        starts, ends, first = spans(data, at, PLAIN_WORD)
        hashes = word_hashes(data, starts, ends)
        self.terms = np.unique(hashes)
        numbers = np.searchsorted(self.terms, hashes)
        owners: dict[tuple[int, ...], set[str]] = {}
        for i, item in enumerate(ids):
            own = numbers[first[i] : first[i + 1]].tolist()
            for low in range(max(1, len(own) - width + 1) if own else 0):
                owners.setdefault(tuple(own[low : low + width]), set()).add(item)
        self.owners = [sorted(x) for x in owners.values()]
        self.sizes = np.array([len(w) for w in owners], dtype=np.int64)
        self.matrix = np.full((len(owners), width), -1, dtype=np.int64)
        for i, w in enumerate(owners):
            self.matrix[i, : len(w)] = w


class Segment:
    """Positional index of a run of texts, restricted to the terms of a block of windows."""

    def __init__(self, hashes: np.ndarray, first: np.ndarray, terms: np.ndarray):
        self.first, self.n, self.n_terms = first, len(hashes), len(terms)
        found = np.minimum(np.searchsorted(terms, hashes), max(len(terms) - 1, 0))
        known = terms[found] == hashes if len(terms) else np.zeros(len(hashes), dtype=bool)
        self.at = np.flatnonzero(known)
        numbers = found[self.at]
        order = np.argsort(numbers, kind="stable")
        #: Postings: positions ordered by term, then position; ``lists`` has where each term's list starts.
        self.postings, of = self.at[order], numbers[order]
        self.lists = np.searchsorted(of, np.arange(self.n_terms + 1))
        self.keys = of * (self.n + 1) + self.postings
        self.term_at = np.full(self.n, -1, dtype=np.int64)
        self.term_at[self.at] = numbers

    def starts(self, windows: Windows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each window that can occur: its number, possible starts (repeated), and its slots from the rarest on."""
        used = windows.matrix >= 0
        counts = np.diff(self.lists)
        held = np.where(used, counts[np.maximum(windows.matrix, 0)] if len(counts) else 0, np.iinfo(np.int64).max)
        order = np.argsort(held, axis=1, kind="stable")
        rarest = order[:, 0] if held.shape[1] else np.zeros(0, dtype=np.int64)
        least = held[np.arange(len(held)), rarest]
        live = np.flatnonzero(least > 0)
        term = windows.matrix[live, rarest[live]]
        sizes = least[live]
        which = np.repeat(live, sizes)
        low = np.repeat(self.lists[term] - np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(live) else np.zeros(0, dtype=np.int64), sizes)
        start = self.postings[low + np.arange(len(which))] - rarest[which]
        return which, start, order

    def phrases(self, windows: Windows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Window number, first position and row of every exact occurrence."""
        which, start, order = self.starts(windows)
        row = np.searchsorted(self.first, start, "right") - 1
        keep = (start >= 0) & (start + windows.sizes[which] <= self.first[np.minimum(row + 1, len(self.first) - 1)])
        which, start, row = which[keep], start[keep], row[keep]
        for rank in range(1, windows.matrix.shape[1]):
            slot = order[which, rank]
            wanted = windows.matrix[which, slot]
            keep = (wanted < 0) | (self.term_at[np.minimum(start + slot, self.n - 1)] == wanted)
            which, start, row = which[keep], start[keep], row[keep]
        return which, start, row

    def near(self, windows: Windows, slop: int) -> tuple[np.ndarray, np.ndarray]:
        """Window number and row where every term stands within ``slop`` words of its place beside the rarest term."""
        which, start, order = self.starts(windows)
        anchor = start + order[which, 0]
        row = np.searchsorted(self.first, anchor, "right") - 1
        for rank in range(1, windows.matrix.shape[1]):
            slot = order[which, rank]
            wanted = windows.matrix[which, slot]
            low = np.maximum(start + slot - slop, self.first[row])
            high = np.minimum(start + slot + slop, self.first[row + 1] - 1)
            at = np.searchsorted(self.keys, np.maximum(wanted, 0) * (self.n + 1) + low)
            hit = np.minimum(at, max(len(self.keys) - 1, 0))
            keep = (wanted < 0) | (low <= high) & (at < len(self.keys)) & (self.keys[hit] <= np.maximum(wanted, 0) * (self.n + 1) + high)
            which, start, row = which[keep], start[keep], row[keep]
        return which, row


def merged(first: np.ndarray, end: np.ndarray) -> list[dict]:
    """Union of intervals, in order."""
    out: list[list[int]] = []
    for a, b in sorted(zip(first.tolist(), end.tolist(), strict=True)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [{"first": a, "end": b} for a, b in out]


def blocks(benchmark: DataFrame, width: int) -> list[Windows]:
    """The test items as blocks of bounded size; items without id, text or words add nothing."""
    items = benchmark.select(F.col("item_id").cast("string").alias("i"), F.col("text").alias("t")).where("i is not null and t is not null")
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = 1 + total // BLOCK_BYTES
    out = []
    for k in range(n):
        own = items if n == 1 else items.where(F.pmod(F.crc32("i"), F.lit(n)) == k)
        rows = own.collect()  # one block: BLOCK_BYTES on average
        out.append(Windows([r.i for r in rows], [r.t for r in rows], width))
    return out


def matches(docs: DataFrame, benchmark: DataFrame, width: int = 10, slop: int | None = None) -> DataFrame:
    """All columns of ``docs`` and

    ``phrase_words`` (words of the text), ``phrase_hits`` (disjoint runs of words, first to end, inside any
    occurrence of a window), ``phrase_items`` (ids of the items with occurring windows, sorted) and, with
    ``slop``, ``near_items`` (ids of the items of which a window occurs with each term moved by at most so many words).
    """
    prepare(docs.sparkSession)
    sc = docs.sparkSession.sparkContext
    out = docs.withColumns({"phrase_words": F.lit(None).cast("long"), "phrase_hits": F.lit(None).cast(HITS), "phrase_items": F.lit(None).cast("array<string>")})
    if slop is not None:
        out = out.withColumn("near_items", F.lit(None).cast("array<string>"))
    for block in blocks(benchmark, width):
        shared = sc.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            windows: Windows = shared.value
            for batch in batches:
                n_words, hits, items, close = [], [], [], []
                for low, high, data, at in passes(batch.column("text")):
                    data = LOWER[data]
                    starts, ends, first = spans(data, at, PLAIN_WORD)
                    segment = Segment(word_hashes(data, starts, ends), first, windows.terms)
                    n_words += np.diff(first).tolist()
                    found: list[list] = [[] for _ in range(high - low)]
                    named: list[set] = [set() for _ in range(high - low)]
                    nearby: list[set] = [set() for _ in range(high - low)]
                    if len(windows.owners):
                        which, start, row = segment.phrases(windows)
                        order = np.argsort(row, kind="stable")
                        which, start, row = which[order], start[order], row[order]
                        for r in np.unique(row).tolist():
                            a, b = np.searchsorted(row, [r, r + 1])
                            found[r] = merged(start[a:b] - first[r], start[a:b] + windows.sizes[which[a:b]] - first[r])
                            named[r] = {x for w in set(which[a:b].tolist()) for x in windows.owners[w]}
                        if slop is not None:
                            which, row = segment.near(windows, slop)
                            for w, r in set(zip(which.tolist(), row.tolist(), strict=True)):
                                nearby[r].update(windows.owners[w])
                    hits += found
                    items += named
                    close += nearby
                if (old := batch.column("phrase_hits")).null_count < len(old):  # of the blocks before
                    for i, (h, x) in enumerate(zip(old.to_pylist(), batch.column("phrase_items").to_pylist(), strict=True)):
                        both = hits[i] + (h or [])
                        hits[i] = merged(np.array([y["first"] for y in both], dtype=np.int64), np.array([y["end"] for y in both], dtype=np.int64))
                        items[i] |= set(x or [])
                    if slop is not None:
                        for i, x in enumerate(batch.column("near_items").to_pylist()):
                            close[i] |= set(x or [])
                made = {"phrase_words": pa.array(n_words, pa.int64()), "phrase_hits": pa.array(hits, pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))), "phrase_items": pa.array([sorted(x) for x in items], pa.list_(pa.string())), "near_items": pa.array([sorted(x) for x in close], pa.list_(pa.string()))}
                yield pa.RecordBatch.from_arrays([made.get(name, batch.column(name)) for name in batch.schema.names], names=batch.schema.names)
            trim()

        out = out.mapInArrow(run, out.schema)
    return out


def report(docs: DataFrame, benchmark: DataFrame, width: int = 10) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every document."""
    found = matches(docs.select(F.col("doc_id").cast("long"), "text"), benchmark, width).drop("text")
    return found.select("doc_id", F.col("phrase_words").alias("n_words"), F.expr("aggregate(phrase_hits, 0L, (n, h) -> n + h.end - h.first)").alias("n_hit"), F.size("phrase_items").cast("long").alias("n_items"), F.sha2(F.array_join("phrase_items", ","), 256).alias("items_sha256")).withColumn("contaminated", F.col("n_hit") > 0)


def clean(docs: DataFrame, benchmark: DataFrame, width: int = 10) -> DataFrame:
    """``docs`` without the documents in which a window of the test set occurs; the columns stay as they are."""
    safe, names = shielded(docs, ["phrase_words", "phrase_hits", "phrase_items"])
    return matches(safe, benchmark, width).where("size(phrase_hits) = 0").select(*safe.columns).toDF(*names)

"""Set-similarity join of documents on word n-grams by prefix trees.

A document's n-grams are put in one global order, n-grams that occur in many
documents last, so that the few that come first are rare.  Two sets whose
Jaccard similarity reaches the threshold share one of their first
``n - ceil(t n) + 1`` n-grams; sets meet there, and the candidates of a set are
kept in a prefix tree that is walked with that set: partial overlaps of shared
prefixes are counted once, and a subtree is left as soon as what remains cannot
reach the overlap that is asked for.

Scale.  Equal sets are one set from the start, found by digest, so copies cost
one entry per task, not pairs.  In a small meeting all pairs are candidates.  In
a large one (more than ``MEETING`` sets) each set first meets, of the sets of about its size, the one with the least share of rare
n-grams, which is the original of near copies, since what an editor changed is rare; after components are known only pairs that lie in different
components are looked at, so a group of near copies costs its size, and no link
between components is lost.  Parity sketches of the whole sets, of ``64 * SKETCH`` bits, are held against each other there, so sets
that share a passage and no more make no rows.  The candidates of one set are split into parts of
``PART`` sets.  Exchanges carry packed arrays.

Defined cases: a null text or a text without words has no n-grams and is alone;
a text of fewer words than an n-gram is one n-gram; repeated rows and ids are
equal sets and get one row each; a null id never names a component while another
id is there; an empty table gives no rows; other columns are left alone, whatever they are called.  Sets are compared by 63-bit hashes of their n-grams.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, SPACED_WORD, U64, cut, discard, mixed, pack, passes, prepare, runs, shard_count, shielded, spans, stored, trim, unpack, word_hashes
from .components import components

WORDS = 5
#: Similarity threshold as a fraction of integers.
NUM, DEN = 75, 100
#: Sets that meet at an n-gram before only links between components are sought; candidates in a part.
MEETING, PART = 12, 256
#: In a large meeting at one n-gram in LEADING all sets meet its first set; 64-bit words of a sketch.
LEADING, SKETCH = 2, 16
#: Frequent n-grams that the global order knows; the rest are ordered by hash.  It only decides the cost.
FREQUENT = 1 << 20
#: Ids that may be broadcast; beyond it they are joined by a shuffle.
BROADCAST_IDS = 1_000_000


def need(a, b):
    """Least overlap of sets of these sizes that reaches the threshold."""
    return -(-NUM * (a + b) // (NUM + DEN))


def prefix_length(n):
    return n + (-NUM * n // DEN) + 1


def shingles(column: pa.Array, width: int = WORDS) -> Iterator[np.ndarray]:
    """The set of 63-bit n-gram hashes of each text, sorted."""
    for low, high, data, at in passes(column):
        data = LOWER[data]
        starts, ends, first = spans(data, at, SPACED_WORD)
        words = word_hashes(data, starts, ends)
        grams = np.zeros(len(words), dtype=U64)
        odd = 0x9E3779B97F4A7C15
        for k in range(width):
            m = max(len(words) - k, 0)
            grams[:m] += words[k : k + m] * U64(pow(odd, k + 1, 1 << 64))
        grams = mixed(grams) >> U64(1)
        for i in range(high - low):
            a, b = int(first[i]), int(first[i + 1])
            if b - a >= width:
                yield np.unique(grams[a : b - width + 1])
            elif b > a:
                h = np.array([b - a], dtype=U64)
                for w in words[a:b]:
                    h = mixed(h * U64(odd) + w)
                yield h >> U64(1)
            else:
                yield np.zeros(0, dtype=U64)


class Order:
    """Global order: keys of rare n-grams are their hashes; frequent ones follow, the most frequent last."""

    def __init__(self, hashes: np.ndarray):
        """hashes: frequent n-grams, the least frequent first."""
        self.rank = np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.rank]

    def keys(self, grams: np.ndarray) -> np.ndarray:
        if not len(self.hashes) or not len(grams):
            return grams
        at = np.minimum(np.searchsorted(self.hashes, grams), len(self.hashes) - 1)
        hot = self.hashes[at] == grams
        if not hot.any():
            return grams
        return np.sort(np.where(hot, U64(1 << 63) + self.rank[at].astype(U64), grams))


def digest(grams: np.ndarray) -> int:
    """Signed 64-bit identity of a set of n-grams; it does not depend on the order."""
    x = mixed(grams + U64(0x1234567)).sum(dtype=U64) + U64(len(grams))
    return int(mixed(np.array([x], dtype=U64)).view(np.int64)[0])


def frequent(docs: DataFrame, width: int) -> Order:
    """Order by document frequency.  Every n-gram that recurs inside a batch of documents is counted, over all batches."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = list(shingles(batch.column(0), width))
            every = np.sort(np.concatenate(own)) if own else np.zeros(0, U64)
            at = runs(every)
            n = np.diff(at)
            again = n >= 3
            yield pa.RecordBatch.from_arrays([pa.array(every[at[:-1][again]].view(np.int64)), pa.array(n[again])], ["gram", "n"])
        trim()

    rows = docs.select("text").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    top = rows.where(f"n > {MEETING}").orderBy(F.desc("n"), "gram").limit(FREQUENT).select("gram").toArrow()
    return Order(top["gram"].to_numpy()[::-1].copy().view(np.uint64))


class PrefixTree:
    """Sorted sets in lexicographic order; neighbours share the path of their common prefix."""

    def __init__(self, sets: list[np.ndarray]):
        self.order = sorted(range(len(sets)), key=lambda i: sets[i].byteswap().tobytes())  # big-endian bytes sort as the keys do
        self.sets = [sets[i] for i in self.order]
        self.shared = [0]
        for a, b in zip(self.sets, self.sets[1:], strict=False):
            n = min(len(a), len(b))
            differ = np.flatnonzero(a[:n] != b[:n])
            self.shared.append(int(differ[0]) if len(differ) else n)

    def similar(self, query: np.ndarray) -> list[int]:
        """Numbers of the sets that reach the threshold with ``query``."""
        out, m = [], len(query)
        counts = np.zeros(1, dtype=np.int64)  # overlap of the current path at each depth
        passed = np.zeros(1, dtype=np.int64)  # elements of the query up to each depth
        for i, s in enumerate(self.sets):
            n = len(s)
            wanted = need(n, m)
            depth = min(self.shared[i], len(counts) - 1)
            if i and depth < self.shared[i] or counts[depth] + min(n - depth, m - passed[depth]) < wanted:
                counts, passed = counts[: depth + 1], passed[: depth + 1]  # this subtree was left, or is now
                if counts[depth] + min(n - depth, m - passed[depth]) < wanted:
                    continue
            rest = s[depth:]
            at = np.searchsorted(query, rest)
            hit = query[np.minimum(at, m - 1)] == rest
            counts = np.concatenate([counts[: depth + 1], counts[depth] + np.cumsum(hit)])
            passed = np.concatenate([passed[: depth + 1], at + hit])
            if counts[-1] >= wanted:
                out.append(self.order[i])
        return out


def pairs_of_meetings(keys, ids, sizes, places, maps, own, meeting):
    """Candidate pairs and large meetings of entries (n-gram, set, size, place of the n-gram in the set, bitmap, share of rare n-grams).

    Gives arrays a, size of a, b, size of b of the pairs and whether each is of a small meeting, and the members of the large
    meetings: sets, sizes, places and n-grams.
    """
    band = np.floor(np.log(np.maximum(sizes, 1)) / np.log(1.25)).astype(np.int64)
    order = np.lexsort((ids, own, band, keys))
    keys, ids, sizes, places, band = keys[order], ids[order], sizes[order], places[order], band[order]
    fresh = np.ones(len(keys), dtype=bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1])
    keys, ids, sizes, places, maps, band = keys[fresh], ids[fresh], sizes[fresh], places[fresh], maps[order][fresh], band[fresh]
    at = runs(keys)
    n = np.diff(at)
    size = np.repeat(n, n)  # of the meeting of each entry
    none = np.zeros(0, dtype=np.int64)
    left, right = [none], [none]
    for step in range(1, min(meeting, int(n.max(initial=0)))):  # pairs of a small meeting, by their distance in it
        a = np.flatnonzero((keys[step:] == keys[:-step]) & (size[:-step] <= meeting))
        b = a + step
        most = np.minimum(places[a], places[b]) + np.minimum(sizes[a] - places[a], sizes[b] - places[b])
        keep = most >= need(sizes[a], sizes[b])
        left.append(a[keep])
        right.append(b[keep])
    a, b = np.concatenate(left), np.concatenate(right)
    big = np.flatnonzero(size > meeting)
    new = np.ones(len(keys), dtype=bool)
    new[1:] = (keys[1:] != keys[:-1]) | (band[1:] != band[:-1])
    lead = np.flatnonzero(new)[np.cumsum(new) - 1][big]  # the first set of its size in the meeting
    other = (lead != big) & (mixed(keys[big]) % U64(LEADING) == 0)
    small = np.concatenate([np.ones(len(a), dtype=np.int64), np.zeros(int(other.sum()), dtype=np.int64)])
    a, b = np.concatenate([a, lead[other]]), np.concatenate([b, big[other]])
    first = foremost(sizes[a], places[a], sizes[b], places[b])
    keep = (first | (small == 1)) & alike(sizes[a], maps[a], sizes[b], maps[b])
    a, b, small, first = a[keep], b[keep], small[keep], first[keep]
    a, b = np.where(ids[a] < ids[b], a, b), np.where(ids[a] < ids[b], b, a)  # a pair has one form, wherever it meets
    return (ids[a], sizes[a], ids[b], sizes[b], small, first.astype(np.int64)), (ids[big], sizes[big], places[big], keys[big])


#: Sets of up to so many n-grams have a bitmap of all of them, larger ones of their first ones.
SMALL = 48


def bitmap(keys: np.ndarray) -> int:
    """64 bits, one for each class of the n-grams that the bitmap of an ordered set covers."""
    own = keys if len(keys) <= SMALL else keys[: prefix_length(len(keys))]
    return int(np.bitwise_or.reduce(U64(1) << (own & U64(63))))


def alike(size_a, map_a, size_b, map_b):
    """Whether bitmaps allow the overlap: each bit that one set alone has is an n-gram that they do not share."""
    first_a, first_b, wanted = prefix_length(size_a), prefix_length(size_b), need(size_a, size_b)
    whole = np.bitwise_count(map_a ^ map_b).astype(np.int64) <= size_a + size_b - 2 * wanted
    most = np.minimum(first_a - np.bitwise_count(map_a & ~map_b).astype(np.int64), first_b - np.bitwise_count(map_b & ~map_a).astype(np.int64))
    part = most >= wanted - np.maximum(size_a - first_a, size_b - first_b)
    return np.where(np.maximum(size_a, size_b) <= SMALL, whole, (np.minimum(size_a, size_b) <= SMALL) | part)


def foremost(size_a, place_a, size_b, place_b):
    """Length and positional filter: whether the n-gram can be the first that a similar pair has in common.

    Nothing before it is shared then, so what follows in either set must make up the whole overlap.
    """
    return np.minimum(size_a - place_a, size_b - place_b) >= need(size_a, size_b)


def distinct_pairs(a, size_a, b, size_b, *sums):
    """Each pair once, with the sums of further columns: shared n-grams of small meetings, and those that may be its first."""
    order = np.lexsort((b, a))
    a, size_a, b, size_b = a[order], size_a[order], b[order], size_b[order]
    fresh = np.ones(len(a), dtype=bool)
    fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    at = np.flatnonzero(fresh)
    return a[fresh], size_a[fresh], b[fresh], size_b[fresh], *(np.add.reduceat(x[order].astype(np.int64), at) if len(a) else x.astype(np.int64) for x in sums)


SIGNS = [f"s{k}" for k in range(SKETCH)]
ENTRY = "kind int, doc_id long, digest long, n int, shard int, block binary, " + ", ".join(f"{s} long" for s in SIGNS)
MEET = "kind int, shard int, block binary, meeting long, digest long, n int, place int, doc_id long, " + ", ".join(f"{s} long" for s in SIGNS)
#: Bits in which the parity sketches of two sets differ, in SQL.
SKETCHED = " + ".join(f"bit_count({s}a ^ {s}b)" for s in SIGNS)


def sketch(grams: np.ndarray) -> np.ndarray:
    """Parity of the number of n-grams in each of 64 * SKETCH cells, as signed words: an n-gram that one of two sets has alone turns one bit."""
    odd = np.bincount(((grams >> U64(17)) % U64(64 * SKETCH)).astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _batch(schema: str, rows: int, **columns) -> pa.RecordBatch:
    types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [x.split() for x in schema.split(", ")]
    arrays = [pa.array(columns[name], types[kind]) if name in columns else pa.nulls(rows, types[kind]) for name, kind in fields]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


def digested(docs: DataFrame, order, width: int, shards: int) -> DataFrame:
    """Rows of kind 0: doc_id, digest and size of each set, dealt over the shards; of kind 1: packed first n-grams by shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Order = order.value
        for batch in batches:
            digests, sizes, sketches, firsts, maps, rare, seen = [], [], [], [], [], [], {}
            for grams in shingles(batch.column(1), width):
                d = digest(grams) if len(grams) else None
                digests.append(d)
                sizes.append(len(grams))
                sketches.append(sketch(grams))
                if d is not None and (d, len(grams)) not in seen:
                    seen[d, len(grams)] = len(firsts)
                    keys = known.keys(grams)
                    firsts.append(keys[: prefix_length(len(keys))])
                    maps.append(bitmap(keys))
                    rare.append(65535 * np.searchsorted(keys, U64(1 << 63)) // len(keys))
            words = np.stack(sketches, axis=1) if sketches else np.zeros((SKETCH, 0), np.int64)
            yield _batch(ENTRY, len(batch), kind=[0] * len(batch), doc_id=batch.column(0), digest=digests, n=sizes, shard=np.arange(len(batch), dtype=np.int32) % shards, **dict(zip(SIGNS, words, strict=True)))
            if not firsts:
                continue
            lengths = np.array([len(f) for f in firsts])
            keys, of = np.concatenate(firsts), np.repeat(np.arange(len(firsts)), lengths)
            place = np.arange(len(keys)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            to = cut(mixed(keys), shards)
            rank = np.lexsort((keys, to))
            bounds = np.searchsorted(to[rank], np.arange(shards + 1))
            ids, size, bits, own_rare = np.array([k[0] for k in seen], dtype=np.int64), np.array([k[1] for k in seen], dtype=np.int32), np.array(maps, dtype=U64), np.array(rare, dtype=np.uint16)
            held = [s for s in range(shards) if bounds[s] < bounds[s + 1]]
            blocks = []
            for s in held:
                own = rank[bounds[s] : bounds[s + 1]]
                sets, local = np.unique(of[own], return_inverse=True)
                blocks.append(pack(keys[own], local.astype(np.uint16), place[own].astype(np.uint32), ids[sets], size[sets], bits[sets], own_rare[sets]))
            yield _batch(ENTRY, len(held), kind=[1] * len(held), shard=held, block=blocks)
        trim()

    return docs.select("doc_id", "text").mapInArrow(run, ENTRY)


def meetings(entries: DataFrame, shards: int, meeting: int | None = None) -> DataFrame:
    """Meetings of at most ``meeting`` sets are small.  Rows of kind 0: packed candidate pairs by shard; of kind 1: members of large
    meetings; of kind 2: the entries of kind 0 as they came, so that they take the same exchange and need no table of their own."""

    meeting = meeting or MEETING

    def run(table: pa.Table) -> pa.Table:
        own = table.filter(pc.equal(table.column("kind"), 0)).combine_chunks()
        out = [_batch(MEET, len(own), kind=np.full(len(own), 2, np.int32), **{c: own.column(c).combine_chunks() for c in ("doc_id", "digest", "n", *SIGNS)})]
        parts = []
        for block in table.column("block").drop_null():
            keys, local, place, ids, size, bits, rare = unpack(block.as_py())
            parts.append((keys, ids[local], size[local].astype(np.int64), place.astype(np.int64), bits[local], rare[local]))
        if not parts:
            return pa.Table.from_batches(out)
        pairs, (ids, sizes, places, keys) = pairs_of_meetings(*(np.concatenate(x) for x in zip(*parts, strict=True)), meeting)
        a, sa, b, sb, shared, first = distinct_pairs(*pairs)
        to = cut(mixed(a.view(np.uint64) * U64(31) + b.view(np.uint64)), shards)
        rank = np.argsort(to, kind="stable")
        bounds = np.searchsorted(to[rank], np.arange(shards + 1))
        held = [s for s in range(shards) if bounds[s] < bounds[s + 1]]
        blocks = [pack(a[own], sa[own].astype(np.int32), b[own], sb[own].astype(np.int32), shared[own].astype(np.uint32), np.minimum(first[own], 255).astype(np.uint8)) for s in held for own in [rank[bounds[s] : bounds[s + 1]]]]
        out.append(_batch(MEET, len(held), kind=[0] * len(held), shard=held, block=blocks))
        out.append(_batch(MEET, len(ids), kind=np.ones(len(ids), np.int32), meeting=keys.view(np.int64), digest=ids, n=sizes.astype(np.int32), place=places.astype(np.int32)))
        trim()
        return pa.Table.from_batches(out)

    return entries.groupBy("shard").applyInArrow(run, MEET)


def candidate_pairs(packed: DataFrame) -> DataFrame:
    """Distinct pairs (a, na, b, nb) out of the packed ones, with the number of n-grams that they share in small meetings,
    and whether one of their n-grams can be the first in common."""

    def run(table: pa.Table) -> pa.Table:
        parts = [unpack(x.as_py()) for x in table.column("block")]
        a, sa, b, sb, shared, first = distinct_pairs(*(np.concatenate(x) for x in zip(*parts, strict=True)))
        return pa.table({"a": a, "na": sa, "b": b, "nb": sb, "shared": shared, "first": first > 0})

    return packed.groupBy("shard").applyInArrow(run, "a long, na int, b long, nb int, shared long, first boolean")


#: Least overlap, and the n-grams behind the first ones, in SQL.
NEED = f"(({NUM} * (na + nb) + {NUM + DEN - 1}) div {NUM + DEN})"
BEHIND = f"(({NUM} * greatest(na, nb) + {DEN - 1}) div {DEN} - 1)"


def likely(pairs: DataFrame, sketches: DataFrame, large: DataFrame) -> DataFrame:
    """The pairs a, b that can still reach the overlap: all of small meetings, and of those with the first set of a large meeting
    the closest for either set, since one link settles a set's component; what that leaves is for unsettled().

    Sketches must allow the overlap; and what a pair shares among its first n-grams is known in small meetings, and is at most
    all of the large meetings of either, while the rest of the larger set may be shared.
    """
    known = sketches.join(large.groupBy(F.col("digest").alias("d")).agg(F.count("*").alias("crowd")), F.col("digest") == F.col("d"), "left").na.fill(0, ["crowd"])
    one, two = (known.select(F.col("digest").alias(x), F.col("crowd").alias(f"c{x}"), *[F.col(s).alias(f"{s}{x}") for s in SIGNS]) for x in "ab")
    near = pairs.where("first").join(one, "a").join(two, "b").withColumn("apart", F.expr(SKETCHED)).where(f"apart <= na + nb - 2 * {NEED} and shared + least(ca, cb) + {BEHIND} >= {NEED}")
    near = stored(near.select("a", "b", "shared", "apart"), "near")
    led = near.where("shared = 0")
    closest = [led.groupBy(x).agg(F.min(F.struct("apart", y)).alias("best")).select(x, f"best.{y}").select("a", "b") for x, y in ("ab", "ba")]
    return near.where("shared > 0").select("a", "b").unionByName(closest[0]).unionByName(closest[1]).distinct()


def sets_of(docs: DataFrame, sets: DataFrame, order, width: int) -> DataFrame:
    """digest, n and the ordered set of each of ``sets`` (rep: id of a document that has it)."""
    ids = sets.select(F.col("rep").alias("doc_id"), F.col("digest").alias("wanted"))
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    rows = docs.select(F.col("doc_id").alias("own"), "text").join(ids, F.col("own").eqNullSafe(F.col("doc_id"))).select("wanted", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Order = order.value
        for batch in batches:
            wanted, found = batch.column(0).to_pylist(), [known.keys(g) if (len(g) and digest(g) == w) else None for g, w in zip(shingles(batch.column(1), width), batch.column(0).to_pylist(), strict=True)]
            at = [i for i, f in enumerate(found) if f is not None]
            yield pa.RecordBatch.from_arrays([pa.array([wanted[i] for i in at], pa.int64()), pa.array([len(found[i]) for i in at], pa.int32()), pa.array([found[i].tobytes() for i in at], pa.binary())], ["digest", "n", "grams"])
        trim()

    return rows.mapInArrow(run, "digest long, n int, grams binary")


def verified(pairs: DataFrame, sets: DataFrame, blocks: int) -> DataFrame:
    """The pairs (a, b) that reach the threshold.  The candidates of one set are split into parts of about PART."""
    width = pairs.groupBy("a").agg(F.count("*").alias("members"))
    parted = pairs.join(width, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.floor(F.col("members") / PART) + 1).alias("part"))
    parted = parted.withColumn("block", F.pmod(F.xxhash64("a", "part"), F.lit(blocks)).cast("int"))
    queries = parted.select("block", "a", "part", F.lit(None).cast("long").alias("b"), F.col("a").alias("digest")).distinct()
    members = parted.select("block", "a", "part", "b", F.col("b").alias("digest"))
    wanted = queries.unionByName(members)
    if pairs.count() <= BROADCAST_IDS:  # so that sets travel once, to their block
        wanted = F.broadcast(wanted)
    held = wanted.join(sets, "digest").select("block", "a", "part", "b", "grams")

    def run(table: pa.Table) -> pa.Table:
        groups: dict = {}
        for a, part, b, grams in zip(*(table.column(c).to_pylist() for c in ("a", "part", "b", "grams")), strict=True):
            groups.setdefault((a, part), {})[b] = np.frombuffer(grams, dtype=U64)
        left, right = [], []
        for (a, _), own in groups.items():
            query = own.pop(None, None)
            if query is None:
                continue
            names = sorted(own)
            similar = PrefixTree([own[x] for x in names]).similar(query)
            left += [a] * len(similar)
            right += [names[i] for i in similar]
        out = pa.table({"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())})
        del groups
        trim()
        return out

    return held.groupBy("block").applyInArrow(run, "a long, b long")


def unsettled(large: DataFrame, labels: DataFrame, done: DataFrame, pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Pairs of sets that share large meetings, lie in different components, can still reach the overlap and are not ``done``.

    A similar pair whose first common n-gram is one of a small meeting is done already.  Else it is one of these, and the
    positional filter asks for that.  What a pair shares among its first n-grams is known of small meetings, from ``pairs``, and
    is at most all of the large ones of either.
    """
    # Of meetings with the same members (the n-grams of one shared passage) the first in the order is enough: what a pair has
    # in common in any of them it has in that one, and earlier.
    who = large.groupBy("meeting").agg(F.count("*").alias("x1"), F.bit_xor(F.xxhash64("digest")).alias("x2"), F.sum(F.shiftright(F.xxhash64("digest", F.lit(1)), 32)).alias("x3"))
    first = who.groupBy("x1", "x2", "x3").agg(F.min(F.col("meeting").bitwiseXOR(F.lit(-(1 << 63)))).alias("m")).select(F.col("m").bitwiseXOR(F.lit(-(1 << 63))).alias("meeting"))
    crowd = large.groupBy("digest").agg(F.count("*").alias("c"))
    member = large.join(first, "meeting").join(labels.select(F.col("v").alias("digest"), "low"), "digest", "left").withColumn("low", F.coalesce("low", "digest"))
    mixed_ones = member.groupBy("meeting").agg(F.min("low").alias("x"), F.max("low").alias("y")).where("x <> y").select("meeting")
    member = member.join(mixed_ones, "meeting").join(sketches, "digest").join(crowd, "digest")
    one, two = (member.select("meeting", F.col("digest").alias(x), F.col("low").alias(f"l{x}"), F.col("n").alias(f"n{x}"), F.col("place").alias(f"p{x}"), F.col("c").alias(f"c{x}"), *[F.col(s).alias(f"{s}{x}") for s in SIGNS]) for x in "ab")
    met = one.join(two, "meeting").where("a < b and la <> lb").where(f"least(na - pa, nb - pb) >= {NEED} and {SKETCHED} <= na + nb - 2 * {NEED}").select("a", "na", "ca", "b", "nb", "cb").distinct()
    small = pairs.select(F.col("a").alias("x"), F.col("b").alias("y"), "shared")
    met = met.join(small, (F.col("a") == F.col("x")) & (F.col("b") == F.col("y")), "left").where(f"least(ca, cb) + coalesce(shared, 0) + {BEHIND} >= {NEED}")
    done = done.select(F.col("a").alias("x"), F.col("b").alias("y"))
    return met.select("a", "b").join(done, (F.col("a") == F.col("x")) & (F.col("b") == F.col("y")), "left_anti")


def join(docs: DataFrame, width: int = WORDS) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): doc_id, n_shingles, digest of its set and component (a digest)."""
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    shards = shard_count(spark)  # a block has the sets of its entries besides, so more shards send more
    order = spark.sparkContext.broadcast(frequent(docs, width))  # at most FREQUENT hashes
    met = stored(meetings(digested(docs, order, width, shards), shards), "meetings")
    discard()
    sets = stored(met.where("kind = 2").select("doc_id", "digest", F.col("n").cast("long").alias("n"), *SIGNS), "sets")
    large = stored(met.where("kind = 1").select("meeting", "digest", "n", "place"), "large")
    pairs = stored(candidate_pairs(met.where("kind = 0").select("shard", "block")), "pairs")
    discard(met)
    reps = sets.where("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("rep"))

    def checked(pairs: DataFrame) -> DataFrame:
        needed = pairs.select(F.col("a").alias("digest")).union(pairs.select("b")).distinct()
        return stored(verified(pairs, sets_of(docs, reps.join(needed, "digest"), order, width), shards), "edges")

    sketches = stored(sets.where("digest is not null").groupBy("digest").agg(*[F.first(s).alias(s) for s in SIGNS]), "sketches")
    chosen = stored(likely(pairs, sketches, large), "chosen")
    edges = checked(chosen)
    labels = components(edges)
    more = stored(unsettled(large, labels, chosen, pairs, sketches), "more")
    discard(large, chosen, sketches, pairs)
    if not more.isEmpty():
        labels = components(edges.unionByName(checked(more)))
    discard(more, edges)
    return sets.join(labels.select(F.col("v").alias("digest"), "low"), "digest", "left").select("doc_id", F.col("n").alias("n_shingles"), "digest", F.coalesce("low", "digest").alias("component"))


def groups(docs: DataFrame, width: int = WORDS) -> DataFrame:
    """doc_id, n_shingles and component_id, the least doc_id that links reach, for every row."""
    rows = join(docs, width)
    least = rows.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return rows.join(least, "component", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, width: int = WORDS) -> DataFrame:
    """``docs`` with one document of each group of similar ones, that of the least id; columns stay as they are.

    A document without words is kept; so is a row without an id.  Of rows that repeat an id and a text one stays.
    """
    found = stored(groups(docs, width), "groups")
    gone = found.where("component_id <> doc_id").select(F.col("doc_id").alias("weft_gone")).distinct()
    safe, names = shielded(docs, ["weft_gone"])
    kept = safe.join(gone, F.col("doc_id").cast("long") == F.col("weft_gone"), "left_anti")
    if not found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty():
        alone = kept.where("doc_id is null")
        kept = kept.where("doc_id is not null").dropDuplicates(["doc_id", "text"]).unionByName(alone)
    return kept.select(*safe.columns).toDF(*names)

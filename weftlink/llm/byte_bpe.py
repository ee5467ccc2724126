"""Byte-level BPE encoding and decoding in linear time.

Bytes are mapped to Latin-1 so that a pyahocorasick automaton over the
vocabulary finds longest matches.  A sequence of tokens is the BPE encoding of a
string exactly when every adjacent pair is the encoding of its concatenation, so
the encoder starts from the longest matches, checks neighbours against a memo
and backtracks to shorter tokens only where a pair is incompatible.  Every
position is left for good once it proves to be a dead end, and a step looks at no more bytes than the longest token has,
hence linear time.

Defined cases: a null text is empty; an empty text has no tokens; texts of any
length are encoded whole, since matches of the split pattern are independent;
other columns of the input are left alone.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, trim

#: Matches of up to REMEMBERED_BYTES that each of the encoder's two generations remembers, and pairs that its memo holds: together
#: less than 80 MB in a worker, while a task runs.
REMEMBERED, REMEMBERED_BYTES, PAIRS = 80_000, 64, 200_000


class Encoder:
    """Encodes and decodes with the ranks of a tiktoken vocabulary file."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import ahocorasick
        import regex

        self.ranks, self.find = ranks, regex.compile(pattern).findall
        self.bytes = {i: t for t, i in ranks.items()}
        self.latin = {t.decode("latin-1"): i for t, i in ranks.items()}
        self.size = {i: len(t) for t, i in ranks.items()}
        self.longest = max(self.size.values(), default=1)
        #: For each token the longest other token that it begins with, or -1.
        self.prefix = {i: next((ranks[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in ranks), -1) for t, i in ranks.items()}
        self.automaton = ahocorasick.Automaton()
        for text, i in self.latin.items():
            self.automaton.add_word(text, i)
        self.automaton.make_automaton()
        #: For each token its last merge, () for a single byte, None if no merges lead to it.
        self.part: dict[int, tuple[int, ...] | None] = {}
        self.joint: dict[tuple[int, int], int] = {}
        for text, i in sorted(ranks.items(), key=lambda x: x[1]):
            last = self.merged(text, i) if len(text) > 1 else []
            self.part[i] = () if len(text) == 1 else tuple(last) if len(last) == 2 else None
            if len(last) == 2:
                self.joint[last[0], last[1]] = i
        self.pairs: dict[int, bool] = {}
        self.young: dict[str, tuple[str, bytes]] = {}
        self.old: dict[str, tuple[str, bytes]] = {}

    @classmethod
    def from_file(cls, path: str, pattern: str) -> Encoder:
        with open(path, "rb") as f:
            return cls({base64.b64decode(t): int(i) for t, i in (line.split() for line in f if line.strip())}, pattern)

    def merged(self, text: bytes, below: int = 1 << 60) -> list[int]:
        """Plain merging: join the adjacent parts of lowest rank under ``below``, leftmost first, until none is left."""
        parts = [text[i : i + 1] for i in range(len(text))]
        while len(parts) > 1:
            ranked = [(self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))]
            rank, i = min(ranked)
            if rank >= below:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def fits(self, a: int, b: int) -> bool:
        """Whether the tokens a, b are the encoding of their concatenation."""
        key = a << 32 | b
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self.border_holds(a, b)
        return known

    def border_holds(self, a: int, b: int) -> bool:
        """Whether no merge crosses the border of a and b at any time while each is being built.

        Merges run by rank, so the border is undone level by level: the later-made side falls back to
        the part of it that touches the border, and a joint token must not have come before that.
        """
        joint, part = self.joint, self.part
        if part[a] is None or part[b] is None:  # no merges lead to one of them, so the rule cannot be used
            return self.merged(self.bytes[a] + self.bytes[b]) == [a, b]
        before = 1 << 60  # the joint token would have had to be made before this rank
        while True:
            if joint.get((a, b), before) < before:
                return False
            left, right = part[a], part[b]
            if not left and not right:
                return True
            if left and (not right or a > b):
                before, a = a, left[1]
            else:
                before, b = b + 1, right[0]

    def match(self, text: bytes) -> list[int]:
        """Ids of one match of the split pattern."""
        whole = self.ranks.get(text)
        if whole is not None:
            return [whole]
        latin = text.decode("latin-1")
        return self.backtracked(latin) or self.merged(text)

    def longest_at(self, latin: str, start: int) -> int:
        """The longest token at ``start``, or -1."""
        rest = latin[start : start + self.longest]  # no token is longer, so a step costs the same in a match of any length
        n = self.automaton.longest_prefix(rest)  # of any path in the trie; the token may be shorter
        while n:
            i = self.latin.get(rest[:n])
            if i is not None:
                return i
            n -= 1
        return -1

    def backtracked(self, latin: str) -> list[int]:
        dead: set[int] = set()  # positions from which no continuation fits what stands before them
        ids: list[int] = []
        size, prefix, fits, end = self.size, self.prefix, self.fits, len(latin)
        start, i = 0, self.longest_at(latin, 0)
        while True:
            while i >= 0 and (start + size[i] in dead or ids and not fits(ids[-1], i)):
                i = prefix[i]
            if i >= 0:
                ids.append(i)
                start += size[i]
                if start == end:
                    return ids
                i = self.longest_at(latin, start)
            elif ids:
                dead.add(start)
                last = ids.pop()
                start -= size[last]
                i = prefix[last]
            else:
                return []

    def remembered(self, piece: str) -> tuple[str, bytes]:
        """Decimal ids joined by commas, and the bytes that they decode to, of one match."""
        hit = self.young.get(piece)
        if hit is None:
            hit = self.old.get(piece)
            if hit is None:
                ids = self.match(piece.encode())
                hit = ",".join(map(str, ids)), self.decode(ids)
            if len(self.young) >= REMEMBERED:
                self.old, self.young = self.young, {}
            if len(piece) <= REMEMBERED_BYTES:
                self.young[piece] = hit
        return hit

    def encode_joined(self, text: str) -> tuple[str, bytes]:
        """Decimal ids of a whole text joined by commas, and the decoded bytes."""
        get, slow = self.young.get, self.remembered
        parts = [get(p) or slow(p) for p in self.find(text)]
        return ",".join([p[0] for p in parts]), b"".join([p[1] for p in parts])

    def encode(self, text: str) -> list[int]:
        joined = self.encode_joined(text)[0]
        return [int(i) for i in joined.split(",")] if joined else []

    def forget(self) -> None:
        """Drop what is remembered: a worker holds nothing between tasks but the vocabulary."""
        self.pairs, self.young, self.old = {}, {}, {}

    def decode(self, ids) -> bytes:
        return b"".join([self.bytes[i] for i in ids])


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """One encoder for each worker process and vocabulary."""
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = Encoder.from_file(path, pattern)
    return _ENCODERS[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """All columns of ``docs`` and the array ``ids`` with the token ids of the whole text."""
    prepare(docs.sparkSession)

    @F.arrow_udf("array<int>")
    def run(column: pa.Array) -> pa.Array:
        own = encoder(path, pattern)
        return pa.array([own.encode(t or "") for t in column.to_pylist()], pa.list_(pa.int32()))

    return docs.withColumn(ids, run(F.col(text)))


def decode(rows: DataFrame, path: str, pattern: str, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """All columns of ``rows`` and the binary ``out`` with the bytes of the array ``ids``; null ids give null."""
    prepare(rows.sparkSession)

    @F.arrow_udf("binary")
    def run(column: pa.Array) -> pa.Array:
        own = encoder(path, pattern)
        return pa.array([None if x is None else own.decode(x) for x in column.to_pylist()], pa.binary())

    return rows.withColumn(out, run(F.col(ids)))


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every text, from one pass of the encoder.

    Encoding, joining and hashing share a pass so that no id array leaves the worker.
    """
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim()  # what the stages before have left in this worker
        own = encoder(path, pattern)
        for batch in batches:
            counts, ids, decoded = [], [], []
            for text in batch.column(1):
                joined, back = own.encode_joined(text.as_py() or "")
                counts.append(joined.count(",") + 1 if joined else 0)
                ids.append(hashlib.sha256(joined.encode()).hexdigest())
                decoded.append(hashlib.sha256(back).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        own.forget()
        trim()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")

"""Token counts under a unigram tokenizer, by dynamic programming over a trie of distinct words.

The best segmentation of a word is found from its prefixes, so words that begin
alike share the scores of their common prefix.  The distinct words of a batch are
sorted into a trie whose nodes are visited level by level; at each level NumPy
scores all nodes at once from the nodes up to ``longest piece`` levels above.
The counts stored at terminal nodes are looked up for every word of every text,
and remembered by the worker for the batches to come.

Scores are integers, so ties are exact: of segmentations with the greatest total
score the one with the fewest tokens counts.  A character that is no piece costs
one token for each of its UTF-8 bytes.

Defined cases: a null or blank text has 0 tokens; texts and words of any length
are read whole (words beyond ``LONG`` characters are scored one by one); repeated
rows are counted one by one; other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACED_WORD, U64, prepare, running, span_hashes, spans, text_buffer, word_hashes

#: Mark that stands before a word in the pieces of the vocabulary.
WORD_MARK = "▁"
LONG = 128
#: Words whose counts a worker remembers.
REMEMBERED = 1_500_000
_TIE = 1 << 20


class Vocabulary:
    """Pieces with integer scores."""

    def __init__(self, pieces: dict[str, int], byte_score: int):
        """byte_score: score of a character that is no piece, whatever its bytes."""
        self.pieces, self.byte_score = pieces, byte_score
        self.longest = max(map(len, pieces), default=1)
        joined = np.frombuffer("".join(pieces).encode("utf-32-le"), dtype=np.uint32)
        ends = np.cumsum([len(p) for p in pieces]).astype(np.int64)
        starts = ends - np.array([len(p) for p in pieces], dtype=np.int64)
        hashes = span_hashes(running(joined), starts, ends)
        order = np.argsort(hashes)
        self.hashes, self.scores = hashes[order], np.array(list(pieces.values()), dtype=np.int64)[order]

    @classmethod
    def from_sentencepiece(cls, path: str) -> Vocabulary:
        """Pieces of a model file; a piece's score is that of its rank under Zipf's law, times 10,000."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        pieces = {model.id_to_piece(i): -round(1e4 * log(i + 1)) for i in range(n) if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i))}
        return cls(pieces, -round(1e4 * (log(n + 1) + 10)))

    def one(self, word: str) -> tuple[int, int]:
        """(score, tokens) of one pre-token, character by character."""
        best: list[tuple[int, int]] = [(0, 0)]
        for end in range(1, len(word) + 1):
            options = []
            for n in range(1, min(self.longest, end) + 1):
                score = self.pieces.get(word[end - n : end])
                if score is not None:
                    options.append((best[end - n][0] + score, best[end - n][1] - 1))
            if word[end - 1] not in self.pieces:
                options.append((best[end - 1][0] + self.byte_score, best[end - 1][1] - len(word[end - 1].encode("utf-8", "replace"))))
            best.append(max(options))
        return best[-1][0], -best[-1][1]

    def counts(self, words: list[str]) -> np.ndarray:
        """Tokens of each of the distinct pre-tokens ``words``."""
        out = np.zeros(len(words), dtype=np.int64)
        short = sorted((i for i, w in enumerate(words) if len(w) <= LONG), key=words.__getitem__)
        for i, w in enumerate(words):
            if len(w) > LONG:
                out[i] = self.one(w)[1]
        if not short:
            return out
        chars = np.frombuffer("".join([words[i] for i in short]).encode("utf-32-le"), dtype=np.uint32)
        sizes = np.array([len(words[i]) for i in short], dtype=np.int64)
        starts = np.cumsum(sizes) - sizes
        sums = running(chars)
        width = 1 + (chars >= 0x80).astype(np.int64) + (chars >= 0x800) + (chars >= 0x10000)
        active, final = np.arange(len(short)), np.zeros(len(short), dtype=np.int64)
        values, node = [np.zeros(1, dtype=np.int64)], [np.zeros(len(short), dtype=np.int64)]  # for each level
        for depth in range(1, int(sizes.max()) + 1):
            active = active[sizes[active] >= depth]
            h = span_hashes(sums, starts[active], starts[active] + depth)
            fresh = np.ones(len(active), dtype=bool)
            fresh[1:] = h[1:] != h[:-1]  # the words are sorted, so a node's words are neighbours
            first, here = active[fresh], np.zeros(len(short), dtype=np.int64)
            here[active] = np.cumsum(fresh) - 1
            best = np.full(len(first), np.iinfo(np.int64).min // 2, dtype=np.int64)
            end = starts[first] + depth
            for n in range(1, min(depth, self.longest) + 1):
                part = span_hashes(sums, end - n, end)
                at = np.minimum(np.searchsorted(self.hashes, part), len(self.hashes) - 1)
                known = self.hashes[at] == part
                before = values[depth - n][node[depth - n][first]]
                best = np.where(known, np.maximum(best, before + self.scores[at] * _TIE - 1), best)
                if n == 1:
                    best = np.where(known, best, before + self.byte_score * _TIE - width[end - 1])
            values.append(best)
            node.append(here)
            if depth > self.longest:
                values[depth - self.longest - 1] = node[depth - self.longest - 1] = np.zeros(0, dtype=np.int64)
            done = active[sizes[active] == depth]
            final[done] = -best[here[done]] % _TIE
        out[short] = final
        return out


class Counter:
    """Counts the tokens of texts and remembers those of words."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.known, self.tokens = np.zeros(0, U64), np.zeros(0, np.int32)
        self.new: list[tuple[np.ndarray, np.ndarray]] = []

    def find(self, hashes: np.ndarray, known: np.ndarray, tokens: np.ndarray, out: np.ndarray) -> None:
        if len(known):
            at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            hit = known[at] == hashes
            out[hit] = tokens[at[hit]]

    def remember(self, hashes: np.ndarray, tokens: np.ndarray) -> None:
        self.new.append((hashes, tokens.astype(np.int32)))
        fresh = sum(len(h) for h, _ in self.new)
        if fresh > max(50_000, len(self.known) // 4) or len(self.new) > 8:
            parts = self.new if len(self.known) + fresh > REMEMBERED else [(self.known, self.tokens), *self.new]
            h, t = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            order = np.argsort(h)
            self.known, self.tokens, self.new = h[order], t[order], []

    def counts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Words and tokens of each text."""
        data, at = text_buffer(column)
        starts, ends, first = spans(data, at, SPACED_WORD)
        hashes, where, which = np.unique(word_hashes(data, starts, ends), return_index=True, return_inverse=True)
        tokens = np.full(len(hashes), -1, dtype=np.int64)
        for known, n in [(self.known, self.tokens), *self.new]:
            self.find(hashes, known, n, tokens)
        unknown = np.flatnonzero(tokens < 0)
        if len(unknown):
            raw = data.tobytes()
            words = [WORD_MARK + raw[a:b].decode() for a, b in zip(starts[where[unknown]].tolist(), ends[where[unknown]].tolist(), strict=True)]
            tokens[unknown] = self.vocabulary.counts(words)
            self.remember(hashes[unknown], tokens[unknown])
        total = np.concatenate([[0], np.cumsum(tokens[which])])
        return np.diff(first), total[first[1:]] - total[first[:-1]]


_COUNTERS: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(Vocabulary.from_sentencepiece(path))
    return _COUNTERS[path]


def count_tokens(docs: DataFrame, path: str, text: str = "text", words: str = "n_words", tokens: str = "n_tokens") -> DataFrame:
    """All columns of ``docs`` and the numbers of words and of tokens under the vocabulary at ``path``."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for batch in batches:
            n_words, n_tokens = own.counts(batch.column(text))
            made = {words: pa.array(n_words, pa.int64()), tokens: pa.array(n_tokens, pa.int64())}
            yield pa.RecordBatch.from_arrays([made.get(c, batch.column(c)) for c in batch.schema.names], names=batch.schema.names)

    frame = docs.withColumns({words: F.lit(None).cast("long"), tokens: F.lit(None).cast("long")})
    return frame.mapInArrow(run, frame.schema)


def report(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_words and n_tokens of every document."""
    return count_tokens(docs.select(F.col("doc_id").cast("long"), "text"), path).select("doc_id", "n_words", "n_tokens")

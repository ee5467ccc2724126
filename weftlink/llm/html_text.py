"""Main text of HTML pages by a recurrent block labeller.

A page becomes the sequence of its leaf text blocks.  Each block is a vector of
learned embeddings of its tag path (tag names, class and id words, roles) and of
its hashed words; a bidirectional LSTM in NumPy reads the whole sequence, so each
block is labelled with the page as context, and the blocks labelled as main text
are joined.

The labeller is trained here, on a bounded sample of the corpus' pages (``SAMPLE_PAGES``)
whose blocks are labelled by their place in semantic elements, and on
pages composed from the same texts with varied furniture (menus, headers,
sidebars, notices, adverts, forms, comments) and naming, so that it does not
hang on one template.

Defined cases: null or empty html gives an empty text; truncated pages, unclosed
tags and stray end tags are read as far as they go; repeated rows are read one by
one; other columns are left alone.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, SPACED_WORD, prepare, spans, text_buffer, word_hashes

#: Pages that the labeller is fitted on, at most; pages composed for each of them; bytes read of each sample page.
SAMPLE_PAGES, COMPOSED, SAMPLE_BYTES = 160, 3, 60_000
#: For composed training pages: furniture texts to draw from, and characters taken of a block. Extraction itself reads whole pages.
SAMPLE_NOTES, SAMPLE_CHARS = 4000, 600
PATH_ROWS, WORD_ROWS, WIDTH, HIDDEN = 2048, 2048, 12, 16
EPOCHS, RATE, DECAY = 16, 0.02, 0.01
#: Sizes of the runs of blocks labelled in one NumPy batch.
BATCH_BLOCKS = 40_000

# Element names of HTML.
#: Text of these runs to their end tag; no tags are read in it.
RAW = {"script", "style", "textarea", "title", "iframe"}
#: Elements whose text and inner elements are never shown as text of the page.
UNSHOWN = {"noscript", "template", "svg", "math", "select", "option", "object"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "rb", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img"}
#: An open element of these ends when one of the same group starts.
CLOSES = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}
CLOSES |= {x: {"p"} for x in ("div", "ul", "ol", "table", "section", "article", "aside", "nav", "header", "footer", "main", "form", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "figure", "address", "fieldset")}

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_SPLIT = re.compile(r"[^A-Za-z0-9]+")
_SPACE = re.compile(r"\s+")
_ENDS = {x: re.compile(rf"</{x}\b[^>]*(?:>|\Z)", re.I) for x in RAW}


def blocks(page: str) -> list[tuple[tuple[str, ...], str]]:
    """Leaf text blocks in page order: (tag path with class, id and role words, text with references decoded).

    The path is that of all open elements, at any depth, each word once: nesting alike elements does not drown the others.
    """
    out: list[tuple[tuple[str, ...], str]] = []
    stack: list[tuple[str, tuple[str, ...], bool]] = []  # element, path so far, hidden
    parts: list[str] = []
    path: tuple[str, ...] = ()

    def flush():
        if parts:
            text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
            parts.clear()
            if text:
                out.append((path, text))

    def here():
        return stack[-1][1] if stack else ()

    at = 0
    while True:
        m = _TOKEN.search(page, at)
        if not m:
            if not (stack and stack[-1][2]):
                parts.append(page[at:])
            break
        if m.start() > at and not (stack and stack[-1][2]):
            if not parts:
                path = here()
            parts.append(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if tag not in INLINE:
            flush()
        if m[1]:
            depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag), None)
            if depth is not None:
                del stack[depth:]
            continue
        if tag == "head":
            continue
        if tag in RAW:
            end = _ENDS[tag].search(page, at)
            if not m[3].rstrip().endswith("/"):
                at = end.end() if end else len(page)
            flush()
            continue
        if tag in VOID or tag in UNSHOWN and m[3].rstrip().endswith("/"):
            continue
        if tag in CLOSES:
            depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] in CLOSES[tag]), None)
            if depth is not None and all(t in INLINE or t in CLOSES[tag] for t, _, _ in stack[depth:]):
                del stack[depth:]
        words = [tag]
        if m[3]:
            words += [f"{a[1].lower()}:{w.lower()}" for a in _ATTRIBUTE.finditer(m[3]) for w in _SPLIT.split(a[2] or a[3] or a[4] or "") if w]
        known = here()
        new = tuple(dict.fromkeys(w for w in words if w not in known))
        stack.append((tag, known + new if new else known, tag in UNSHOWN or bool(stack and stack[-1][2])))
    if parts and not path:
        path = here()
    flush()
    return out


def bucket(word: str, rows: int) -> int:
    h = 2166136261
    for b in word.encode():
        h = (h ^ b) * 16777619 & 0xFFFFFFFF
    return (h ^ h >> 15) % rows


_BUCKETS: dict[str, int] = {}


def path_rows(path: tuple[str, ...]) -> list[int]:
    """Rows of the distinct words of a path."""
    if len(_BUCKETS) > 100_000:
        _BUCKETS.clear()
    out = []
    for w in dict.fromkeys(path):
        if w not in _BUCKETS:
            _BUCKETS[w] = bucket(w, PATH_ROWS)
        out.append(_BUCKETS[w])
    return out or [0]


class Bags:
    """Blocks of pages as bags of path rows and of word rows."""

    def __init__(self, pages: list[list[tuple[tuple[str, ...], str]]]):
        self.sizes = np.array([len(p) for p in pages], dtype=np.int64)
        known: dict[tuple[str, ...], int] = {}  # blocks share their paths, deep ones above all
        self.path_of = np.array([known.setdefault(b[0], len(known)) for p in pages for b in p], dtype=np.int64)
        paths = [path_rows(x) for x in known]
        self.paths = np.array([i for x in paths for i in x], dtype=np.int64)
        self.path_at = np.concatenate([[0], np.cumsum([len(x) for x in paths])]).astype(np.int64)
        data, at = text_buffer(pa.array([b[1] for p in pages for b in p], pa.large_string()))
        data = LOWER[data]
        starts, ends, first = spans(data, at, SPACED_WORD)
        self.words = (word_hashes(data, starts, ends) % np.uint64(WORD_ROWS)).astype(np.int64)
        self.word_at = first.astype(np.int64)
        self.length = np.log1p(np.diff(first)).astype(np.float32)


def bag_sums(table: np.ndarray, rows: np.ndarray, at: np.ndarray) -> np.ndarray:
    sums = np.zeros((len(rows) + 1, table.shape[1]))
    np.cumsum(table[rows], axis=0, out=sums[1:])
    return (sums[at[1:]] - sums[at[:-1]]) / bag_weight(at)[:, None]


def bag_weight(at: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(np.diff(at), 1))


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Bidirectional LSTM over block vectors, one logistic output for each block."""

    SIZE = 2 * WIDTH + 1

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        self.w = {"path": r.normal(0, 0.3, (PATH_ROWS, WIDTH)), "word": r.normal(0, 0.03, (WORD_ROWS, WIDTH)), "out": r.normal(0, 0.2, 2 * HIDDEN + self.SIZE), "bias": np.zeros(1)}
        for side in "fb":
            self.w[f"{side}x"] = r.normal(0, self.SIZE**-0.5, (self.SIZE, 4 * HIDDEN))
            self.w[f"{side}h"] = r.normal(0, HIDDEN**-0.5, (HIDDEN, 4 * HIDDEN))
            self.w[f"{side}0"] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])

    def vectors(self, bags: Bags) -> np.ndarray:
        return np.concatenate([bag_sums(self.w["path"], bags.paths, bags.path_at)[bags.path_of], bag_sums(self.w["word"], bags.words, bags.word_at), bags.length[:, None] / 5], axis=1)

    def side(self, x: np.ndarray, mask: np.ndarray, name: str, keep: bool) -> tuple[np.ndarray, list]:
        """Hidden states (steps x pages x HIDDEN); a masked step leaves the state as it was."""
        steps, pages, _ = x.shape
        h, c = np.zeros((pages, HIDDEN)), np.zeros((pages, HIDDEN))
        gates_x, wh, out, tape = x @ self.w[f"{name}x"] + self.w[f"{name}0"], self.w[f"{name}h"], np.empty((steps, pages, HIDDEN)), []
        for t in range(steps):
            a = gates_x[t] + h @ wh
            s = sigmoid(a[:, : 3 * HIDDEN])
            i, f, o, g = s[:, :HIDDEN], s[:, HIDDEN : 2 * HIDDEN], s[:, 2 * HIDDEN :], np.tanh(a[:, 3 * HIDDEN :])
            m = mask[t][:, None]
            new = f * c + i * g
            th = np.tanh(new)
            if keep:
                tape.append((h, c, i, f, o, g, th, m))
            c = np.where(m, new, c)
            h = np.where(m, o * th, h)
            out[t] = h
        return out, tape

    def side_back(self, x: np.ndarray, tape: list, d_out: np.ndarray, name: str, grad: dict) -> np.ndarray:
        dx, dh, dc = np.zeros_like(x), np.zeros(d_out.shape[1:]), np.zeros(d_out.shape[1:])
        for t in range(len(tape) - 1, -1, -1):
            h0, c0, i, f, o, g, th, m = tape[t]
            dh = dh + d_out[t]
            dn = np.where(m, dc + dh * o * (1 - th * th), 0)
            da = np.concatenate([dn * g * i * (1 - i), dn * c0 * f * (1 - f), np.where(m, dh * th, 0) * o * (1 - o), dn * i * (1 - g * g)], axis=1)
            grad[f"{name}x"] += x[t].T @ da
            grad[f"{name}h"] += h0.T @ da
            grad[f"{name}0"] += da.sum(axis=0)
            dx[t] = da @ self.w[f"{name}x"].T
            dh = np.where(m, 0, dh) + da @ self.w[f"{name}h"].T
            dc = np.where(m, dn * f, dc)
        return dx

    def padded(self, v: np.ndarray, sizes: np.ndarray, back: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        first = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        step = np.arange(sizes.max() if len(sizes) else 0)[:, None]
        mask = step < sizes
        at = np.where(mask, first + (sizes - 1 - step if back else step), 0)
        return v[at], mask, at

    def scores(self, bags: Bags, tapes: list | None = None) -> np.ndarray:
        v = self.vectors(bags)
        hidden = np.zeros((len(v), 2 * HIDDEN))
        for k, name in enumerate("fb"):
            x, mask, at = self.padded(v, bags.sizes, name == "b")
            out, tape = self.side(x, mask, name, tapes is not None)
            hidden[at[mask], k * HIDDEN : (k + 1) * HIDDEN] = out[mask]
            if tapes is not None:
                tapes.append((x, mask, at, tape))
        both = np.concatenate([hidden, v], axis=1)
        if tapes is not None:
            tapes.append(both)
        return both @ self.w["out"] + self.w["bias"]

    def gradient(self, bags: Bags, labels: np.ndarray) -> dict[str, np.ndarray]:
        tapes: list = []
        d = (sigmoid(self.scores(bags, tapes)) - labels) / max(len(labels), 1)
        grad = {k: np.zeros_like(w) for k, w in self.w.items()}
        both = tapes[2]
        grad["out"], grad["bias"] = both.T @ d, np.array([d.sum()])
        d_both = d[:, None] * self.w["out"]
        dv = d_both[:, 2 * HIDDEN :].copy()
        for k, name in enumerate("fb"):
            x, mask, at, tape = tapes[k]
            d_out = np.where(mask[:, :, None], d_both[at, k * HIDDEN : (k + 1) * HIDDEN], 0)
            dx = self.side_back(x, tape, d_out, name, grad)
            np.add.at(dv, at[mask], dx[mask])
        by_path = np.zeros((len(bags.path_at) - 1, WIDTH))
        np.add.at(by_path, bags.path_of, dv[:, :WIDTH])
        for name, rows, at, d_bag in (("path", bags.paths, bags.path_at, by_path), ("word", bags.words, bags.word_at, dv[:, WIDTH : 2 * WIDTH])):
            np.add.at(grad[name], rows, np.repeat(d_bag / bag_weight(at)[:, None], np.diff(at), axis=0))
        return grad

    def fit(self, pages: list[list[tuple[tuple[str, ...], str]]], labels: list[list[int]], seed: int = 11) -> None:
        """Adam on batches of pages."""
        r = np.random.default_rng(seed)
        m, s, step = {k: np.zeros_like(w) for k, w in self.w.items()}, {k: np.zeros_like(w) for k, w in self.w.items()}, 0
        order = np.argsort([len(p) for p in pages], kind="stable")
        groups = [order[i : i + 16] for i in range(0, len(order), 16)]
        bags = [Bags([pages[i] for i in g]) for g in groups]
        for epoch in range(EPOCHS):
            for k in r.permutation(len(groups)):
                y = np.array([z for i in groups[k] for z in labels[i]], dtype=float)
                if not len(y):
                    continue
                step += 1
                for name, g in self.gradient(bags[k], y).items():
                    g = np.clip(g, -1, 1)
                    m[name] = 0.9 * m[name] + 0.1 * g
                    s[name] = 0.99 * s[name] + 0.01 * g * g
                    if name == "word":
                        self.w[name] *= 1 - DECAY
                    self.w[name] -= RATE * (1 - 0.8 * epoch / EPOCHS) * (m[name] / (1 - 0.9**step)) / (np.sqrt(s[name] / (1 - 0.99**step)) + 1e-6)

    def main_text(self, pages: list[str]) -> list[str]:
        out = [""] * len(pages)
        order = sorted(((blocks(p), i) for i, p in enumerate(pages)), key=lambda x: len(x[0]))
        k = 0
        while k < len(order):
            end = k + 1
            while end < len(order) and len(order[end][0]) * (end + 1 - k) <= BATCH_BLOCKS:
                end += 1
            run = order[k:end]
            keep = self.scores(Bags([b for b, _ in run])) > 0
            at = 0
            for b, i in run:
                out[i] = " ".join(x[1] for x, z in zip(b, keep[at : at + len(b)], strict=True) if z)
                at += len(b)
            k = end
        return out


# Names that mark page furniture, and names that mark main text.
FURNITURE = {"nav", "footer", "aside", "form", "header", "menu", "button", "dialog"}
FURNITURE_WORDS = {"ad", "ads", "advert", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "cookie", "cookies", "disclaimer", "footer", "header", "login", "menu", "nav", "navbar", "navigation", "newsletter", "notice", "pagination", "popup", "promo", "related", "reply", "respond", "search", "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget"}
MAIN = {"article", "main", "role:main", "itemprop:articlebody"}
MAIN_WORDS = ["content", "post", "entry", "story", "article", "body", "text", "main"]


def by_place(path: tuple[str, ...]) -> int:
    """Training label of a block: inside a main element, and in no furniture below or above it."""
    words = {w.rpartition(":")[2] for w in path}
    return int(bool(MAIN & set(path)) and not FURNITURE & set(path) and not FURNITURE_WORDS & words)


def composed(texts: list[str], notes: list[str], r: np.random.Generator) -> tuple[list[tuple[tuple[str, ...], str]], list[int]]:
    """Blocks and labels of a page made of main texts and furniture, named in one of many ways."""
    kinds = sorted(FURNITURE_WORDS)
    frame = [("html", "body"), ("html", "body", "div"), ("html", "body", "div", f"class:{r.choice(['wrap', 'page', 'container', 'site'])}")][r.integers(3)]
    word = MAIN_WORDS[r.integers(len(MAIN_WORDS))]
    core = [("article",), ("main",), ("main", "article"), ("div", f"class:{word}"), ("div", f"id:{word}"), ("article", f"class:{word}"), ("section", "role:main")][r.integers(7)]

    def furniture(inside: tuple[str, ...], least: int = 0):
        out = []
        for _ in range(r.integers(least, 3)):
            kind = kinds[r.integers(len(kinds))]
            tag = [("nav", "ul", "li", "a"), ("div", f"class:{kind}"), ("aside",), ("aside", f"class:{kind}", "p"), ("header",), ("footer",), ("form", "label"), ("form", f"class:{kind}", "p"), ("div", f"id:{kind}", "p"), ("section", f"class:{kind}"), ("section", f"class:{kind}", "div", "class:comment", "p"), ("div", f"class:{kind}", "ul", "li"), ("ul", f"class:{kind}", "li", "a"), ("p", f"class:{kind}"), ("div", "class:comments", "article", "p"), ("section", "id:comments", "p")][r.integers(16)]
            for _ in range(r.integers(1, 6)):
                source = texts if r.random() < 0.7 else notes
                own = source[r.integers(len(source))].split()
                size = int(r.integers(1, 30))
                low = int(r.integers(max(1, len(own) - size)))
                out.append((inside + tag, " ".join(own[low : low + size]) or "x", 0))
        return out

    rows = furniture(frame, 1)
    for k, text in enumerate(texts):
        if k and r.random() < 0.1:
            rows += furniture(frame + core)
        tag = ("h1",) if not k and r.random() < 0.7 else [("p",), ("p",), ("p",), ("p", "b"), ("p", "b", "p"), ("h2",), ("ul", "li"), ("blockquote", "p"), ("div",), ("p", "a"), ("p", "em"), ("pre",), ("table", "tr", "td"), ("div", "p"), ("section", "p"), ()][r.integers(16)]
        if r.random() < 0.4:  # short and repeated blocks are main text too, in any words
            own = (text if r.random() < 0.5 else notes[r.integers(len(notes))]).split()
            text = " ".join(own[: int(r.integers(1, 9))]) or text
        for _ in range(int(r.integers(2, 9)) if r.random() < 0.06 else 1):
            rows.append((frame + core + tag, text, 1))
    rows += furniture(frame + core) if r.random() < 0.3 else []
    rows += furniture(frame, 1)
    return [(p, t) for p, t, _ in rows], [y for _, _, y in rows]


def train(pages: DataFrame, sample: int = SAMPLE_PAGES) -> Labeller:
    """Fit a labeller on at most ``sample`` of the pages, chosen by a hash of their html."""
    held = pages.where("html is not null").select("html", F.crc32("html").alias("k"))
    share = min(1.0, 3 * sample / max(1, held.count()))  # so that few rows reach the driver, however many pages there are
    rows = held.where(F.col("k") < share * 2.0**32).select(F.substring("html", 1, SAMPLE_BYTES).alias("html"), "k").orderBy("k", "html").limit(sample).collect()
    r = np.random.default_rng(5)
    data, labels = [], []
    texts = [b for row in rows if (b := blocks(row["html"]))]
    notes = [t for b in texts for p, t in b if not by_place(p)][:SAMPLE_NOTES] or ["home contact about"]
    plain = ["About us", "Contact", "Log in or register to comment", "We use cookies", "Share this", "Related stories", "Subscribe now", "All rights reserved"]
    for b in texts or [[(("article", "p"), x)] for x in plain]:
        y = [by_place(p) for p, _ in b]
        if any(y):
            data.append(b)
            labels.append(y)
        body = [t for (_, t), z in zip(b, y, strict=True) if z] or [t for _, t in b]
        for _ in range(COMPOSED):
            size = int(r.integers(1, min(len(body), 25) + 1))
            low = int(r.integers(len(body) - size + 1))
            made, z = composed([x[:SAMPLE_CHARS] for x in body[low : low + size]], notes + plain * 3, r)
            data.append(made)
            labels.append(z)
    model = Labeller()
    model.fit(data, labels)
    return model


def extract(pages: DataFrame, model: Labeller | None = None, html_column: str = "html", out: str = "text") -> DataFrame:
    """All columns of ``pages`` and ``out`` with the main text of each page."""
    spark = pages.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(model or train(pages.select(F.col(html_column).alias("html"))))  # fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, done = batch.column(html_column), []
            for low in range(0, len(column), 250):
                done += shared.value.main_text([x or "" for x in column.slice(low, 250).to_pylist()])
            made = pa.array(done, pa.string())
            yield pa.RecordBatch.from_arrays([made if c == out else batch.column(c) for c in batch.schema.names], names=batch.schema.names)

    frame = pages.withColumn(out, F.lit(None).cast("string"))
    return frame.mapInArrow(run, frame.schema)


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    rows = extract(pages.select(F.col("page_id").cast("long"), "url", "html"))
    return rows.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))

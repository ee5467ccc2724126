"""Operators against brute force on a small fixture with odd rows: nulls, empty and long texts, ties, repeats, clashing columns."""

import collections
import hashlib
import re
import zlib
from math import log10

import numpy as np
import pytest

from weftlink.llm import byte_bpe, html_text, katz, kneser_ney, language_id, line_dedup, phrase_index, quality_ratio, shingle_join, unigram_counts

P = pytest.importorskip("public_tokenizers")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, shingles string"
DOCS = "doc_id long, text string, lang string"


def low(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s or "")


def texts():
    r = np.random.default_rng(3)
    vocabulary = ["".join(r.choice(list("abcdefé"), r.integers(1, 6))) for _ in range(150)]
    make = lambda n: " ".join(vocabulary[int(i)] for i in r.zipf(1.3, n) % 150)
    out = ["\n".join(make(int(r.integers(1, 25))) for _ in range(int(r.integers(1, 5)))) for _ in range(60)]
    for i in range(0, 30, 3):
        words = out[i].split(" ")
        words[len(words) // 2] = "changed"
        out.append(" ".join(words))
    return [*out, None, "", " \n ", "a", "A b c", "A B C", out[0], out[0].upper(), make(6000), "!!! ...", "x" * 5000]


TEXTS = texts()
BENCH = [(1, " ".join((TEXTS[4] or "").split()[:14])), (2, "a"), (3, None), (4, "!!"), (5, "no such words at all in any of the texts here today")]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["en", "de", None][i % 3], "s", 0, 1.0, "x") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, rows[5]], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, int(i % 4 != 0), int(i % 9 == 0)) for i in range(0, 60)] + [(None, 1, 0)], "doc_id long, quality int, toxic int")


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_bpe(docs, none):
    import base64

    import tiktoken

    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    twin = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = by_id(byte_bpe.digests(docs, path, P.PATTERN))
    for i, t in enumerate(TEXTS):
        ids = twin.encode_ordinary(t or "")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    back = byte_bpe.decode(byte_bpe.encode(docs, path, P.PATTERN), path, P.PATTERN)
    assert all(bytes(r.decoded).decode() == (r.text or "") for r in back.collect())
    assert byte_bpe.digests(none, path, P.PATTERN).count() == 0


def test_bpe_worker_memory():
    """What an encoder remembers takes less than 80 MB, and a worker keeps no tables of the stages before."""
    from sys import getsizeof

    from weftlink.llm import common

    own = byte_bpe.Encoder.from_file(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    for k in range(0, 20_000, 1000):
        own.encode_joined("".join(f" qz{i * 7919:x}{'ab' * (i % 9)}" for i in range(k, k + 1000)))
    pieces = sum(getsizeof(k) + getsizeof(v) + getsizeof(v[0]) + getsizeof(v[1]) for k, v in own.young.items()) / len(own.young)
    assert 2 * byte_bpe.REMEMBERED * (pieces + 100) + byte_bpe.PAIRS * 140 < 80 << 20
    common.powers(1000)
    common.trim()
    assert not common._POWERS


def test_decontamination(spark, docs, none):
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    windows = collections.defaultdict(set)
    for i, t in BENCH:
        w = PLAIN.findall(low(t))
        for k in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[k : k + 10])].add(str(i))
    got = by_id(phrase_index.report(docs, bench))
    for i, t in enumerate(TEXTS):
        w, hit, items = PLAIN.findall(low(t)), set(), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    items |= windows[tuple(w[k : k + n])]
        r = got[i]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (len(w), len(hit), len(items), bool(hit))
        assert r.items_sha256 == hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
    clean = phrase_index.clean(docs, bench)
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == {i for i, r in got.items() if not r.contaminated}
    assert phrase_index.report(none, bench).count() == 0
    assert not phrase_index.report(docs, bench.limit(0)).where("contaminated").count()
    near = by_id(phrase_index.matches(docs, bench, slop=2))
    assert "1" in near[4].near_items


@pytest.mark.parametrize("meeting", [12, 2])
def test_shingle_join(spark, docs, none, meeting, monkeypatch):
    monkeypatch.setattr(shingle_join, "MEETING", meeting)
    sets = {i: frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if (w := SPACED.findall(low(t))) else frozenset() for i, t in enumerate(TEXTS)}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    rows = shingle_join.groups(docs).collect()
    assert len(rows) == len(TEXTS) + 1
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in rows} == {(i, len(s), find(i)) for i, s in sets.items()}
    docs = docs.withColumnRenamed("score", "gone").withColumnRenamed("source", "weft_gone")
    kept = shingle_join.one_of_each(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [i for i in sets if find(i) == i]
    assert shingle_join.groups(none).count() == 0
    line = [f"w{k}" for k in range(40)]
    chain = [(7, line), (None, [*line[:38], "x", "y"]), (9, [*line[2:38], "x", "y"])]  # 7 and 9 are linked by the row without an id
    linked = shingle_join.groups(spark.createDataFrame([(i, " ".join(w)) for i, w in chain], "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in linked} == {7: 7, None: 7, 9: 7}


def test_shingle_join_entries_are_shuffled_only(spark, docs, monkeypatch):
    kinds = []
    real = shingle_join.stored
    monkeypatch.setattr(shingle_join, "stored", lambda df, name: kinds.append({r.kind for r in df.select("kind").distinct().collect()} if "kind" in df.columns else set()) or real(df, name))
    assert shingle_join.groups(docs).count() == len(TEXTS) + 1
    assert not any(1 in k and 2 not in k or k == {0, 1} for k in kinds) and {0, 2} <= set().union(*kinds)  # sets come out of the exchange of the entries


def test_prefix_tree():
    r = np.random.default_rng(1)
    base = np.sort(r.choice(10_000, 60, replace=False)).astype(np.uint64)
    sets = [np.sort(np.unique(np.where(r.random(60) < x, r.integers(10_000, 20_000, 60).astype(np.uint64), base))) for x in r.random(80) * 0.5]
    wanted = [i for i, s in enumerate(sets) if 100 * len(np.intersect1d(s, base)) >= 75 * len(np.union1d(s, base))]
    assert sorted(shingle_join.PrefixTree(sets).similar(base)) == wanted and 0 < len(wanted) < 80


@pytest.mark.parametrize("common", [1024, 6])
def test_line_dedup(docs, none, common, monkeypatch):
    monkeypatch.setattr(line_dedup, "COMMON", common)
    earlier, gone, held = [], {}, {}
    for i, t in enumerate(TEXTS):
        gone[i], held[i] = [], 0
        for k, line in enumerate((t or "").split("\n")):
            s = frozenset(SPACED.findall(line.lower()))
            if s:
                held[i] += 1
                if any(4 * len(s & e) >= 3 * len(s | e) for e in earlier):
                    gone[i].append(k)
                earlier.append(s)
    got = by_id(line_dedup.report(docs))
    for i in gone:
        assert (got[i].n_lines, got[i].removed_lines) == (held[i], ",".join(map(str, gone[i])))
    if common == 1024:
        odd = docs.withColumnsRenamed({"score": "weft_d", "shingles": "weft_r"})
        clean = line_dedup.cleaned(odd)
        assert clean.columns == odd.columns
        left = by_id(clean)
        assert set(left) == {i for i in gone if not gone[i] or len(gone[i]) < held[i]}
        assert all(left[i].text == (TEXTS[i] if not gone[i] else "\n".join(x for k, x in enumerate(TEXTS[i].split("\n")) if k not in gone[i])) for i in left)
        assert all((r.weft_d, r.weft_r) == (1.0, "x") for r in left.values())
        assert line_dedup.report(none).count() == 0


def test_line_dedup_group_of_near_copies(spark, monkeypatch):
    """A group of near copies, each with rare words of its own: what meets follows the group's size, not its square."""
    r = np.random.default_rng(5)
    base, n = [f"base{k}" for k in range(60)], 60
    lines = []
    for i in range(n):
        words = list(base)
        for at in r.choice(60, 3, replace=False):
            words[at] = f"rare{i}x{at}"
        lines.append(" ".join(words))
    rare = [w for x in lines for w in x.split() if w.startswith("rare")]
    rows = [(i, x) for i, x in enumerate(lines)] + [(1000 + i, f"{w} other{i} more{i} words{i} here{i}") for i, w in enumerate(rare)]  # each rare word occurs twice
    seen, real = [], line_dedup.met
    monkeypatch.setattr(line_dedup, "met", lambda *a: seen.append(real(*a)) or seen[-1])
    got = by_id(line_dedup.report(spark.createDataFrame(rows, "doc_id long, text string")))
    assert [got[i].n_removed for i in range(n)] == [0] + [1] * (n - 1) and not any(got[1000 + i].n_removed for i in range(len(rare)))
    assert sum(x.count() for x in seen) < 4 * n  # all pairs: 1770
    plans = [x._jdf.queryExecution().executedPlan().toString() for x in seen]
    assert all(p.count("LeftAnti") == 0 for p in plans)  # covered sets are marked, not joined away with all that a set carries


def test_line_dedup_places(spark):
    """Numbers made of id and line, and places that must be sorted, give the same."""
    text = ["a b c d e\nx y", "x y\nq r s t", None, "a b c d e"]
    make = lambda ids: spark.createDataFrame(list(zip(ids, text, strict=True)), "doc_id long, text string")
    removed = lambda ids: {(r.n_removed, r.removed_lines) for r in line_dedup.report(make(ids)).collect()}
    table = lambda ids: line_dedup.line_table(make(ids).withColumn("th", line_dedup.F.xxhash64("text")))
    assert line_dedup.packed(table([3, 5, 6, 9])) == "shiftleft(first.doc_id, 1) + first.line"
    assert all(line_dedup.packed(table(ids)) is None for ids in ([-4, 5, 6, 9], [None, 5, 6, 9], [3, 5, 6, 1 << 62], [3, 3, 6, 9]))
    assert removed([-4, 5, 6, 9]) == removed([3, 5, 6, 9]) == {(0, ""), (1, "0")}


def test_katz(docs, none, spark):
    rows = by_id(katz.score(docs))
    data = {i: SPACED.findall(low(t)) + [" e"] for i, t in enumerate(TEXTS)}
    times = {i: 2 if i == 5 else 1 for i in data}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in data}
    c1, c2, ch = collections.Counter(), collections.Counter(), collections.Counter()
    for i, w in data.items():
        for h, x in zip([" s", *w], w, strict=False):
            if not held[i]:
                c1[x] += times[i]
                c2[h, x] += times[i]
                ch[h] += times[i]
    n, v = sum(c1.values()), len(c1)
    d1, d2 = (katz.discounts(collections.Counter(c.values())) for c in (c1, c2))
    dd = lambda d, c: d[c] if c <= katz.K else 1.0
    unknown = 1 - sum(dd(d1, c) * c / n for c in c1.values())
    p1 = lambda w: dd(d1, c1[w]) * c1[w] / n if w in c1 else unknown
    after = collections.defaultdict(list)
    for (h, w), c in c2.items():
        after[h].append((w, c))
    full = {h: all(c > katz.K for _, c in s) for h, s in after.items()}
    alpha = {h: (1 / (ch[h] + 1) if full[h] else 1 - sum(dd(d2, c) * c for _, c in s) / ch[h]) / (1 - sum(p1(w) for w, _ in s)) for h, s in after.items()}
    p2 = lambda h, w: dd(d2, c2[h, w]) * c2[h, w] / (ch[h] + full[h]) if (h, w) in c2 else alpha.get(h, 1.0) * p1(w)
    for i, w in data.items():
        r = rows[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(w), sum(x in c1 for x in w), n)
        assert r.base_score == pytest.approx(sum(log10((c1[x] + 1) / (n + v + 1)) for x in w))
        assert r.score == pytest.approx(sum(log10(p2(h, x)) for h, x in zip([" s", *w], w, strict=False)))
    for h in list(after)[:5]:
        assert sum(p2(h, w) for w in c1) + alpha[h] * unknown == pytest.approx(1)
    assert katz.score(none).count() == 0


def test_token_counts(docs, none):
    path = P.path("piece_bpe_32k.model")
    vocabulary = unigram_counts.Vocabulary.from_sentencepiece(path)
    got = by_id(unigram_counts.report(docs, path))
    for i, t in enumerate(TEXTS):
        w = SPACED.findall(t or "")
        assert (got[i].n_words, got[i].n_tokens) == (len(w), sum(vocabulary.one(unigram_counts.WORD_MARK + x)[1] for x in w))
    assert unigram_counts.report(none, path).count() == 0


def test_quality_ratio(docs, labels, none):
    got = by_id(quality_ratio.judged(docs, labels))
    for i, t in enumerate(TEXTS):
        w = SPACED.findall(t or "")
        c = collections.Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        repeat = {k + j for k in range(len(w) - 2) if c[tuple(w[k : k + 3])] > 1 for j in range(3)}
        lines = [x for x in (t or "").split("\n") if SPACED.search(x)]
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in t or ""), len(lines) - len(set(lines)), len(repeat))
        assert r.base_failed == (len(w) < 50 or 100 * len(repeat) > 50 * len(w)) and not (r.kept and r.base_failed)
    limit = min(r.score for i, r in got.items() if r.kept)
    assert all(r.kept == (not r.base_failed and r.score >= limit) for r in got.values())
    assert quality_ratio.judged(none, labels).count() == 0
    assert all(r.kept == (not r.base_failed) for r in quality_ratio.judged(docs, labels.limit(0)).collect())


def test_kneser_ney(docs, labels, none, spark):
    kneser_ney.prepare(spark)
    model = kneser_ney.fit(docs.where("doc_id < 40"))
    rows = docs.select("doc_id", "text")
    one = by_id(kneser_ney.scored_by_broadcast(rows, model))
    two = by_id(kneser_ney.scored_by_join(rows, model))
    for i in one:
        assert one[i].n_chars == two[i].n_chars == len(TEXTS[i] or "") and one[i].logp == pytest.approx(two[i].logp, rel=1e-4, abs=1e-3)
    p = {r.gram: r.p for r in model.collect() if r.p is not None}
    context = next(g for g in p if len(g) == 4 and "\x02" not in g)
    g = {r.gram: r.gamma for r in model.collect()}

    def prob(h, c):
        if h + c in p:
            return p[h + c]
        return (g.get(h) or 1.0) * prob(h[1:], c) if h else p[""]

    assert sum(prob(context, c) for c in {x for x in p if len(x) == 1}) + prob(context, "￿") == pytest.approx(1, abs=1e-6)
    out = by_id(kneser_ney.classify(docs, labels))
    assert out[60 + 10].perplexity is None and not out[71].kept
    assert kneser_ney.classify(none, labels).count() == 0


def test_language_id(spark, none):
    r = np.random.default_rng(5)
    words = {"en": ["the", "and", "that", "with", "have"], "de": ["der", "und", "nicht", "über", "ein"]}
    rows = [(i, " ".join(r.choice(words[x], 12)), x) for i in range(160) for x in [["en", "de"][i % 2]]]
    rows += [(900, None, "en"), (901, "123 !!", "en"), (902, "the and that", None), (903, "und nicht über", "de")]
    df = spark.createDataFrame(rows, DOCS)
    got = by_id(language_id.identify(df))
    held = [(i, x) for i, _, x in rows[:160] if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum(got[i].lang_pred == x for i, x in held) >= 0.95 * len(held) and all(got[i].held_out for i, _ in held)
    assert [(got[i].lang_pred, got[i].score) for i in (900, 901)] == [("und", 0.0)] * 2 and got[902].lang_pred == "en"
    kept = language_id.accepted(df)
    assert kept.columns == df.columns and not {900, 901} & {x.doc_id for x in kept.collect()}
    assert language_id.identify(none).count() == 0


def test_html(spark):
    page = '<html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="ad">Buy</div><article><h1>Big &amp; new</h1><p>One <b>bo</b>ld\n day.<p>Two words &copy;</p></article><footer>foot</footer></body></html>'
    assert [t for p, t in html_text.blocks(page) if html_text.by_place(p)] == ["Big & new", "One bold day.", "Two words ©"]
    rows = [(i, "u", page.replace("Two words", f"Two words {'more ' * i}")) for i in range(12)] + [(90, "u", None), (91, None, ""), (92, "u", "<p>unclosed <div")]
    got = {r.page_id: r for r in html_text.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i].text == " ".join(f"Big & new One bold day. Two words {'more ' * i}©".split()) for i in range(12))
    assert (got[90].text, got[91].text, got[90].n_chars) == ("", "", 0)
    body = "".join(f"<p>Paragraph {k} of the story tells what happened on that day.</p>" for k in range(5))
    deep = [(i, "u", f"<body><nav><a>Home</a></nav><article>{'<div>' * n}{body}{'</div>' * n}</article><footer>All rights</footer>") for i, n in enumerate((0, 30, 400))]
    odd = "page_id long, url string, html string, text int, n_chars int"
    pages = spark.createDataFrame([(*x, 1, 2) for x in deep], odd)
    model = html_text.train(pages.union(spark.createDataFrame([(*x, 1, 2) for x in rows], odd)))
    out = html_text.extract(pages, model, out="main").collect()
    assert len({x.main for x in out}) == 1 and out[0].main.count("Paragraph") == 5 and all((x.text, x.n_chars) == (1, 2) for x in out)
    assert html_text.main_texts(pages.limit(0)).count() == 0
    hidden = "<datalist><option>A<option>B</datalist><article><p>Keep<svg><path d=''/><text>x</text></svg> it</p><select><option>1</select><p>More</p></article>"
    assert [t for _, t in html_text.blocks(hidden)] == ["Keep", "it", "More"]


def test_unseen_trusted_text_is_judged_as_seen(spark):
    """Thresholds come from trusted documents outside the models, so half of the labels serve the other half too."""
    r = np.random.default_rng(9)
    vocabulary = ["".join(r.choice(list("abcdefghijklmnop"), r.integers(2, 7))) for _ in range(1500)]
    make = lambda: " ".join(vocabulary[int(i)] for i in r.zipf(1.2, 300) % 1500)
    noise = lambda: " ".join("".join(r.choice(list("xyzqw0189"), r.integers(2, 9))) for _ in range(300))
    rows = [(i, make() if i < 400 else noise(), "en") for i in range(440)]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(200)] + [(i, 0, 0) for i in range(400, 420)], "doc_id long, quality int, toxic int")
    for judged in (quality_ratio.judged, kneser_ney.classify):
        got = by_id(judged(docs, labels))
        kept = lambda low, high: sum(got[i].kept for i in range(low, high)) / (high - low)
        assert kept(0, 200) > 0.9 and kept(200, 400) > 0.9 and kept(400, 440) == 0

"""run() against a plain Python version of its five stages, on a small fixture with planted copies, lines and passages."""

import hashlib
import re

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")
pipeline = pytest.importorskip("corpus_pipeline")

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = {"en": "the and that with have this from they would there which people time about water".split(), "de": "der und nicht über eine sich auch wenn Straße immer wieder haben werden Wasser Zeit".split()}


def low(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s)


def fixture():
    r = np.random.default_rng(11)
    make = lambda lang, n: " ".join(f"{r.choice(WORDS[lang])}{r.integers(30) or ''}" for _ in range(n))
    rows = [(i, "\n".join(make(lang, int(r.integers(8, 30))) for _ in range(3)), lang) for i in range(48) for lang in [["en", "de"][i % 2]]]
    body = {i: t for i, t, _ in rows}
    near = body[2].split("\n")
    rows += [(60, body[0], "en"), (61, body[1].upper(), "de"), (62, "\n".join(near[:2] + [near[2] + " changed words"]), "en")]
    cut = SPACED.findall(body[3].replace("\n", " "))
    rows += [(63, "\n".join(" ".join(cut[k : k + 3]) for k in range(0, len(cut), 3)), "de")]  # the same words, other lines
    rows += [(64, body[4].split("\n")[0] + "\n" + make("en", 25), "en"), (65, f"{make('de', 9)} {' '.join(body[7].split()[2:16])} {make('de', 9)}", "de")]
    rows += [(70, None, "en"), (71, "", None), (72, "123 !!", "de"), (73, "the\n\nand", None), (74, make("en", 900), "en")]
    bench = [(1, " ".join(body[7].split()[2:16])), (2, None), (3, "!!"), (4, "nothing like this is in any of the texts of the fixture")]
    return rows, bench


def plain(rows, bench):
    docs = {i: t for i, t, _ in rows if t and re.search(r"[^\W\d_]", t)}
    sizes = [len(docs)]
    earlier, left = [], {}
    for i in sorted(docs):
        lines, kept, held = docs[i].split("\n"), [], 0
        for line in lines:
            s = frozenset(SPACED.findall(line.lower()))
            repeat = bool(s) and any(4 * len(s & e) >= 3 * len(s | e) for e in earlier)
            earlier += [s] if s else []
            held += bool(s) and not repeat
            kept += [] if repeat else [line]
        if held:
            left[i] = "\n".join(kept)
    sizes.append(len(left))
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, t in left.items() for w in [SPACED.findall(low(t))]}
    group = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if a < b and group[a] != group[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((group[a], group[b]))
                group = {i: x if g == y else g for i, g in group.items()}
    left = {i: t for i, t in left.items() if group[i] == i}
    sizes.append(len(left))
    windows = set()
    for _, t in bench:
        w = PLAIN.findall(low(t or ""))
        windows |= {tuple(w[k : k + 10]) for k in range(max(1, len(w) - 9))} if w else set()
    for i, t in list(left.items()):
        w = PLAIN.findall(low(t))
        if any(tuple(w[k : k + n]) in windows for n in {len(x) for x in windows} for k in range(len(w) - n + 1)):
            del left[i]
    return left, [*sizes, len(left)]


def saved(spark, path, rows, bench):
    spark.createDataFrame([(i, t, x, "s", len(t or "")) for i, t, x in rows], SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_run(spark, tmp_path):
    import base64

    import tiktoken

    rows, bench = fixture()
    left, sizes = plain(rows, bench)
    assert sizes[0] > sizes[1] > sizes[2] > sizes[3]  # every stage takes something
    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    twin = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: r for r in pipeline.run(spark, saved(spark, tmp_path, rows, bench)).collect()}
    assert set(got) == set(left)
    for i, t in left.items():
        ids = twin.encode_ordinary(t)
        assert (got[i].n_tokens, got[i].ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert got[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_stages_keep_the_columns(spark, tmp_path):
    rows, bench = fixture()
    folder = saved(spark, tmp_path, rows, bench)
    docs = spark.read.parquet(f"{folder}/documents.parquet").selectExpr("*", "1 as gone")
    for _, stage in pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns


def test_empty(spark, tmp_path):
    assert pipeline.run(spark, saved(spark, tmp_path, [], [])).count() == 0

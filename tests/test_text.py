"""Golden rows of cleaning, similarity and metrics."""

import pytest
from pyspark.sql import functions as F

from weftlink.functions import similarity as S
from weftlink.functions import text as X
from weftlink.operators import blocking, metrics, translit, validate
from weftlink.operators.normalise import normalise

NAMES = [
    ("Zorvane f/k/a Blue Harbor Foods Pvt Ltd", ["zorvane", "blue harbor foods pvt ltd"], ["zorvane", "blue harbor foods"], (False, False, True)),
    ("*** ORCHID TRUST CORPORATION", ["orchid trust corporation"], ["orchid trust"], (False, False, False)),
    ("orchidlabs.com - 5550001234", ["orchidlabs"], ["orchidlabs"], (True, True, False)),
    ("Orchid Labs - 5550001234", ["orchid labs - 5550001234"], ["orchid labs - 5550001234"], (False, True, False)),
    ("M/s Orchid Orchid Labs Co.", ["orchid labs co."], ["orchid labs"], (False, False, False)),
    ("[Partners] Maïs (East) Union (ID: 77)", ["partners mais union"], ["partners mais union"], (False, False, False)),
    ("Limited Company", ["limited company"], ["limited company"], (False, False, False)),
    ("Straße GmbH", ["strasse gmbh"], ["strasse"], (False, False, False)),
    ("Delta TA Works", ["delta", "works"], ["delta", "works"], (False, False, True)),
    ("www.orchid.com", ["www.orchid.com"], ["www.orchid.com"], (False, False, False)),
    ("", [""], [""], (False, False, False)),
]
ADDRESSES = [
    ("##1204 Oak Rd, N/A, Unit 7", ["1204", "7"], ["oak", "rd", "unit"], (False, True, True, False)),
    ("(ID: 9) 12 Elm (rear) St", ["12"], ["elm", "st"], (False, False, False, True)),
    ("N/A", [], [], (True, True, False, False)),
    (", ,", [], [], (False, False, False, False)),
    ("Na Street 00560034", ["00560034"], ["street"], (False, True, False, False)),
]


def test_names(spark):
    rows = spark.createDataFrame([(str(i), n[0], "", "x", "S1") for i, n in enumerate(NAMES)], "entity_id string, business_name string, business_address string, country string, src string")
    got = {int(r.entity_id): r for r in normalise(rows).collect()}
    for i, (_, folded, plain, flags) in enumerate(NAMES):
        assert got[i].folded == folded and got[i].no_suffix == plain
        assert (got[i].is_domain_like, got[i].had_phone_suffix, got[i].had_alias_marker) == flags


def test_addresses(spark):
    rows = spark.createDataFrame([(str(i), "n", a[0], "x", "S1") for i, a in enumerate(ADDRESSES)], "entity_id string, business_name string, business_address string, country string, src string")
    got = {int(r.entity_id): r for r in normalise(rows).collect()}
    for i, (_, numbers, words, flags) in enumerate(ADDRESSES):
        assert got[i].addr_numbers == numbers and sorted(got[i].addr_words) == words
        assert (got[i].addr_is_empty, got[i].had_null_token, got[i].had_hash, got[i].had_id_marker) == flags


def test_ngrams_and_unicode(spark):
    rows = spark.createDataFrame([("orchid", "मां मां X X"), ("abc", ""), ("", ""), ("aaaaa", "")], "s string, t string")
    got = [r.g for r in rows.select(X.char_ngrams(F.col("s"), 4).alias("g")).collect()]
    assert got == [["orch", "rchi", "chid"], ["abc"], [], ["aaaa", "aaaa"]]
    assert rows.select(X.collapse_duplicates(F.col("t")).alias("c")).first().c == "मां मां X"


@pytest.mark.parametrize(("a", "b", "expected"), [(["504"], ["04"], 1.0), (["1", "576"], ["2", "576"], 0.5), (["2922"], ["922"], 1.0), (["7"], ["7"], 0.0), ([], ["7"], 0.0), (["12", "34"], ["12", "56"], 0.5)])
def test_suffix_overlap(spark, a, b, expected):
    rows = spark.createDataFrame([(a, b)], "a array<string>, b array<string>")
    assert rows.select(S.numeric_suffix_overlap(F.col("a"), F.col("b")).alias("o")).first().o == expected


def test_ratios():
    assert S.common_subsequence("abcbdab", "bdcaba") == 4
    assert S.token_sort_ratio("b a", "a b") == 100 and S.token_set_ratio("a b c", "a b") == 100
    assert round(S.jaro_winkler("martha", "marhta"), 4) == 0.9611


@pytest.mark.parametrize(("tp", "np", "nt", "f"), [(0, 0, 0, 1.0), (0, 0, 2, 0.0), (0, 2, 0, 0.0), (0, 1, 1, 0.0), (2, 2, 4, 0.833333), (2, 4, 2, 0.555556), (3, 3, 3, 1.0)])
def test_f_half(spark, tp, np, nt, f):
    rows = spark.createDataFrame([(tp, np, nt)], "tp int, np int, nt int")
    assert round(rows.select(metrics.f_half(F.col("tp"), F.col("np"), F.col("nt")).alias("f")).first().f, 6) == f


def test_cap_keeps_exactly_cap(spark):
    index = spark.createDataFrame([("c", "S2", "squash", k, f"S2-{i}") for k, n in (("a", 3), ("b", 4)) for i in range(n)], "country string, src string, family string, key string, entity_id string")
    assert {r.key for r in blocking.capped(index, 3).collect()} == {"a"}


def test_one_owner_and_sweep(spark):
    pairs = spark.createDataFrame([("S1-1", "S2-1", 0.9, 1), ("S1-2", "S2-1", 0.8, 0), ("S1-2", "S2-2", 0.4, 1)], "source1_entity_id string, candidate_entity_id string, prob double, label int")
    assert {(r[0], r[1]) for r in metrics.one_owner(pairs).collect()} == {("S1-1", "S2-1"), ("S1-2", "S2-2")}
    swept = {(r.threshold, r.owner_exclusive): r.macro_f05 for r in metrics.sweep(pairs).collect()}
    assert swept[0.4, True] == 1.0 and swept[0.4, False] < 1.0 and len(swept) == 38


def test_dictionary(spark):
    counted = spark.createDataFrame([("न", "b", 2), ("न", "a", 2), ("म", "x", 2)], "native string, latin string, n bigint")
    assert [(r.native, r.latin) for r in translit.dictionary(counted).collect()] == [("न", "a")]
    rows = spark.createDataFrame([("1", "न, Z"), ("2", "न")], "entity_id string, business_name string")
    got = {r.entity_id: r.latin_name for r in translit.latinised(rows, translit.dictionary(counted)).collect()}
    assert got == {"1": "a Z", "2": "a"}


def test_validator_files(spark, tmp_path):
    (tmp_path / "s1.tsv").write_text("entity_id\tx\nS1-1\ta\nS1-2\tb\n")
    (tmp_path / "m.tsv").write_text("source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1,S3-1\nS1-2\t\n")
    (tmp_path / "c.tsv").write_text("source1_entity_id\tcandidate_entity_ids\nS1-1\tS2-1\nS1-2\t\n")
    ok, found = validate.validate(spark, str(tmp_path / "m.tsv"), str(tmp_path / "c.tsv"), str(tmp_path / "s1.tsv"))
    assert ok and [(r.rule, r.id) for r in found.collect()] == [("match_not_candidate", "S3-1")]
    (tmp_path / "bad.tsv").write_text("source1_entity_id,matched\nS1-1\n")
    ok, found = validate.validate(spark, str(tmp_path / "bad.tsv"), None, str(tmp_path / "s1.tsv"))
    assert not ok and found.first().rule == "header_commas"


def test_scan_keeps_empty_strings(spark, tmp_path):
    from weftlink.sources.records import read_truth, read_tsv
    from weftlink.sources.sinks import write_tsv

    (tmp_path / "r.tsv").write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\t"A "B\t\t x \n')
    row = read_tsv(spark, str(tmp_path / "r.tsv")).first()
    assert (row.business_name, row.business_address, row.country) == ('"A "B', "", " x ")
    write_tsv(spark.createDataFrame([("é\"x", "")], "a string, b string"), str(tmp_path / "out"))
    assert next((tmp_path / "out").glob("part*")).read_text() == 'a\tb\né"x\t\n'
    (tmp_path / "t.tsv").write_text("source1_entity_id\tmatched_entity_ids\nS1-1\t S2-1 ,,S3-2\nS1-2\t\n")
    assert [r.ids for r in read_truth(spark, str(tmp_path / "t.tsv")).collect()] == [["S2-1", "S3-2"], []]


def test_scripts(spark):
    from pyspark.sql import functions as F

    from weftlink.functions import scripts as S

    cases = {
        "Orchid 7": (["Latin"], False, False),
        "Société": (["Latin"], False, True),
        "तमिल नाडु": (["Devanagari"], False, False),
        "ОOО Orchid": (["Cyrillic", "Latin"], True, False),
        "தமிழ் Labs": (["Latin", "Tamil"], False, False),
        "東京 12": (["CJK"], False, False),
        "é ,;": (["Latin"], False, False),
        "12 #": ([], False, False),
        "": ([], False, False),
        None: ([], False, False),
    }
    rows = spark.createDataFrame([(t,) for t in cases], "t string")
    for r in rows.select("t", S.scripts_of(F.col("t")).alias("s"), S.mixed_inside_token(F.col("t")).alias("m"), S.has_latin_accent(F.col("t")).alias("a")).collect():
        assert (r.s, r.m, r.a) == cases[r.t], r.t


def test_ngrams_of_long_texts_take_one_pass(spark):
    import time

    texts = ["ab c" * 25_000, "a\n😀b😀c", "abc", "", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, x string")
    began = time.time()
    got = {r.id: (r.g, r.w) for r in rows.select("id", X.char_ngrams(X.squash(F.col("x")), 4).alias("g"), X.char_wb_ngrams(F.col("x")).alias("w")).collect()}
    assert time.time() - began < 30  # minutes, where each n-gram walks the text

    def grams(x, n):
        return [x[i : i + n] for i in range(len(x) - n + 1)] or ([x] if x else [])

    for i, x in enumerate(texts):
        plain, padded = "".join(c for c in x or "" if c.isascii() and c.isalnum()), f" {x} "
        assert got[i] == (grams(plain, 4), grams(padded, 3) + (grams(padded, 4) if len(padded) >= 4 else []) if x else [])

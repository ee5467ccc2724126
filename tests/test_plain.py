"""Cleaning in one pass against the column expressions."""

import random

from pyspark.sql import functions as F

from weftlink.functions import plain
from weftlink.functions import text as X

BITS = ["(ID: a-1)", "( id #x )", "(ıd 3)", "M/s ", "MESSRſ. ", " - 1234567", "- 12345678\r", "a.com", "x.İn", "dba", " f/k/a ", "formerly known aſ", "null", "N/A", "nan", "##", "(", "(x)", "[", "}", "\t", "\r", "\x1c", "\x85", " ", "　", " ", ", ", ";", "-", "_", "'", "*", "Ltd.", ",inc,", "foo", "Foo", "é", "ß", "ı", "i", "ς", "Σ", "K", "ﬁ", "½", "٣", "क", "12", "00712"]


def test_one_pass_gives_what_the_expressions_give(spark):
    deal = random.Random(5)
    texts = ["".join(deal.choice(BITS) + deal.choice(["", " "]) for _ in range(deal.randint(0, 12))) for _ in range(1500)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    named = rows.withColumn("p", X.fold_all(X.name_base(F.col("t")))).withColumn("a", X.address_base(F.col("t")))
    named = named.select("t", *[c.alias(n) for n, c in X.clean_name(F.col("t"), F.col("p")).items()], *[c.alias(n) for n, c in X.address_flags(F.col("t")).items()], X.squeezed(X.casefold(X.fold_accents("a"))).alias("addr"))
    named = named.withColumn("no_suffix", F.transform(X.casefold_all("cased"), X.without_legal_words))
    named = named.withColumns({"tokens": F.transform("no_suffix", lambda v: F.array_distinct(X.name_words(v))), "grams": X.char_ngrams(X.squash(F.col("no_suffix")[0]), 4)})
    for r in named.collect():
        cased, _, _, no_suffix, tokens, *flags = plain.name(r.t)
        addr, _, _, *found = plain.address(r.t)
        assert (cased, no_suffix, tokens, flags) == (r.cased, r.no_suffix, r.tokens, [r.is_domain_like, r.had_phone_suffix, r.had_alias_marker]), r.t
        assert (addr, found) == (r.addr, [r.had_null_token, r.had_hash, r.had_id_marker]), r.t
        assert plain.char_ngrams(no_suffix[0], 4) == r.grams


def test_records_without_a_text_are_normalised(spark):
    from weftlink.operators.normalise import blocking_columns, blocking_keys, normalise

    rows = spark.createDataFrame([("S1-0", None, None, "en", "S1"), ("S2-1", "Foo Ltd\r", "", None, "S2")], "entity_id string, business_name string, business_address string, country string, src string")
    got = {r.entity_id: r.asDict() for r in blocking_keys(rows).collect()}
    assert got == {r.entity_id: r.asDict() for r in blocking_columns(normalise(rows)).collect()}  # a null text used to end the run
    assert got["S1-0"]["name_tokens"] is None and got["S2-1"]["name_tokens"] == ["foo"] and got["S2-1"]["name_ngrams"] == ["foo"]

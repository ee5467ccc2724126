"""Retrieval in blocks against the join of n-grams."""

import random

import pytest

from weftlink.operators import blocking as B
from weftlink.operators import names


@pytest.mark.parametrize("k, rows, columns", [(50, 2_048, 32_768), (3, 4, 9)])
def test_blocks_find_what_joined_ngrams_find(spark, k, rows, columns):
    deal = random.Random(11)
    words = ["red", "tin", "blue", "works", "a", "12", "supply"]
    given = [(f"S{1 + i % 3}-{i}", deal.choice(["en", "en", "de"]), f"S{1 + i % 3}", "".join(deal.choice(words) for _ in range(deal.randint(0, 4)))) for i in range(150)]
    given += [("S1-900", None, "S1", "tin"), ("S2-901", None, "S2", "tin"), ("S1-902", "en", "S1", None), ("S1-903", "fr", "S1", "tin"), ("S1-904", "en", "S1", "zzz")]
    table = spark.createDataFrame(given, "entity_id string, country string, src string, squash string")
    s1, others = table.where("src = 'S1'"), table.where("src <> 'S1'")
    got = names.tfidf_topk(s1, others, k, rows, columns)
    want = B.tfidf_topk(s1, others, k)
    assert {tuple(r) for r in got.select(want.columns).collect()} == {tuple(r) for r in want.collect()}
    assert "FlatMapCoGroupsInArrow" in got._jdf.queryExecution().optimizedPlan().toString()  # n-grams used to be joined, a row for each that two names share

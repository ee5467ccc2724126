"""Registered queries on small tables against plain Python."""

import collections

from weftlink.plans.queries import QUERIES


def stored(spark, folder, **tables):
    """The tables, each (rows, schema), as Parquet files in ``folder``."""
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def answers(key, customer):
    if key % 50 == 0:
        return ["S2-1", "S2-1"]
    if key % 51 == 0:
        return ["S1-3"]
    return ["X9", "S3-99999"] if key % 53 == 0 else [f"S2-{customer % 90 + 1}", "S3-7"]


ORDERS = [(k, k * 7 % 160) for k in range(1, 700)]
CUSTOMERS, SUPPLIERS = range(400), range(70)


def result_tables(spark, folder):
    return stored(spark, folder, orders=(ORDERS, "o_orderkey long, o_custkey long"), customer=([(c, c % 25) for c in CUSTOMERS], "c_custkey long, c_nationkey long"), supplier=([(s,) for s in SUPPLIERS], "s_suppkey long"))


def test_every_order_is_a_result_row(spark, tmp_path):
    rows = [(k, f"S1-{c % 1200}", answers(k, c)) for k, c in ORDERS]
    listed = [r for r in rows if r[0] % 97]
    each = {(s1, i) for _, s1, ids in listed for i in ids}
    need, valid = {f"S1-{c}" for c in CUSTOMERS}, {f"S2-{s}" for s in SUPPLIERS} | {"S3-7"}
    seen = collections.Counter(s1 for _, s1, _ in listed)
    want = [("row_without_tab", "", "", str(k)) for k, _, _ in rows if k % 97 == 0]
    want += [("duplicate_s1", s1, "", str(n)) for s1, n in seen.items() if n > 1]
    want += [("repeated_id", s1, "", "") for _, s1, ids in listed if len(ids) > len(set(ids))]
    want += [("s1_in_list", s1, i, "") for s1, i in each if i.startswith("S1-")]
    want += [("bad_prefix", s1, i, "") for s1, i in each if i[:3] not in ("S1-", "S2-", "S3-")]
    want += [("unknown_id", s1, i, "") for s1, i in each if i[:3] in ("S2-", "S3-") and i not in valid]
    want += [("missing_s1", s1, "", "") for s1 in need - set(seen)] + [("unexpected_s1", s1, "", "") for s1 in set(seen) - need]
    d = result_tables(spark, tmp_path)
    got = [(r.rule, r.s1, r.id, r.detail) for r in QUERIES["validate_results"](spark, d).collect()]
    assert collections.Counter(got) == collections.Counter(want)
    last = {s1: ids for _, s1, ids in listed}  # keys ascend
    unlisted = {(s1, i) for s1, ids in last.items() for i in ids} - {x for x in each if x[1].startswith("S2-")}
    got = [(r.s1, r.id) for r in QUERIES["validate_subset"](spark, d).collect()]
    assert sorted(got) == sorted(unlisted)


def test_suffix_overlap_reads_every_supplier(spark, tmp_path):
    def overlap(a, b):
        short, long = (a, b) if len(a) <= len(b) else (b, a)
        ends = lambda x, y: min(len(x), len(y)) >= 2 and (x.endswith(y) or y.endswith(x))
        return round(sum(any(ends(x, y) for y in long) for x in short) / len(short), 6)

    want = {c: overlap([str(c), str(c % 25)], [str(c % len(SUPPLIERS)), str(c)[-2:], "7"]) for c in CUSTOMERS}
    got = QUERIES["numeric_suffix_overlap"](spark, result_tables(spark, tmp_path)).collect()
    assert len(got) == len(CUSTOMERS) and {r.k: r.overlap for r in got} == want


LONG = "First line that is longer than sixty characters, whole as the name é of its record"
TEXTS = [f"{LONG}\nsecond ß line 12345\n{'middle ' * 40}\nlast line ñ", "no line end", "", "a\n", "\nb", f"{LONG}\n\nœ {'tail ' * 30}", LONG, LONG]


def documents(spark, folder):
    rows = [(i, t, ["en", "de"][i % 2]) for i, t in enumerate(TEXTS)]
    return stored(spark, folder, documents=([*rows, (len(rows), None, "en")], "doc_id long, text string, lang string"))


def test_records_hold_whole_texts(spark, tmp_path):
    from weftlink.sources.adapter import records

    d = documents(spark, tmp_path)
    got = {int(r.entity_id.split("-")[1]): (r.business_name, r.business_address) for r in records(spark, d).collect()}
    want = {i: (t.partition("\n")[0], t.partition("\n")[2]) for i, t in enumerate(TEXTS)}
    assert got == {**want, len(TEXTS): (None, None)}
    chars = collections.Counter(("train" if i % 2 == 0 else "test", c) for i, t in enumerate(TEXTS) for c in t if ord(c) > 127)
    assert {(r.split, r.ch): r.n for r in QUERIES["nonascii_census"](spark, d).collect()} == chars
    letters = sum(c.isalpha() for t in TEXTS for c in t)
    assert [tuple(r) for r in QUERIES["char_census"](spark, d).collect()] == [("Latin", letters)]
    numbers = {r.entity_id: r.numbers for r in QUERIES["clean_address"](spark, d).collect()}
    assert numbers["S1-0"] == "12345"


def test_markers_go_into_whole_names(spark, tmp_path):
    d = documents(spark, tmp_path)
    rest = {r.entity_id: r.rest for r in QUERIES["paren_id"](spark, d).collect()}
    parts = {r.entity_id: r.parts for r in QUERIES["alias_split"](spark, d).collect()}
    assert rest["S1-6"] == f"{LONG[:8]}  {LONG[8:]} [Co]" and parts["S1-6"] == f"{LONG[:20].strip()}|{LONG[20:].strip()}|en"


def test_scores_come_from_the_whole_boosted_model(spark, tmp_path, monkeypatch):
    import inspect

    from weftlink.operators import matcher
    from weftlink.plans import queries

    called, train = [], matcher.train

    def short(*a, **b):
        bound = inspect.signature(train).bind(*a, **b)
        bound.apply_defaults()
        called.append(bound.arguments["rounds"])
        return train(bound.arguments["rows"], rounds=1)  # the call is what is tested

    monkeypatch.setattr(matcher, "train", short)
    pairs = [(f"S1-{i}", f"S{2 + j}-{i + 1 + j}", 1 + j, 1 - j) for i in range(0, 30, 3) for j in (0, 1)]
    given = spark.createDataFrame(pairs, "source1_entity_id string, candidate_entity_id string, agreement_count int, label int")
    monkeypatch.setattr(queries, "pairs_of", lambda spark, sf_dir: given)
    d = stored(spark, tmp_path, documents=([(i, f"shop {i // 3}\nplace {i}", "en") for i in range(33)], "doc_id long, text string, lang string"))
    got = {(r.source1_entity_id, r.candidate_entity_id, r.label): r.prob for r in QUERIES["gbt_scores"](spark, d).collect()}
    val = {r.source1_entity_id for r in matcher.entity_split(given).where("is_val").collect()}
    assert called == [matcher.ROUNDS] and len(val) == 2
    assert set(got) == {(a, b, label) for a, b, _, label in pairs if a in val} and all(0 <= p <= 1 for p in got.values())


def test_matcher_stops_at_its_best_round_and_is_saved(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F

    from weftlink.operators import matcher
    from weftlink.sources import records, sinks

    assert matcher.best_round([5, 4, 3, 3.5, 3.4, 3.3], 500, 3) == 3
    assert matcher.best_round([5, 4, 3, 3.5], 500, 3) is None and matcher.best_round([5, 4, 3, 3.5], 4, 3) == 3
    for name, value in (("PATIENCE", 2), ("DEPTH", 2), ("LEAF", 1), ("FEATURES", ["a", "b"])):
        monkeypatch.setattr(matcher, name, value)
    rows = spark.range(400).select("id", (F.col("id") % 17).cast("double").alias("a"), (F.col("id") * 7 % 13).cast("double").alias("b"))
    rows = rows.withColumns({"label": (F.col("a") + (F.col("id") * 31 % 11) > 12).cast("int"), "is_val": F.col("id") % 5 == 0}).persist()
    model = matcher.train(rows, rounds=6)
    assert 1 <= model.getNumTrees <= 6
    scores = {r.id: r.prob for r in matcher.scored(model, rows).select("id", "prob").collect()}
    assert max(scores.values()) > 0.5 > min(scores.values())
    short = matcher.first_trees(model, 1)
    assert short.getNumTrees == 1 and short.trees[0].toDebugString == model.trees[0].toDebugString
    sinks.write_model(model, f"{tmp_path}/model")
    again = records.read_model(f"{tmp_path}/model")
    assert {r.id: r.prob for r in matcher.scored(again, rows).select("id", "prob").collect()} == scores


def test_result_lines_are_read_as_they_stand(spark):
    from weftlink.operators.validate import violations
    from weftlink.sources.records import parse_results

    texts = ["source1_entity_id\tmatched_entity_ids", "S1-1\tS2-1,,S3-1", " S1-2\tS2-1, S2-2", "S1-3\t  ", "", "  ", "\t", "S1-4", "S1-5\tS2-1\tx"]
    lines = spark.createDataFrame(list(enumerate(texts, 1)), "line long, value string")
    got = {r.line: (r.s1, r.has_tab, r.ids) for r in parse_results(lines).collect()}
    assert got.pop(8)[1:] == (False, [])
    assert got == {2: ("S1-1", True, ["S2-1", "", "S3-1"]), 3: (" S1-2", True, ["S2-1", " S2-2"]), 4: ("S1-3", True, []), 7: ("", True, []), 9: ("S1-5", True, ["S2-1\tx"])}
    required = spark.createDataFrame([("S1-1",), ("S1-2",)], "entity_id string")
    found = {(r.rule, r.s1, r.id) for r in violations(parse_results(lines), required).collect()}
    assert {("bad_prefix", "S1-1", ""), ("bad_prefix", " S1-2", " S2-2"), ("missing_s1", "S1-2", ""), ("unexpected_s1", " S1-2", "")} <= found


def test_scores_move_words_by_blocks_and_are_jaccard(spark, monkeypatch):
    from weftlink.operators import blocking as B

    monkeypatch.setattr(B, "BLOCK", 7)
    monkeypatch.setattr(B, "STEP", 3)
    words = lambda i, n: [f"w{i * k % 11}" for k in range(1, n)]
    record = lambda i, p: (f"{p}{i}", "en", list(dict.fromkeys(words(i, 2 + i % 5))), list(dict.fromkeys(words(i + 1, 1 + i % 7))))
    s1, others = [record(i, "a") for i in range(20)] + [("none", "en", None, None)], [record(i, "b") for i in range(30)] + [("nil", "en", [], [])]
    schema = "entity_id string, country string, name_tokens array<string>, addr_tokens array<string>"
    listed = [(x[0], y[0], i + j) for i, x in enumerate(s1) for j, y in enumerate(others)] + [("a1", "lost", 0), ("lost", "b1", 0)]
    rows = B.coarse_scores(spark.createDataFrame(listed, "s1 string, cand string, agreement int"), spark.createDataFrame(s1, schema), spark.createDataFrame(others, schema))
    vocabulary = {w for o in others for c in o[2:] for w in c}

    def jaccard(x, y):
        x, y = set(x or ()) & vocabulary, set(y or ())
        return len(x & y) / len(x | y) if x | y else 0.0

    want = {(x[0], y[0], i + j): 0.5 * jaccard(x[2], y[2]) + 0.5 * jaccard(x[3], y[3]) for i, x in enumerate(s1) for j, y in enumerate(others)}
    assert {(r.s1, r.cand, r.agreement): r.score for r in rows.collect()} == want
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan  # words used to be joined to each pair


def test_parts_of_one_name_are_compared_once(spark, tmp_path, monkeypatch):
    from weftlink.functions import similarity
    from weftlink.plans import queries

    asked, measure = spark.sparkContext.accumulator(0), similarity.jaro_winkler

    def counted(x, y):
        asked.add(1)
        return measure(x, y)

    monkeypatch.setattr(queries.SIM, "best_jaro_winkler", similarity._best(counted))
    parts = [(k, f"b{k % 2}", 1 + k % 3, ["red tin", "tin red", "blue tin"][k // 6 % 3]) for k in range(120)]
    d = stored(spark, tmp_path, part=(parts, "p_partkey long, p_brand string, p_size int, p_name string"))
    got = {(r.a, r.b): r.jw for r in QUERIES["jaro_winkler"](spark, d).collect()}
    want = {(a[0], b[0]): round(measure(a[3], b[3]), 6) for a in parts for b in parts if a[1:3] == b[1:3] and a[0] < b[0]}
    assert got == want and asked.value == 9  # 3 names against 3

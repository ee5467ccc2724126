"""DuckDB twins of the registered queries, composed from the fragments that the queries share."""

from __future__ import annotations

from ..functions.scripts import FRENCH_STREETS, FRENCH_WORDS
from ..functions.text import ALIAS_MARKERS, COMPANY_PREFIX, DOMAIN_ENDINGS, LEGAL_WORDS, NULL_WORDS

W, NW = r"[\p{L}\p{N}_]", r"[^\p{L}\p{N}_]"
_ID = r"(?i)\(\s*id\s*[:#]?\s*[\p{L}\p{N}_-]+\s*\)"
_DOMAIN = rf"(?i)^\s*([\p{{L}}\p{{N}}_-]+)\.(?:{'|'.join(DOMAIN_ENDINGS)})(?:{NW}|$)"
_ALIAS = rf"(?i)(^|{NW})(?:{'|'.join(ALIAS_MARKERS)})($|{NW})"
_NULL = rf"(?i)(^|{NW})(?:{'|'.join(NULL_WORDS)})($|{NW})"


def every(x: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({x}, '{pattern}', '{by}', 'g')"


def strip(x: str) -> str:
    return every(x, r"^\s+|\s+$")


def squeeze(x: str) -> str:
    return strip(every(x, r"\s+", " "))


def junk(x: str) -> str:
    return rf"""regexp_replace(regexp_replace({x}, '^[\s>*\-_.''"]+', ''), '(?i)^{COMPANY_PREFIX}\s+', '')"""


def marker(x: str) -> str:
    return f"regexp_extract({x}, '{_ID}', 0)"


def no_marker(x: str) -> str:
    return f"CASE WHEN {marker(x)} = '' THEN {x} ELSE {strip(f'''regexp_replace({x}, '{_ID}', '')''')} END"


def phone(x: str) -> str:
    return rf"regexp_matches({x}, '\s*-\s*\d{{7,}}\s*$')"


def no_phone(x: str) -> str:
    return rf"regexp_replace({x}, '\s*-\s*\d{{7,}}\s*$', '')"


def domain(x: str) -> str:
    return f"regexp_matches({strip(no_phone(x))}, '{_DOMAIN}')"


def core(x: str) -> str:
    return f"CASE WHEN {domain(x)} THEN regexp_extract({strip(no_phone(x))}, '{_DOMAIN}', 1) ELSE {x} END"


def marked(x: str, pattern: str, by: str) -> str:
    """Replace words twice, since a neighbour that was consumed may border the next one."""
    one = rf"regexp_replace({x}, '{pattern}', '\1' || {by} || '\2', 'g')"
    return rf"regexp_replace({one}, '{pattern}', '\1' || {by} || '\2', 'g')"


def alias(x: str) -> str:
    parts = f"list_filter(list_transform(string_split({marked(x, _ALIAS, 'chr(1)')}, chr(1)), lambda p: {every('p', r'^[ ,;\-]+|[ ,;\-]+$')}), lambda p: p <> '')"
    return f"CASE WHEN len({parts}) > 1 THEN {parts} ELSE [{x}] END"


def no_brackets(x: str) -> str:
    return squeeze(every(every(f"({no_marker(x)})", r"\([^)]*\)", " "), r"[\[\]{}]", " "))


def casefold(x: str) -> str:
    return f"replace(lower({x}), 'ß', 'ss')"


def legal(x: str) -> str:
    words = ", ".join(f"'{w}'" for w in LEGAL_WORDS)
    kept = f"array_to_string(list_filter(regexp_split_to_array({x}, '\\s+'), lambda t: t <> '' AND NOT list_contains([{words}], {every('t', '^[.,]+|[.,]+$')})), ' ')"
    return f"CASE WHEN {kept} = '' THEN {x} ELSE {kept} END"


def tokens(x: str) -> str:
    return f"list_distinct(list_filter(list_transform(list_filter(regexp_split_to_array({x}, '\\s+'), lambda t: t <> ''), lambda t: {every('t', f'^{NW}+|{NW}+$')}), lambda t: t <> '' AND NOT regexp_matches(t, '^\\d+$')))"


def ngrams(x: str, n: int) -> str:
    return f"CASE WHEN length({x}) >= {n} THEN list_transform(range(1, length({x}) - {n - 2}), lambda i: substring({x}, i, {n})) WHEN length({x}) > 0 THEN [{x}] ELSE [] END"


def joined(x: str, by: str = "|") -> str:
    return f"array_to_string({x}, '{by}')"


RECORDS = """records AS MATERIALIZED (SELECT 'S' || (1 + doc_id % 3) || '-' || doc_id AS entity_id, split_part(text, chr(10), 1) AS business_name,
  array_to_string(string_split(text, chr(10))[2:], chr(10)) AS business_address, lang AS country, 'S' || (1 + doc_id % 3) AS src, CASE WHEN doc_id % 2 = 0 THEN 'train' ELSE 'test' END AS split FROM documents)"""
TRUTH = """truth AS MATERIALIZED (SELECT 'S1-' || a.doc_id AS source1_entity_id, 'S' || (1 + b.doc_id % 3) || '-' || b.doc_id AS match_id
  FROM documents a JOIN documents b ON a.text = b.text WHERE a.doc_id % 3 = 0 AND b.doc_id % 3 <> 0)"""
_DUP = rf"""coalesce(CASE WHEN regexp_matches(w, '^{W}') THEN i > 2 AND regexp_matches(p[i - 1], '^\s+$') AND lower(p[i - 2]) = lower(w)
  ELSE regexp_matches(w, '^\s+$') AND i > 1 AND lower(p[i - 1]) = lower(p[i + 1]) END, false)"""
NORM = rf""",
t0 AS MATERIALIZED (SELECT *, {junk(strip('business_name'))} AS t FROM records),
t1 AS MATERIALIZED (SELECT *, {core('t')} AS c FROM t0),
t2 AS MATERIALIZED (SELECT *, {alias('c')} AS parts FROM t1),
v0 AS MATERIALIZED (SELECT entity_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS idx FROM t2),
v1 AS MATERIALIZED (SELECT entity_id, idx, regexp_extract_all(strip_accents({no_brackets('part')}), '{W}+|{NW}+') AS p FROM v0),
v2 AS MATERIALIZED (SELECT entity_id, idx, {squeeze(f"array_to_string(list_filter(p, lambda w, i: NOT {_DUP}), '')")} AS cased FROM v1),
v3 AS MATERIALIZED (SELECT entity_id, idx, cased, {casefold('cased')} AS folded FROM v2),
v4 AS MATERIALIZED (SELECT *, {every('folded', '[^a-z0-9]')} AS squashed, {legal('folded')} AS no_suffix FROM v3),
v5 AS MATERIALIZED (SELECT *, {tokens('no_suffix')} AS toks FROM v4),
nv AS MATERIALIZED (SELECT entity_id, list(folded ORDER BY idx) AS folded, list(squashed ORDER BY idx) AS squashed, list(no_suffix ORDER BY idx) AS no_suffix, list(toks ORDER BY idx) AS toks FROM v5 GROUP BY 1),
a0 AS MATERIALIZED (SELECT entity_id, {junk(strip('business_address'))} AS t FROM records),
a1 AS MATERIALIZED (SELECT entity_id, t, {no_marker('t')} AS u FROM a0),
a2 AS MATERIALIZED (SELECT entity_id, t, u, {every(marked('u', _NULL, "' '"), '#+')} AS x FROM a1),
ad AS MATERIALIZED (SELECT entity_id, {squeeze(casefold(f"strip_accents({no_brackets('x')})"))} AS addr, regexp_matches(u, '{_NULL}') AS had_null, contains(u, '#') AS had_hash, {marker('t')} <> '' AS had_id FROM a2),
an AS MATERIALIZED (SELECT *, regexp_extract_all(addr, '\d+') AS numbers, list_distinct(regexp_extract_all(addr, '[a-z]{{2,}}')) AS words FROM ad),
norm AS MATERIALIZED (SELECT t2.entity_id, business_name, business_address, country, src, split, folded, squashed, no_suffix, toks, {domain('t')} AS is_domain, {phone('t')} AS had_phone, len(parts) > 1 AS had_alias,
  addr, numbers, words, had_null, had_hash, had_id, addr = '' AS addr_empty FROM t2 JOIN nv USING (entity_id) JOIN an USING (entity_id))"""
BLOCK = f""",
blk0 AS (SELECT entity_id, country, src, squashed[1] AS squash, CASE WHEN len(squashed) > 1 THEN squashed[-1] ELSE '' END AS squash_alt, toks[1] AS name_tokens, {every('no_suffix[1]', '[^a-z0-9]')} AS ns,
  words AS addr_tokens, list_transform(list_filter(numbers, lambda n: length(n) >= 3), lambda n: right(n, 4)) AS addr_num_keys, list_filter(numbers, lambda n: length(n) >= 5) AS addr_pin_keys FROM norm),
blk AS MATERIALIZED (SELECT *, {ngrams('ns', 4)} AS name_ngrams FROM blk0)"""


def frequency(column: str) -> str:
    return f"SELECT country, src, tok, count(*) AS n FROM (SELECT country, src, unnest({column}) AS tok FROM blk) GROUP BY 1, 2, 3"


def rarest(column: str, k: int, where: str = "true") -> str:
    return f"""SELECT country, src, entity_id, tok, n FROM (SELECT o.*, f.n, row_number() OVER (PARTITION BY entity_id ORDER BY f.n, o.tok) AS rn
  FROM (SELECT country, src, entity_id, unnest(list_distinct({column})) AS tok FROM blk WHERE {where}) o JOIN ({frequency(column)}) f USING (country, src, tok)) WHERE rn <= {k}"""


OTHER = "src <> 'S1'"
POSTINGS = f""",
posts AS MATERIALIZED (SELECT country, src, 'squash' AS family, unnest(list_filter([squash, squash_alt], lambda x: x <> '')) AS key, entity_id FROM blk WHERE {OTHER}
  UNION ALL SELECT country, src, 'addr_num', unnest(addr_num_keys), entity_id FROM blk WHERE {OTHER}
  UNION ALL SELECT country, src, 'addr_pin', unnest(addr_pin_keys), entity_id FROM blk WHERE {OTHER}
  UNION ALL SELECT country, src, 'rare_name', tok, entity_id FROM ({rarest('name_tokens', 3, OTHER)})
  UNION ALL SELECT country, src, 'rare_ngram', tok, entity_id FROM ({rarest('name_ngrams', 2, OTHER)})
  UNION ALL SELECT country, src, 'rare_addr', tok, entity_id FROM ({rarest('addr_tokens', 3, OTHER)})),
idx AS MATERIALIZED (SELECT DISTINCT country, src, family, key, entity_id FROM posts JOIN (SELECT country, src, family, key FROM posts GROUP BY ALL HAVING count(*) <= 300) USING (country, src, family, key)),
probe AS MATERIALIZED (SELECT DISTINCT * FROM (SELECT country, entity_id AS s1, 'squash' AS family, unnest(list_filter([squash, squash_alt], lambda x: x <> '')) AS key FROM blk WHERE src = 'S1'
  UNION ALL SELECT country, entity_id, 'addr_num', unnest(addr_num_keys) FROM blk WHERE src = 'S1' UNION ALL SELECT country, entity_id, 'addr_pin', unnest(addr_pin_keys) FROM blk WHERE src = 'S1'
  UNION ALL SELECT country, entity_id, 'rare_name', unnest(name_tokens) FROM blk WHERE src = 'S1' UNION ALL SELECT country, entity_id, 'rare_ngram', unnest(name_ngrams) FROM blk WHERE src = 'S1'
  UNION ALL SELECT country, entity_id, 'rare_addr', unnest(addr_tokens) FROM blk WHERE src = 'S1')),
found0 AS MATERIALIZED (SELECT DISTINCT s1, country, i.src, i.entity_id AS cand, family FROM probe JOIN idx i USING (country, family, key))"""
TFIDF = f""",
wb AS (SELECT entity_id, country, src, ' ' || squash || ' ' AS s FROM blk WHERE squash <> ''),
gr AS MATERIALIZED (SELECT entity_id, country, src, gram, count(*) AS tf FROM (SELECT entity_id, country, src, unnest(list_concat({ngrams('s', 3)}, CASE WHEN length(s) >= 4 THEN {ngrams('s', 4)} ELSE [] END)) AS gram FROM wb) GROUP BY ALL),
idf AS MATERIALIZED (SELECT country, gram, ln((1 + docs)::DOUBLE / (1 + count(*))) + 1 AS idf FROM gr JOIN (SELECT country, count(*) AS docs FROM blk WHERE {OTHER} GROUP BY 1) USING (country) WHERE {OTHER} GROUP BY country, gram, docs),
wt0 AS MATERIALIZED (SELECT gr.*, tf * idf AS x FROM gr JOIN idf USING (country, gram)),
wt AS MATERIALIZED (SELECT wt0.*, x / sqrt(sum(x * x) OVER (PARTITION BY entity_id)) AS w FROM wt0),
tf AS MATERIALIZED (SELECT s1, country, src, cand, score FROM (SELECT *, row_number() OVER (PARTITION BY s1 ORDER BY score DESC, cand) AS rn FROM (
  SELECT q.entity_id AS s1, q.country, c.src, c.entity_id AS cand, round(sum(q.w * c.w), 6) AS score FROM wt q JOIN wt c ON q.country = c.country AND q.gram = c.gram WHERE q.src = 'S1' AND c.src <> 'S1' GROUP BY ALL) WHERE score > 0) WHERE rn <= 50)"""
FOUND, FOUND_TFIDF = ",\nfound AS MATERIALIZED (SELECT * FROM found0)", ",\nfound AS MATERIALIZED (SELECT * FROM found0 UNION SELECT s1, country, src, cand, 'tfidf' FROM tf)"


def _jac(a: str, b: str) -> str:
    both = f"len(list_intersect({a}, {b}))"
    return f"coalesce({both}::DOUBLE / nullif(len({a}) + len({b}) - {both}, 0), 0)"


RANK = f""",
vocab AS MATERIALIZED (SELECT DISTINCT country, unnest(list_concat(name_tokens, addr_tokens)) AS tok FROM blk WHERE {OTHER}),
known AS MATERIALIZED (SELECT entity_id, coalesce(list(DISTINCT tok) FILTER (k = 'n'), []) AS n, coalesce(list(DISTINCT tok) FILTER (k = 'a'), []) AS a FROM (
  SELECT entity_id, country, 'n' AS k, unnest(name_tokens) AS tok FROM blk WHERE src = 'S1' UNION ALL SELECT entity_id, country, 'a', unnest(addr_tokens) FROM blk WHERE src = 'S1') SEMI JOIN vocab USING (country, tok) GROUP BY 1),
masks AS MATERIALIZED (SELECT s1, country, src, cand, count(*) AS agreement, list(family) AS fams FROM found GROUP BY ALL),
sc AS MATERIALIZED (SELECT m.*, 0.5 * {_jac("coalesce(k.n, [])", 'b.name_tokens')} + 0.5 * {_jac("coalesce(k.a, [])", 'b.addr_tokens')} AS score FROM masks m LEFT JOIN known k ON k.entity_id = m.s1 JOIN blk b ON b.entity_id = m.cand),
rk AS MATERIALIZED (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY s1 ORDER BY agreement DESC, round(score, 9) DESC, src, cand) AS rank FROM sc) WHERE rank <= 50)"""
_FAMILIES = ["squash", "rare_name", "rare_ngram", "addr_num", "addr_pin", "rare_addr", "tfidf"]


def _families(src: str) -> str:
    parts = ", ".join(f"CASE WHEN count(*) FILTER (src = '{src}' AND list_contains(fams, '{f}')) > 0 THEN '{f}=' || count(*) FILTER (src = '{src}' AND list_contains(fams, '{f}')) END" for f in sorted(_FAMILIES))
    return f"concat_ws(',', {parts})"


CANDIDATES = f"""SELECT r.entity_id AS source1_entity_id, r.country, coalesce(l.ids, '') AS candidates, coalesce(l.ag, '') AS agreements, coalesce(v.n, 0) AS n_before_prune, coalesce(v.k2, '') AS by_key_s2, coalesce(v.k3, '') AS by_key_s3
FROM records r LEFT JOIN (SELECT s1, string_agg(cand, ',' ORDER BY rank) AS ids, string_agg(agreement::VARCHAR, ',' ORDER BY rank) AS ag FROM rk GROUP BY 1) l ON l.s1 = r.entity_id
LEFT JOIN (SELECT s1, count(*) AS n, {_families('S2')} AS k2, {_families('S3')} AS k3 FROM masks GROUP BY 1) v ON v.s1 = r.entity_id WHERE r.src = 'S1'"""
PAIRS = """,
pairs AS MATERIALIZED (SELECT s1 AS source1_entity_id, cand AS candidate_entity_id, agreement AS agreement_count, CASE WHEN t.match_id IS NULL THEN 0 ELSE 1 END AS label
  FROM rk LEFT JOIN truth t ON t.source1_entity_id = s1 AND t.match_id = cand)"""
#: A deterministic stand-in for the classifier's probability, so that metrics have a twin.
PROB = f""",
val AS MATERIALIZED (SELECT p.*, round(0.5 * {_jac('l.toks[1]', 'r.toks[1]')} + 0.5 * {_jac('l.words', 'r.words')}, 6) AS prob FROM pairs p JOIN norm l ON l.entity_id = p.source1_entity_id JOIN norm r ON r.entity_id = p.candidate_entity_id)"""
_GRID = "grid AS (SELECT round(0.05::DOUBLE + 0.05::DOUBLE * i, 2) AS threshold, 0.05::DOUBLE + 0.05::DOUBLE * i AS t FROM range(19) x(i)), modes AS (SELECT unnest([false, true]) AS owner_exclusive)"


def sweep(base: str) -> str:
    return f""", {_GRID}, base AS MATERIALIZED ({base}),
owned AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY candidate_entity_id ORDER BY prob DESC, source1_entity_id) = 1 AS owner FROM val),
fnd AS (SELECT b.source1_entity_id, g.threshold, m.owner_exclusive, b.n_true, coalesce(sum(o.label), 0) AS tp, count(o.label) AS np FROM base b CROSS JOIN grid g CROSS JOIN modes m
  LEFT JOIN owned o ON o.source1_entity_id = b.source1_entity_id AND o.prob >= g.t AND (o.owner OR NOT m.owner_exclusive) GROUP BY ALL),
swept AS (SELECT threshold, owner_exclusive, avg(CASE WHEN np = 0 AND n_true = 0 THEN 1.0::DOUBLE WHEN tp = 0 THEN 0.0 ELSE 1.25 * (tp::DOUBLE / np) * (tp::DOUBLE / n_true) / (0.25 * (tp::DOUBLE / np) + tp::DOUBLE / n_true) END) AS f, count(*) AS n_s1 FROM fnd GROUP BY ALL)"""


CANDIDATE_SCOPE = "SELECT source1_entity_id, sum(label) AS n_true FROM val GROUP BY 1"
FULL_SCOPE = "SELECT r.entity_id AS source1_entity_id, count(t.match_id) AS n_true FROM records r LEFT JOIN truth t ON t.source1_entity_id = r.entity_id WHERE r.src = 'S1' GROUP BY 1"
#: Scripts of the driver's texts: Latin letters, or none.
LATIN = r"[\p{L}\p{Mn}\p{Mc}]"


def script(x: str) -> str:
    return f"CASE WHEN regexp_matches({x}, '{LATIN}') THEN 'Latin' ELSE '(none)' END"


def caps(x: str) -> str:
    letters = every(x, "[^A-Za-z]")
    return f"(length({letters}) >= 4 AND regexp_matches({letters}, '^[A-Z]*$'))"


_STREET = rf"(?i)^{NW}*\d+{NW}*\s+(?:{'|'.join(FRENCH_STREETS)})(?:{NW}|$)"
_FRENCH = ", ".join(f"'{w}'" for w in FRENCH_WORDS)
FLAGS = {
    "f_name_empty": f"{strip('business_name')} = ''",
    "f_addr_empty": f"{strip('business_address')} = ''",
    "f_addr_null_token": f"regexp_matches(business_address, '(?i)(^|{NW})(?:{'|'.join(NULL_WORDS)})(?:{NW}|$)')",
    "f_addr_hash": "contains(business_address, '#')",
    "f_addr_state_first": r"regexp_matches(business_address, '^\s*[A-Za-z]{2},\s')",
    "f_addr_allcaps": caps("business_address"),
    "f_name_allcaps": caps("business_name"),
    "f_name_domain_like": f"regexp_matches(business_name, '(?i)\\.(?:{'|'.join(DOMAIN_ENDINGS)})(?:{NW}|$)')",
    "f_name_bracket": r"regexp_matches(business_name, '[\[\]]')",
    "f_name_letter_digit": r"regexp_matches(business_name, '[A-Za-z]{2,}\d+[A-Za-z]*|\d+[A-Za-z]{2,}')",
}
ACCENT = r"regexp_matches(business_name || ' ' || business_address, '[^\x00-\x7F]') AND regexp_matches(regexp_replace(business_name || ' ' || business_address, '[\x00-\x7F]', '', 'g'), '\p{Latin}')"
MIX = {
    "name_multi_script": "false",
    "name_mixed_in_token": "false",
    "latin_accent": ACCENT,
    "fr_like_heuristic": f"(len(list_intersect(regexp_split_to_array(lower(strip_accents(business_name || ' ' || business_address)), '[^\\p{{L}}]+'), [{_FRENCH}])) > 0 OR regexp_matches(business_address, '{_STREET}') OR ({ACCENT}))",
}


def rates(flags: dict[str, str]) -> str:
    return f"SELECT split, src, country, {', '.join(f'round(100 * avg(({e})::INT), 1) AS {n}' for n, e in flags.items())} FROM records GROUP BY ALL"


CHARS = ", chars AS MATERIALIZED (SELECT split, ch, count(*) AS n FROM (SELECT split, unnest(string_split(business_name || ' ' || business_address, '')) AS ch FROM records) WHERE ch <> '' GROUP BY ALL)"


def sql(*parts: str) -> str:
    """WITH clauses, and the query as the last part."""
    return "WITH " + "".join(parts[:-1]).lstrip(",\n ") + "\n" + parts[-1]

"""Name and address cleaning as column expressions.

All but Unicode folding run inside the JVM.  ``\\s`` and ``\\d`` are Unicode-aware
(``(?U)``); a word character is ``[\\p{L}\\p{N}_]`` and word borders are spelled out,
because Java's own ``\\w`` would count combining marks.
"""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..workers import arrow_function

WORD = r"[\p{L}\p{N}_]"
LEFT, RIGHT = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"

# Lists that decide what counts as noise.
LEADING_JUNK = r"""[\s>*\-_.'"]+"""
COMPANY_PREFIX = r"(?:m/s\.?|messrs\.?)"
ALIAS_MARKERS = ["f/?k/?a", "a/?k/?a", "d/?b/?a", "dba", "t/?a", "formerly known as", "formerly", "trading as"]
DOMAIN_ENDINGS = ["com", "net", "org", "in", "co", "io", "biz", "info", "fr"]
NULL_WORDS = ["null", "n/?a", "nan"]
LEGAL_WORDS = ["private", "pvt", "ltd", "limited", "llc", "inc", "incorporated", "corp", "corporation", "co", "company", "llp", "plc", "gmbh", "sarl", "sas", "sasu", "eurl", "snc", "sci"]
NATIVE_SCRIPTS = "[ऀ-ൿ]"

ID_MARKER = rf"(?iU)\(\s*id\s*[:#]?\s*(?:{WORD}|-)+\s*\)"
TRAILING_PHONE = r"(?U)\s*-\s*\d{7,}\s*$"
DOMAIN = rf"(?iU)^\s*((?:{WORD}|-)+)\.(?:{'|'.join(DOMAIN_ENDINGS)}){RIGHT}"
ALIAS = rf"(?iU){LEFT}(?:{'|'.join(ALIAS_MARKERS)}){RIGHT}"
# Only an n can begin one: looking ahead is cheaper than looking behind at every character.
NULL_TOKEN = rf"(?iU)(?=n){LEFT}(?:{'|'.join(NULL_WORDS)}){RIGHT}"


def strip(x: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(x, r"(?U)^\s+|\s+$", "")


def squeezed(x: Column) -> Column:
    return strip(F.regexp_replace(x, r"(?U)\s+", " "))


def strip_leading_junk(x: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(x, rf"(?U)^{LEADING_JUNK}", ""), rf"(?iU)^{COMPANY_PREFIX}\s+", "")


def id_marker(x: Column) -> Column:
    """The first ``(ID: x)`` marker, or an empty string."""
    return F.regexp_extract(x, ID_MARKER, 0)


def without_id_marker(x: Column) -> Column:
    """Text without its first marker, stripped; text without a marker stays as it is.

    The first place where the marker's own text stands is the first match, so no regular expression need stop after one.
    """
    marker = id_marker(x)
    at = F.instr(x, marker)
    return F.when(marker == "", x).otherwise(strip(F.concat(F.substring(x, F.lit(1), at - 1), F.substring(x, at + F.length(marker), F.length(x)))))


def has_trailing_phone(x: Column) -> Column:
    return x.rlike(TRAILING_PHONE)


def without_phone(x: Column) -> Column:
    return F.regexp_replace(x, TRAILING_PHONE, "")


def is_domain_like(x: Column) -> Column:
    return strip(without_phone(x)).rlike(DOMAIN)


def domain_core(x: Column) -> Column:
    """The label of a domain-like name, else the name; a phone is dropped from domain-like names only."""
    return F.when(is_domain_like(x), F.regexp_extract(strip(without_phone(x)), DOMAIN, 1)).otherwise(x)


def alias_parts(x: Column) -> Column:
    """The names on either side of alias markers; the name itself unless two parts are left."""
    parts = F.filter(F.transform(F.split(x, ALIAS, -1), lambda p: F.regexp_replace(p, r"^[ ,;\-]+|[ ,;\-]+$", "")), lambda p: p != "")
    return F.when(F.size(parts) > 1, parts).otherwise(F.array(x))


def without_brackets(x: Column) -> Column:
    """Marker and round brackets go with what they hold; square and curly brackets go alone."""
    return squeezed(F.regexp_replace(F.regexp_replace(without_id_marker(x), r"\([^)]*\)", " "), r"[\[\]{}]", " "))


def folded(text: str, fold_case: bool) -> str:
    if text.isascii():
        return text.lower() if fold_case else text
    plain = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
    return plain.casefold() if fold_case else plain


def _fold_accents(x: pa.Array) -> pa.Array:
    """Compatibility decomposition without combining characters; a null stays null."""
    return pa.array([None if t is None else folded(t, False) for t in x.to_pylist()], pa.string())


def _casefold(x: pa.Array) -> pa.Array:
    return pa.array([None if t is None else t.casefold() for t in x.to_pylist()], pa.string())


def _fold_all(x: pa.Array) -> pa.Array:
    """Accents folded in every element of an array."""
    return pa.array([None if t is None else [folded(e, False) for e in t] for t in x.to_pylist()], pa.list_(pa.string()))


def _casefold_all(x: pa.Array) -> pa.Array:
    return pa.array([None if t is None else [e.casefold() for e in t] for t in x.to_pylist()], pa.list_(pa.string()))


fold_accents = arrow_function("string")(_fold_accents)
casefold = arrow_function("string")(_casefold)
fold_all = arrow_function("array<string>")(_fold_all)
casefold_all = arrow_function("array<string>")(_casefold_all)


def collapse_duplicates(x: Column) -> Column:
    """A word that directly follows itself, whatever its case, stays once."""
    return F.regexp_replace(x, rf"(?iuU){LEFT}({WORD}+)(?:\s+\1{RIGHT})+", "$1")


def squash(x: Column) -> Column:
    return F.regexp_replace(x, "[^a-z0-9]", "")


def pieces(x: Column) -> Column:
    """Runs between white space."""
    return F.filter(F.split(x, r"(?U)\s+", -1), lambda t: t != "")


def without_legal_words(x: Column) -> Column:
    """Without legal-form words; the whole text if nothing else is in it."""
    kept = F.array_join(F.filter(pieces(x), lambda t: ~F.regexp_replace(t, r"^[.,]+|[.,]+$", "").isin(LEGAL_WORDS)), " ")
    return F.when(kept == "", x).otherwise(kept)


def name_base(x: Column) -> Column:
    """Aliases of a raw name, up to the point where Unicode is folded."""
    text = strip_leading_junk(strip(x))
    return F.transform(alias_parts(domain_core(text)), without_brackets)


def clean_name(x: Column, folded_parts: Column) -> dict[str, Column]:
    """Columns of a cleaned name; ``folded_parts`` is fold_all(name_base(x)) as a column of its own."""
    text = strip_leading_junk(strip(x))
    return {"cased": F.transform(folded_parts, lambda p: squeezed(collapse_duplicates(p))), "is_domain_like": is_domain_like(text), "had_phone_suffix": has_trailing_phone(text), "had_alias_marker": F.size(folded_parts) > 1}


def address_base(x: Column) -> Column:
    """An address up to the point where Unicode is folded."""
    text = without_id_marker(strip_leading_junk(strip(x)))
    text = F.regexp_replace(F.regexp_replace(text, NULL_TOKEN, " "), "#+", "")
    return without_brackets(text)


def address_flags(x: Column) -> dict[str, Column]:
    before = strip_leading_junk(strip(x))
    text = without_id_marker(before)
    return {"had_null_token": text.rlike(NULL_TOKEN), "had_hash": F.contains(text, F.lit("#")), "had_id_marker": id_marker(before) != ""}


def numeric_tokens(x: Column) -> Column:
    return F.regexp_extract_all(x, F.lit(r"(?U)\d+"), F.lit(0))


def word_bag(x: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(x, F.lit("[a-z]{2,}"), F.lit(0)))


def is_native(x: Column) -> Column:
    return x.rlike(NATIVE_SCRIPTS)


def name_words(x: Column) -> Column:
    """White-space pieces of a casefolded text, without outer punctuation, empty and all-digit pieces."""
    edge = r"[^\p{L}\p{N}_\x{0900}-\x{0D7F}]+"
    trimmed = F.transform(pieces(x), lambda t: F.regexp_replace(t, rf"^{edge}|{edge}$", ""))
    return F.filter(trimmed, lambda t: (t != "") & ~t.rlike(r"(?U)^\d+$"))


def char_ngrams(x: Column, n: int) -> Column:
    """All character n-grams with repeats; a shorter text that is not empty stands for itself.

    One pass of a look-ahead: a lambda over positions would compute the text, and walk it, again for each of them.
    """
    grams = F.regexp_extract_all(x, F.lit(rf"(?s)(?=(.{{{n}}}))."), F.lit(1))
    return F.when(F.length(x) >= n, grams).when(F.length(x) > 0, F.array(x)).otherwise(F.array().cast("array<string>"))


def char_wb_ngrams(x: Column) -> Column:
    """3- and 4-grams of a word with a blank on either side; none of an empty word."""
    padded = F.concat(F.lit(" "), x, F.lit(" "))
    return F.when(F.length(x) > 0, F.concat(char_ngrams(padded, 3), F.when(F.length(padded) >= 4, char_ngrams(padded, 4)).otherwise(F.array().cast("array<string>")))).otherwise(F.array().cast("array<string>"))


def number_keys(numbers: Column) -> Column:
    return F.transform(F.filter(numbers, lambda n: F.length(n) >= 3), lambda n: F.right(n, F.lit(4)))


def pin_keys(numbers: Column) -> Column:
    return F.filter(numbers, lambda n: F.length(n) >= 5)

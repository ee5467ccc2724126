"""Normalised records: cleaned names and addresses with the tokens that keys and features are made of."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import plain
from ..functions import text as X
from ..workers import arrow_function

_LIST = pa.list_(pa.string())
NAME = {"cased": _LIST, "folded": _LIST, "squashed": _LIST, "no_suffix": _LIST, "name_tokens": pa.list_(_LIST), "is_domain_like": pa.bool_(), "had_phone_suffix": pa.bool_(), "had_alias_marker": pa.bool_()}
ADDRESS = {"addr": pa.string(), "addr_numbers": _LIST, "addr_words": _LIST, "had_null_token": pa.bool_(), "had_hash": pa.bool_(), "had_id_marker": pa.bool_()}
KEYS = {"squash": pa.string(), "squash_alt": pa.string(), "name_tokens": _LIST, "name_ngrams": _LIST, "addr_tokens": _LIST, "addr_num_keys": _LIST, "addr_pin_keys": _LIST}
_SQL = {pa.string(): "string", pa.bool_(): "boolean", _LIST: "array<string>", pa.list_(_LIST): "array<array<string>>"}


def _struct(fields: dict[str, pa.DataType]):
    """Decorator: an Arrow function that returns a struct of ``fields``, from a function of texts that gives a tuple of them."""

    def wrap(f):
        def run(*columns: pa.Array) -> pa.Array:
            rows = [f(*x) for x in zip(*(c.to_pylist() for c in columns), strict=True)]
            made = list(zip(*rows, strict=True)) or [()] * len(fields)
            return pa.StructArray.from_arrays([pa.array(v, t) for v, t in zip(made, fields.values(), strict=True)], names=list(fields))

        return arrow_function(f"struct<{', '.join(f'{n}: {_SQL[t]}' for n, t in fields.items())}>")(run)

    return wrap


def _keys(name: str | None, address: str | None) -> tuple:
    _, _, squashed, no_suffix, tokens, *_ = plain.name(name)
    _, numbers, words, *_ = plain.address(address)
    alt = squashed[-1] if len(squashed) > 1 else ""
    if numbers is None:
        return squashed[0], alt, tokens[0], plain.char_ngrams(no_suffix[0], 4), None, None, None
    return squashed[0], alt, tokens[0], plain.char_ngrams(no_suffix[0], 4), words, [n[-4:] for n in numbers if len(n) >= 3], [n for n in numbers if len(n) >= 5]


_name, _address, _blocking = _struct(NAME)(plain.name), _struct(ADDRESS)(plain.address), _struct(KEYS)(_keys)


_squashed = arrow_function("string")(lambda x: pa.array([plain.first_squashed(t) for t in x.to_pylist()], pa.string()))


def _named(records: DataFrame, dictionary: DataFrame | None) -> tuple[DataFrame, Column]:
    if dictionary is None:
        return records, F.col("business_name")
    from .translit import latinised

    return latinised(records, dictionary), F.col("latin_name")


def normalise(records: DataFrame, dictionary: DataFrame | None = None) -> DataFrame:
    """``records`` with

    cased, folded, squashed, no_suffix (arrays over name variants), name_tokens (array of arrays), the name flags,
    addr (casefolded address), addr_numbers, addr_words and the address flags.
    """
    records, name = _named(records, dictionary)
    rows = records.withColumns({"_name": _name(name), "_addr": _address(F.col("business_address"))})
    rows = rows.withColumns({**{c: F.col(f"_name.{c}") for c in NAME}, **{c: F.col(f"_addr.{c}") for c in ADDRESS}})
    rows = rows.withColumns({"addr_is_empty": F.col("addr") == "", "is_native_name": X.is_native(F.col("business_name"))})
    return rows.drop("_name", "_addr", "latin_name")


def blocking_columns(rows: DataFrame) -> DataFrame:
    """entity_id, country, src and the seven things that blocking keys come from, of normalised ``rows``."""
    return rows.select(
        "entity_id", "country", "src",
        F.col("squashed")[0].alias("squash"),
        F.when(F.size("squashed") > 1, F.element_at("squashed", -1)).otherwise("").alias("squash_alt"),
        F.col("name_tokens")[0].alias("name_tokens"),
        X.char_ngrams(X.squash(F.col("no_suffix")[0]), 4).alias("name_ngrams"),
        F.col("addr_words").alias("addr_tokens"),
        X.number_keys(F.col("addr_numbers")).alias("addr_num_keys"),
        X.pin_keys(F.col("addr_numbers")).alias("addr_pin_keys"),
    )


def blocking_keys(records: DataFrame, dictionary: DataFrame | None = None) -> DataFrame:
    """blocking_columns(normalise(records)) without the columns that it does not need."""
    records, name = _named(records, dictionary)
    rows = records.select("entity_id", "country", "src", _blocking(name, F.col("business_address")).alias("k"))
    return rows.select("entity_id", "country", "src", *[F.col(f"k.{c}") for c in KEYS])


def squashed_names(records: DataFrame) -> DataFrame:
    """entity_id, country, src and squash, the squashed first name variant."""
    return records.select("entity_id", "country", "src", _squashed(F.col("business_name")).alias("squash"))


def all_tokens(column: Column) -> Column:
    """Distinct tokens over all variants."""
    return F.array_distinct(F.flatten(column))

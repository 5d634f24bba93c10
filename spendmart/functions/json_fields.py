"""Strict one-object-per-line JSON parsing with absent-versus-null told apart."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
JSON_OPTIONS = {"allowSingleQuotes": "false", "columnNameOfCorruptRecord": CORRUPT}


def record_of(line: Column, keys: list[str]) -> Column:
    """Struct with one string per key. Of a repeated key the last value is kept."""
    fields = [T.StructField(key, T.StringType()) for key in [*keys, CORRUPT]]
    return F.from_json(line, T.StructType(fields), JSON_OPTIONS)


def looks_like_object(line: Column) -> Column:
    return line.startswith("{") & line.endswith("}")


def is_single_object(line: Column, record: Column) -> Column:
    """True when the (stripped) line is exactly one well-formed JSON object.

    The parser stops after the first object, so text behind it would go unseen. If the first
    closing brace is the last character nothing can follow; only other lines (nested values,
    braces in strings, trailing text) pay for a second, tokenizing check.
    """
    parsed = record.isNotNull() & record.getField(CORRUPT).isNull()
    before_brace = F.substring_index(line, "}", 1)
    nothing_follows = F.octet_length(before_brace) == F.octet_length(line) - 1
    one_value = F.json_array_length(F.concat(F.lit("["), line, F.lit("]"))) == 1
    return F.coalesce(
        F.when(parsed & looks_like_object(line), F.when(nothing_follows, True).otherwise(one_value)),
        F.lit(False),
    )


def keys_if_needed(line: Column, record: Column, fields: list[str]) -> Column:
    """Names of the line's members, null where every field has a value.

    A struct field is null when its key is absent and when its value is null; the names tell the two
    apart. They cost a second parse, once a line and only behind the null test.
    """
    lacking = F.lit(False)
    for field in fields:
        lacking = lacking | record.getField(field).isNull()
    members = F.from_json(line, T.MapType(T.StringType(), T.StringType()), JSON_OPTIONS)
    return F.when(record.isNotNull() & lacking, F.map_keys(members))


def get_or_default(keys: Column, record: Column, key: str, default: str) -> Column:
    """The key's text; ``default`` when the key is absent; null when its value is null."""
    value = record.getField(key)
    absent = ~F.array_contains(keys, key)
    return F.when(value.isNotNull(), value).when(absent, F.lit(default))

"""Country codes and the geo-targets table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import INTEGER_TEXT, parse_double
from ..schemas import GEO_TARGET_TYPES, MISSING_TEXTS, UNKNOWN_COUNTRY, require_columns


def map_key(code: Column) -> Column:
    """A code of the map as the lookup spells it: integers without padding, other text as is."""
    whole = F.when(code.rlike(INTEGER_TEXT), code.try_cast("bigint").cast("string"))
    return F.coalesce(whole, code)


def match_key(code: Column) -> Column:
    """A code compared by value: ``2004``, ``" 2004"`` and ``2004.0`` are the same code."""
    number = parse_double(code)
    whole = F.when(number == F.floor(number), number.try_cast("bigint").cast("string"))
    return F.coalesce(whole, code)


def geo_map(rows: DataFrame) -> DataFrame:
    """``code, iso, match_code`` from a table with ``country_code`` and ``Country``."""
    require_columns(rows.columns, ["country_code", "Country"], "country code map")
    code = F.col("country_code").cast("string")
    return rows.select(
        map_key(code).alias("code"),
        F.col("Country").alias("iso"),
        match_key(code).alias("match_code"),
    )


def map_country_codes(rows: DataFrame, codes: DataFrame, column: str) -> DataFrame:
    """Replace the code in ``column`` by its country.

    A code the map lacks, or no code, gives ``Unknown``; a code mapped to null stays null, so
    a flag tells the two apart. Codes are compared as text.
    """
    lookup = codes.select(
        F.col("code").alias("_code"), F.col("iso").alias("_iso"), F.lit(True).alias("_hit")
    )
    joined = rows.join(lookup, F.col(column) == F.col("_code"), "left")
    country = F.when(F.col("_hit"), F.col("_iso")).otherwise(F.lit(UNKNOWN_COUNTRY))
    return joined.select(
        *[country.alias(column) if name == column else F.col(name) for name in rows.columns]
    )


def last_of_each_key(
    rows: DataFrame, keys: list[str], position: list[str], values: list[str]
) -> DataFrame:
    """One row per key: the one at the highest position, which no two rows of a key share.

    A single position is a hashed maximum, and the winners are joined back; several are a grouped
    ``max_by``. Either keeps one row per key and task before the shuffle, so a key that holds a
    third of all rows never gathers in one place.
    """
    if len(position) == 1:
        last = rows.groupBy(*keys).agg(F.max(position[0]).alias("_last"))
        same = F.col(position[0]) == F.col("_last")
        for i, key in enumerate(keys):
            last = last.withColumnRenamed(key, f"_key{i}")
            same = same & F.col(key).eqNullSafe(F.col(f"_key{i}"))
        return rows.join(last, same).select(*keys, *values)
    newest = F.max_by(F.struct(*values), F.struct(*position)).alias("_newest")
    return rows.groupBy(*keys).agg(newest).select(*keys, "_newest.*")


def distinct_codes(rows: DataFrame, column: str = "country_code") -> DataFrame:
    return rows.select(column).where(F.col(column).isNotNull()).distinct()


def curate_targets(targets: DataFrame) -> DataFrame:
    """Countries and regions without a parent, as ``Criteria ID, Country Code, Name``."""
    require_columns(
        targets.columns,
        ["Criteria ID", "Country Code", "Name", "Target Type", "Parent ID"],
        "geo targets",
    )
    parent = F.col("Parent ID").cast("string")
    no_parent = parent.isNull() | parent.isin(*MISSING_TEXTS)
    return targets.where(F.col("Target Type").isin(*GEO_TARGET_TYPES) & no_parent).select(
        "Criteria ID", "Country Code", "Name"
    )


def rename_targets(targets: DataFrame) -> DataFrame:
    """``Country Code, Name`` as ``country, country_name``."""
    return targets.select("Country Code", "Name").withColumnsRenamed(
        {"Country Code": "country", "Name": "country_name"}
    )

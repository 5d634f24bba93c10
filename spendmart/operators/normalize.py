"""Raw lines of any channel to the five common text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.json_fields import (
    get_or_default,
    is_single_object,
    keys_if_needed,
    looks_like_object,
    record_of,
)
from ..functions.text import stripped
from ..schemas import ChannelSpec, require_columns
from .geo import map_country_codes
from .shape import select_once


def parse_lines(lines: DataFrame, spec: ChannelSpec, keep: tuple[str, ...] = ()) -> DataFrame:
    """``line`` -> ``line``, ``record`` (struct of the channel's raw keys), ``well_formed``, ``keys``.

    The JSON is parsed here, once; see ``select_once`` for the later steps. ``keys`` are the names
    of the line's members where some field has no value, else null. ``keep`` names other columns of
    ``lines`` to carry along.
    """
    require_columns(lines.columns, ["line"], "raw input")
    keys = [field.key for field in spec.fields.values()]
    line = F.col("line")
    return (
        lines.select(F.when(looks_like_object(line), line).otherwise(stripped(line)).alias("line"), *keep)
        .withColumn("record", record_of(F.col("line"), keys))
        .withColumn("well_formed", is_single_object(F.col("line"), F.col("record")))
        .withColumn("keys", keys_if_needed(F.col("line"), F.col("record"), keys))
    )


def common_fields(spec: ChannelSpec) -> list[Column]:
    """The common schema as text, absent keys filled in. Country may still be a code."""
    return [
        get_or_default(F.col("keys"), F.col("record"), field.key, field.default).alias(name)
        for name, field in spec.fields.items()
    ]


def normalize(lines: DataFrame, spec: ChannelSpec, geo_map: DataFrame | None = None) -> DataFrame:
    """Well-formed lines as ``currency, country, day, impressions, cost`` text.

    Channels that report country codes need ``geo_map`` (see ``operators.geo``).
    """
    parsed = parse_lines(lines, spec)
    rows = (
        select_once(parsed, "well_formed", *common_fields(spec))
        .where("well_formed")
        .drop("well_formed")
    )
    if spec.country_is_code:
        if geo_map is None:
            raise ValueError(f"channel {spec.channel!r} needs a country code map")
        rows = map_country_codes(rows, geo_map, "country")
    return rows

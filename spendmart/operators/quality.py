"""Validation: every raw line is either accepted or carries the reason it is not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import parse_day
from ..functions.numbers import parse_double, parse_long, round_cost
from ..schemas import ChannelSpec
from .geo import match_key
from .normalize import common_fields, parse_lines
from .shape import select_once

MALFORMED = "malformed_json"
INVALID_DAY = "invalid_day"
INVALID_METRIC = "invalid_metric"
ACCEPTED = "accepted"
REASONS = (MALFORMED, INVALID_DAY, INVALID_METRIC)


def typed_columns() -> list[Column]:
    """``date``, ``impressions`` and ``cost`` parsed from text; null where the text is invalid.

    The cost is not rounded yet. Rounding is left to the next projection: within this one the
    parse would be repeated for every mention of the value.
    """
    return [
        parse_day(F.col("day")).alias("date"),
        parse_long(F.col("impressions")).alias("impressions"),
        parse_double(F.col("cost")).alias("cost"),
    ]


def reject_reason() -> Column:
    """First failed check of a typed row, or null when the row is acceptable."""
    return (
        F.when(~F.col("well_formed"), F.lit(MALFORMED))
        .when(F.col("date").isNull(), F.lit(INVALID_DAY))
        .when(F.col("impressions").isNull() | F.col("cost").isNull(), F.lit(INVALID_METRIC))
    )


def validate(lines: DataFrame, spec: ChannelSpec, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per line: ``currency, country, date, impressions, cost, reason``, and ``keep``.

    Country codes are not looked up here: no check depends on them, so the lookup can wait
    until the rejected rows are gone.
    """
    parsed = parse_lines(lines, spec, keep)
    text = parsed.select("well_formed", *keep, *common_fields(spec))
    typed = text.select("well_formed", *keep, "currency", "country", *typed_columns())
    return select_once(
        typed,
        *keep,
        "currency",
        "country",
        "date",
        "impressions",
        round_cost(F.col("cost")).alias("cost"),
        reject_reason().alias("reason"),
    )


def accepted(validated: DataFrame) -> DataFrame:
    return validated.where(F.col("reason").isNull()).drop("reason")


def rejected(validated: DataFrame) -> DataFrame:
    return validated.where(F.col("reason").isNotNull())


def reject_counts(validated: DataFrame) -> DataFrame:
    """``reason, n``. Counts are combined before the shuffle: three rows per task move."""
    return rejected(validated).groupBy("reason").agg(F.count("*").alias("n"))


def reject_metrics() -> list[Column]:
    """Aggregates for ``DataFrame.observe``: the same counts without a job of their own."""
    counts = [F.count_if(F.col("reason") == reason).alias(reason) for reason in REASONS]
    return [F.count("*").alias("lines"), *counts]


def drop_invalid_day(rows: DataFrame) -> DataFrame:
    """Normalized text rows whose ``day`` is a real day."""
    return rows.where(parse_day(F.col("day")).isNotNull())


def drop_invalid_metrics(rows: DataFrame) -> DataFrame:
    """Normalized text rows with numeric impressions and cost, both typed."""
    _, impressions, cost = typed_columns()
    others = [name for name in rows.columns if name not in ("impressions", "cost")]
    typed = select_once(
        rows.select(*others, impressions, cost),
        *others,
        "impressions",
        round_cost(F.col("cost")).alias("cost"),
    )
    return typed.where(F.col("impressions").isNotNull() & F.col("cost").isNotNull())


def raw_fields(lines: DataFrame, spec: ChannelSpec) -> DataFrame:
    """Well-formed lines as their raw values, no defaults: absent and null are both null."""
    parsed = parse_lines(lines, spec)
    values = [
        F.col("record").getField(field.key).alias(name) for name, field in spec.fields.items()
    ]
    return select_once(parsed, "well_formed", *values).where("well_formed").drop("well_formed")


def null_metric_rows(rows: DataFrame, metric: str = "impressions") -> DataFrame:
    """Rows of ``raw_fields`` whose metric is null or absent."""
    return rows.where(F.col(metric).isNull())


def unmapped_codes(rows: DataFrame, geo_map: DataFrame, code: str = "country") -> DataFrame:
    """Rows whose country code the map lacks; rows without a code are among them.

    An anti join, not NOT IN: that would return nothing for a null code.
    """
    known = geo_map.select(F.col("match_code")).where(F.col("match_code").isNotNull())
    keyed = rows.withColumn("row_code", match_key(F.col(code)))
    return keyed.join(known, F.col("row_code") == F.col("match_code"), "left_anti").drop("row_code")

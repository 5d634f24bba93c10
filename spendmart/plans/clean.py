"""Raw lines of one channel -> clean, typed, day-partitioned rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import date_id, day_text, parse_day
from ..functions.text import file_day
from ..loads import Layout, read_loads
from ..operators.geo import map_country_codes
from ..operators.quality import ACCEPTED, accepted, validate
from ..schemas import CLEAN_SCHEMA, ChannelSpec

#: A channel's lines, accepted and rejected: folders by reason and month, replaced by day.
JUDGED_LOADS = Layout(
    schema=T.StructType(
        [
            *(CLEAN_SCHEMA[name] for name in ("currency", "country", "day", "impressions", "cost")),
            T.StructField("line", T.StringType()),
            T.StructField("file_name", T.StringType()),
            T.StructField("reason", T.StringType()),
            *(CLEAN_SCHEMA[name] for name in ("year", "month", "day_of_month")),
        ]
    ),
    folders=("reason", "year", "month"),
    keys=("year", "month", "day_of_month"),
)


def clean_rows(
    validated: DataFrame, spec: ChannelSpec, geo_map: DataFrame | None = None
) -> DataFrame:
    """Accepted rows in the clean schema, partition columns last."""
    rows = accepted(validated)
    if spec.country_is_code:
        if geo_map is None:
            raise ValueError(f"channel {spec.channel!r} needs a country code map")
        rows = map_country_codes(rows, geo_map, "country")
    return rows.select(
        "currency",
        "country",
        day_text(F.col("date")).alias("day"),
        "impressions",
        "cost",
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        F.dayofmonth("date").alias("day_of_month"),
    )


def clean_ads(lines: DataFrame, spec: ChannelSpec, geo_map: DataFrame | None = None) -> DataFrame:
    """No shuffle: scan, parse, filter and a broadcast lookup run in one stage."""
    return clean_rows(validate(lines, spec), spec, geo_map)


def partition_row_counts(clean: DataFrame) -> DataFrame:
    return clean.groupBy("year", "month", "day_of_month").agg(F.count("*").alias("n"))


def judged_rows(lines: DataFrame, spec: ChannelSpec, geo_map: DataFrame | None = None) -> DataFrame:
    """Every line once, in the columns of ``JUDGED_LOADS``: clean fields of accepted lines, the text
    of rejected ones with the reason.

    ``lines`` are ``line, file_name``. A line belongs to its record's day, or else to its file's; one
    that names neither has none.
    """
    original = lines.withColumn("text", F.col("line"))
    rows = validate(original, spec, ("text", "file_name"))
    good = F.col("reason").isNull()
    if spec.country_is_code:
        if geo_map is None:
            raise ValueError(f"channel {spec.channel!r} needs a country code map")
        rows = map_country_codes(rows, geo_map, "country")
    of = F.coalesce("date", parse_day(file_day(F.col("file_name"))))
    rows = rows.withColumn("of", of)
    return rows.select(
        *(F.when(good, F.col(name)).alias(name) for name in ("currency", "country")),
        F.when(good, day_text(F.col("date"))).alias("day"),
        *(F.when(good, F.col(name)).alias(name) for name in ("impressions", "cost")),
        F.when(~good, F.col("text")).alias("line"),
        F.when(~good, F.col("file_name")).alias("file_name"),
        F.coalesce("reason", F.lit(ACCEPTED)).alias("reason"),
        F.year("of").alias("year"),
        F.month("of").alias("month"),
        F.dayofmonth("of").alias("day_of_month"),
    )


def in_period(year: int | None = None, month: int | None = None) -> Column:
    if month is not None and year is None:
        raise ValueError("a month needs its year")
    wanted = F.lit(True)
    if year is not None:
        wanted = wanted & (F.col("year") == year)
    return wanted if month is None else wanted & (F.col("month") == month)


def read_accepted(spark: SparkSession, path: str, *, year: int | None = None, month: int | None = None) -> DataFrame:
    """``currency, country, date_id, impressions, cost`` of a channel's lines as last loaded."""
    rows = read_loads(spark, path, JUDGED_LOADS, in_period(year, month) & (F.col("reason") == ACCEPTED))
    day = date_id(F.col("year"), F.col("month"), F.col("day_of_month"))
    return rows.select("currency", "country", day.alias("date_id"), "impressions", "cost")


def read_rejected(spark: SparkSession, path: str, *, year: int | None = None, month: int | None = None) -> DataFrame:
    """``reason, line, file_name, year, month, day_of_month`` of the rejected lines as last loaded."""
    rows = read_loads(spark, path, JUDGED_LOADS, in_period(year, month) & (F.col("reason") != ACCEPTED))
    return rows.select("reason", "line", "file_name", "year", "month", "day_of_month")

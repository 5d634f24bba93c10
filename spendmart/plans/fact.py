"""Clean rows of all channels + lookup tables -> fact rows with spend in USD."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import date_id
from ..loads import Layout, read_loads, write_load
from ..operators.lookup import join_channel, join_country, join_rates, sized_lookup
from ..operators.shape import union_all
from ..schemas import (
    DIM_CHANNEL_COLUMNS,
    DIM_COUNTRY_COLUMNS,
    EXCHANGE_RATE_COLUMNS,
    FACT_SCHEMA,
)
from ..sources.files import project

#: The fact table: folders by channel and month, replaced by channel and day.
FACT_LOADS = Layout(
    schema=T.StructType([*FACT_SCHEMA, T.StructField("month", T.StringType())]),
    folders=("channel_id", "month"),
    keys=("channel_id", "date_id"),
)


@dataclass(frozen=True)
class Lookups:
    countries: DataFrame
    rates: DataFrame
    channels: DataFrame

    @classmethod
    def checked(
        cls,
        countries: DataFrame,
        rates: DataFrame,
        channels: DataFrame,
        *,
        date_prefix: str = "",
        allow_repeated_keys: bool = False,
    ) -> Lookups:
        """Project, measure and mark the lookup tables (one small job each).

        ``date_prefix`` (``yyyy`` or ``yyyyMM``) keeps the rates of the days being loaded.
        """
        rates = project(rates, EXCHANGE_RATE_COLUMNS)
        if date_prefix:
            rates = rates.where(F.col("date_id").startswith(date_prefix))
        repeat = {"allow_repeated_keys": allow_repeated_keys}
        return cls(
            sized_lookup(project(countries, DIM_COUNTRY_COLUMNS), ["country"], **repeat),
            sized_lookup(rates, ["date_id", "currency"], **repeat),
            sized_lookup(project(channels, DIM_CHANNEL_COLUMNS), ["channel"], **repeat),
        )


def with_date_id(clean: DataFrame) -> DataFrame:
    """Clean rows keyed by ``date_id`` instead of partition values."""
    day = date_id(F.col("year"), F.col("month"), F.col("day_of_month"))
    return clean.select("currency", "country", day.alias("date_id"), "impressions", "cost")


def combine_channels(by_channel: dict[str, DataFrame]) -> DataFrame:
    """UNION ALL of the channels' rows, each tagged with its channel."""
    return union_all([ads.withColumn("channel", F.lit(name)) for name, ads in by_channel.items()])


def join_country_fx(ads: DataFrame, lookups: Lookups) -> DataFrame:
    """Combined rows with country id and rate; every input row appears once."""
    joined = join_rates(join_country(ads, lookups.countries), lookups.rates)
    return joined.select(
        "channel",
        "date_id",
        "country_id",
        "currency",
        "exchange_rate_usd",
        F.col("cost").alias("cost_original"),
        "impressions",
    )


def with_cost_usd(joined: DataFrame) -> DataFrame:
    """Null where there is no rate."""
    return joined.withColumn("cost_usd", F.col("cost_original") * F.col("exchange_rate_usd"))


def fact_rows(joined: DataFrame, lookups: Lookups) -> DataFrame:
    """The fact projection. Impressions beyond the int range become null, not a wrong number."""
    return with_cost_usd(join_channel(joined, lookups.channels)).select(
        "channel_id",
        "date_id",
        "country_id",
        F.col("impressions").try_cast("int").alias("impressions"),
        F.col("cost_usd").cast("double").alias("cost_usd"),
    )


def build_fact(by_channel: dict[str, DataFrame], lookups: Lookups) -> DataFrame:
    """Channels are combined first, so that each lookup is joined once. Nothing is aggregated:
    equal rows stay separate fact rows."""
    return fact_rows(join_country_fx(combine_channels(by_channel), lookups), lookups)


def channel_row_counts(combined: DataFrame) -> DataFrame:
    return combined.groupBy("channel").agg(F.count("*").alias("n"))


def preview(rows: DataFrame, n: int, order: list[str]) -> DataFrame:
    """First ``n`` rows in a fixed order; each task keeps only its own first ``n``."""
    return rows.orderBy(*order).limit(n)


def load_fact(
    fact: DataFrame, path: str, *, seen: DataFrame | None = None, gather: bool = True, file_rows: int | None = None
) -> str:
    """Write fact rows as a load, which replaces the days of the channels it holds and no others.

    ``seen`` (``channel_id, date_id``) are days to replace even if no row of them is left.
    """
    monthly = fact.withColumn("month", F.substring("date_id", 1, 6))
    return write_load(monthly, path, FACT_LOADS, seen=seen, gather=gather, file_rows=file_rows)


def days_between(first_day: str | None, last_day: str | None) -> Column:
    """Days from ``first_day`` to ``last_day``, by folder and by day."""
    wanted = F.lit(True)
    if first_day is not None:
        wanted = wanted & (F.col("month") >= first_day[:6]) & (F.col("date_id") >= first_day)
    if last_day is not None:
        wanted = wanted & (F.col("month") <= last_day[:6]) & (F.col("date_id") <= last_day)
    return wanted


def read_fact_loads(
    spark: SparkSession, path: str, *, first_day: str | None = None, last_day: str | None = None
) -> DataFrame:
    """The fact table as last loaded. Only folders of the months wanted are named, and so listed."""
    return read_loads(spark, path, FACT_LOADS, days_between(first_day, last_day)).select(*FACT_SCHEMA.names)

"""Left lookups that never lose a row, and the check that decides how they are joined."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A lookup table measured above this is joined by shuffle instead of broadcast.
BROADCAST_BYTES = 256 * 1024 * 1024
# Allowance per value for object headers and hash slots in the broadcast relation.
VALUE_OVERHEAD = 16


@dataclass(frozen=True)
class LookupSize:
    rows: int
    bytes: int
    repeated_keys: int


def measure_lookup(table: DataFrame, keys: list[str]) -> LookupSize:
    """Rows, in-memory bytes and repeated keys of a lookup table, in one job over that table."""
    width = sum(
        (F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0)) for name in table.columns),
        F.lit(VALUE_OVERHEAD * len(table.columns)),
    )
    per_key = table.groupBy(*keys).agg(F.count("*").alias("n"), F.sum(width).alias("bytes"))
    has_key = F.lit(True)
    for key in keys:
        has_key = has_key & F.col(key).isNotNull()
    row = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        F.count_if((F.col("n") > 1) & has_key).alias("repeated"),
    ).first()
    return LookupSize(row["rows"], row["bytes"], row["repeated"])


def sized_lookup(
    table: DataFrame,
    keys: list[str],
    *,
    broadcast_bytes: int = BROADCAST_BYTES,
    allow_repeated_keys: bool = False,
) -> DataFrame:
    """Measure a lookup table and mark it for broadcast only if its measured size allows it.

    Stored sizes are unknown for JDBC tables and misleading for compressed files, so the rows
    are measured. A larger table is returned unmarked: Spark then shuffles both sides, and
    adaptive execution splits the partitions of hot keys (left and anti joins keep the table
    side whole, so the result does not change).

    A repeated key would multiply fact rows; it raises unless ``allow_repeated_keys``.
    """
    size = measure_lookup(table, keys)
    if size.repeated_keys and not allow_repeated_keys:
        raise ValueError(f"{size.repeated_keys} keys {keys} occur more than once in a lookup table")
    return F.broadcast(table) if size.bytes <= broadcast_bytes else table


def join_country(ads: DataFrame, countries: DataFrame) -> DataFrame:
    """Adds ``country_id``; null where the country is not listed."""
    lookup = countries.select(F.col("country").alias("_country"), "country_id")
    return ads.join(lookup, F.col("country") == F.col("_country"), "left").drop("_country")


def join_rates(ads: DataFrame, rates: DataFrame) -> DataFrame:
    """Adds ``exchange_rate_usd`` by day and currency; null where there is no rate."""
    lookup = rates.select(
        F.col("date_id").cast("string").alias("_date_id"),
        F.col("currency").alias("_currency"),
        "exchange_rate_usd",
    )
    on = (F.col("date_id") == F.col("_date_id")) & (F.col("currency") == F.col("_currency"))
    return ads.join(lookup, on, "left").drop("_date_id", "_currency")


def join_channel(ads: DataFrame, channels: DataFrame) -> DataFrame:
    """Adds ``channel_id``; null where the channel is not listed."""
    lookup = channels.select(F.col("channel").alias("_channel"), "channel_id")
    return ads.join(lookup, F.col("channel") == F.col("_channel"), "left").drop("_channel")

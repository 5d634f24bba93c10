"""Table schemas and the per-channel description of the raw feeds."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Field names, defaults and labels that stored data depends on.
# ---------------------------------------------------------------------------
UNKNOWN_COUNTRY = "Unknown"
DATE_PATTERN = "yyyyMMdd"
COST_DECIMALS = 6
JDBC_BATCH_ROWS = 10_000
GEO_TARGET_TYPES = ("Country", "Region")
GEO_FIRST_ROW = 29565
GEO_LAST_ROW = 31045
# Earliest and latest whole day of a 64-bit nanosecond timestamp.
FIRST_DAY = "16770922"
LAST_DAY = "22620411"
# Texts a CSV reader in the pandas tradition takes as a missing value.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


@dataclass(frozen=True)
class RawField:
    """Key of a raw record and the text used when the key is absent."""

    key: str
    default: str


@dataclass(frozen=True)
class ChannelSpec:
    """How one channel's export maps to the common schema.

    ``country_is_code`` marks feeds whose country field is a numeric code that still has to
    be looked up.
    """

    channel: str
    prefix: str
    currency: RawField
    country: RawField
    day: RawField
    impressions: RawField
    cost: RawField
    country_is_code: bool = False

    @property
    def fields(self) -> dict[str, RawField]:
        return {
            "currency": self.currency,
            "country": self.country,
            "day": self.day,
            "impressions": self.impressions,
            "cost": self.cost,
        }


# Raw keys of each channel's export.
CHANNELS = {
    "facebook": ChannelSpec(
        channel="facebook",
        prefix="facebook_data",
        currency=RawField("Currency", ""),
        country=RawField("Country", ""),
        day=RawField("Day", ""),
        impressions=RawField("Impressions", "0"),
        cost=RawField("Amount spent", "0.0"),
    ),
    "google": ChannelSpec(
        channel="google",
        prefix="google_data",
        currency=RawField("Currency code", ""),
        country=RawField("country_code", ""),
        day=RawField("Day", ""),
        impressions=RawField("Impr.", "0"),
        cost=RawField("Cost", "0.0"),
        country_is_code=True,
    ),
}


def channel_spec(channel: str) -> ChannelSpec:
    if channel not in CHANNELS:
        raise ValueError(f"unknown channel {channel!r}; known: {sorted(CHANNELS)}")
    return CHANNELS[channel]


CLEAN_COLUMNS = ("currency", "country", "day", "impressions", "cost")
CLEAN_PARTITIONS = ("year", "month", "day_of_month")

CLEAN_SCHEMA = T.StructType(
    [
        T.StructField("currency", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("day", T.StringType()),
        T.StructField("impressions", T.LongType()),
        T.StructField("cost", T.DoubleType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("day_of_month", T.IntegerType()),
    ]
)

FACT_SCHEMA = T.StructType(
    [
        T.StructField("channel_id", T.IntegerType()),
        T.StructField("date_id", T.StringType()),
        T.StructField("country_id", T.IntegerType()),
        T.StructField("impressions", T.IntegerType()),
        T.StructField("cost_usd", T.DoubleType()),
    ]
)

# Columns read from each lookup table.
DIM_COUNTRY_COLUMNS = {"country_id": "int", "country": "string", "country_name": "string"}
DIM_CHANNEL_COLUMNS = {"channel_id": "int", "channel": "string"}
EXCHANGE_RATE_COLUMNS = {
    "date_id": "string",
    "currency": "string",
    "exchange_rate_usd": "double",
}
GEO_MAP_COLUMNS = {"country_code": "string", "Country": "string"}


def require_columns(columns: list[str], required: tuple[str, ...] | list[str], what: str) -> None:
    """Raise before planning when an input lacks columns it must have."""
    missing = [name for name in required if name not in columns]
    if missing:
        raise ValueError(f"{what} lacks columns {missing}; it has {columns}")

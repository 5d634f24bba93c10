"""Text and file-name expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITESPACE = " \t\r\n\f\v"

# Fixed value: raw files are named ..._<yyyyMMdd>.txt.
DATED_FILE = r"_([0-9]{8})(?:\.txt)+\z"
# What listing can tell already; the pattern decides.
DATED_FILE_GLOB = "*_" + "[0-9]" * 8 + "*.txt"


def stripped(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def file_day(file_name: Column) -> Column:
    """The eight digits a raw file name ends in, or empty text when there are none."""
    return F.regexp_extract(file_name, DATED_FILE, 1)


def channel_of_prefix(prefix: Column) -> Column:
    """``facebook_data`` -> ``facebook``."""
    return F.split_part(prefix, F.lit("_"), F.lit(1))

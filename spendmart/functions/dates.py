"""Day parsing and formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import DATE_PATTERN, FIRST_DAY, LAST_DAY


def digits_to_date(day: Column) -> Column:
    """Date for eight digits, null when there is no such day.

    The text is rearranged to ISO form because Spark's string-to-date cast is several times
    faster than a pattern parse, and bad days then cost no exception each.
    """
    iso = F.concat_ws("-", F.substring(day, 1, 4), F.substring(day, 5, 2), F.substring(day, 7, 2))
    return iso.try_cast("date")


def parse_day(day: Column) -> Column:
    """Date for a text of exactly eight digits that names a real day, else null.

    Days outside the range of a nanosecond timestamp are null too.
    """
    eight_digits = day.rlike(r"^[0-9]{8}\z") & day.between(FIRST_DAY, LAST_DAY)
    return F.when(eight_digits, digits_to_date(day))


def day_text(date: Column) -> Column:
    return F.date_format(date, DATE_PATTERN)


def date_id(year: Column, month: Column, day_of_month: Column) -> Column:
    """``yyyyMMdd`` from unpadded partition values."""
    return F.concat(
        year.cast("string"),
        F.lpad(month.cast("string"), 2, "0"),
        F.lpad(day_of_month.cast("string"), 2, "0"),
    )

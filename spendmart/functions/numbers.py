"""Number parsing for untrusted text.

Spark's own casts are more lenient than the feeds allow (``12d`` and ``nan`` are numbers to
them), so a pattern decides what is a number and ``try_cast`` only converts it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import COST_DECIMALS

# The accepted spellings of a number.
INTEGER_TEXT = r"^\s*[+-]?[0-9]+\s*$"
NUMBER_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"

# Below this a cost can be scaled by 10^6 without overflow.
LARGEST_SCALED = 1e300


def parse_double(text: Column) -> Column:
    """Finite double, or null."""
    number = F.when(text.rlike(NUMBER_TEXT), text.try_cast("double"))
    return F.nullif(F.nullif(number, F.lit(float("inf"))), F.lit(float("-inf")))


def parse_long(text: Column) -> Column:
    """Whole number, or null. Fractions are cut toward zero.

    Integer text goes straight to bigint: a detour over double would lose digits past 2^53.
    """
    return F.when(text.rlike(INTEGER_TEXT), text.try_cast("bigint")).otherwise(
        parse_double(text).try_cast("bigint")
    )


def round_cost(cost: Column) -> Column:
    """Round to six decimals, ties to even, in double arithmetic (scale, rint, unscale).

    ``bround`` rounds the decimal text instead and differs in the last place on some ties.
    A value too large to scale has no decimals and is kept.
    """
    scale = float(10**COST_DECIMALS)
    return F.when(F.abs(cost) < LARGEST_SCALED, F.rint(cost * scale) / scale).otherwise(cost)

"""Plan shaping shared by the other operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def select_once(df: DataFrame, *columns: Column | str) -> DataFrame:
    """``select`` whose results later filters use instead of computing them again.

    Catalyst pushes a filter below a projection by inlining the projected expressions, which
    would parse every JSON line twice. A generator's output is not inlined.
    """
    return df.select(F.inline(F.array(F.struct(*columns))))


def union_all(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL by column name; duplicates stay."""
    if not frames:
        raise ValueError("no input to combine")
    return reduce(DataFrame.unionByName, frames)

"""Dashboard summaries over the fact table. Sums are combined before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A double below the limit is a whole number and 52 binary digits, in two halves, behind the point.
HALF = float(1 << 26)
LIMIT = float(1 << 31)


def total(cost: str) -> Column:
    """Sum of a double column that does not depend on the order of addition.

    Tasks finish in any order, and double sums would change with it in the last cents. Costs below
    2^31 are added as three whole numbers each, which is exact (digits beyond 2^-52 are cut); larger
    ones, which no row of a feed should have, as doubles, so that they count too. A value that is no
    number makes the sum NaN; a group of nulls has none.
    """
    value = F.col(cost)
    unknown = F.bool_or(F.isnan(value) | (F.abs(value) == float("inf")))
    small = F.when(F.abs(value) < LIMIT, value)
    whole = F.floor(small)
    scaled = (small - whole) * HALF
    upper = F.floor(scaled)
    lower = F.floor((scaled - upper) * HALF)
    exact = F.try_sum(whole) + (F.try_sum(upper).cast("double") + F.try_sum(lower) / HALF) / HALF
    # more than a long holds can't come from fewer than 2^32 such rows
    small_sum = F.coalesce(exact, F.sum(small))
    large_sum = F.sum(F.when(F.abs(value) >= LIMIT, value))
    both = F.when(small_sum.isNull(), large_sum).when(large_sum.isNull(), small_sum).otherwise(small_sum + large_sum)
    return F.when(unknown, F.lit(float("nan"))).otherwise(both)


def spend_by_channel_and_day(fact: DataFrame) -> DataFrame:
    return fact.groupBy("channel_id", "date_id").agg(
        F.sum("impressions").alias("impressions"), total("cost_usd").alias("cost_usd")
    )


def top_countries(fact: DataFrame, n: int) -> DataFrame:
    spend = fact.groupBy("country_id").agg(total("cost_usd").alias("cost_usd"))
    return spend.orderBy(F.desc_nulls_last("cost_usd"), F.asc_nulls_last("country_id")).limit(n)


def cpm_by_channel(fact: DataFrame) -> DataFrame:
    """USD per thousand impressions; null when there were none."""
    sums = fact.groupBy("channel_id").agg(
        F.sum("impressions").alias("impressions"), total("cost_usd").alias("cost_usd")
    )
    cpm = F.try_divide(F.col("cost_usd") * 1000, F.col("impressions"))
    return sums.withColumn("cpm", cpm)

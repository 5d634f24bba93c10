"""Consecutive row numbers without gathering the rows in one task."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..staging import checkpointed

# monotonically_increasing_id() keeps the partition above this bit, the position below it.
PARTITION_BIT = 33


def number_in_order(rows: DataFrame, order: str, name: str, first: int = 1) -> DataFrame:
    """Number rows ``first, first+1, ...`` by ``order``, and by the other columns where it ties.

    Range-sorted partitions are checkpointed, so that position within a partition is fixed for
    both uses below even if a task is rerun. Only one count per partition meets in one task.
    """
    ties = [c for c, kind in rows.dtypes if c != order and not kind.startswith("map")]
    ordered = rows.orderBy(order, *ties).withColumn("_at", F.monotonically_increasing_id())
    fixed = checkpointed(ordered)
    block = F.shiftright("_at", PARTITION_BIT)
    # One row per partition: small whatever the data, so it can always be broadcast.
    return _add_numbers(fixed, [block.alias("_block")], name, first, F.broadcast)


def number_file_rows(rows: DataFrame, name: str, first: int = 1) -> DataFrame:
    """Number the rows of a file scan in file order (files by name, then by offset).

    ``rows`` must come straight from ``spark.read``: positions are taken from the scan's own
    ``_metadata``, block by block. There is one offset per block of the files, and Spark picks
    the join that adds them: a broadcast for few blocks, else a shuffle in which every group is
    at most one block.
    """
    placed = rows.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_at"),
    )
    return _add_numbers(placed, ["_file", "_start"], name, first)


def _add_numbers(
    rows: DataFrame,
    block: list[Column | str],
    name: str,
    first: int,
    mark: Callable[[DataFrame], DataFrame] = lambda offsets: offsets,
) -> DataFrame:
    names = [f"_block{i}" for i in range(len(block))]
    keyed = rows.select(
        "*", *[F.col(b).alias(n) if isinstance(b, str) else b.alias(n) for b, n in zip(block, names)]
    )
    sizes = keyed.groupBy(*names).agg(F.count("*").alias("_n"), F.min("_at").alias("_min"))
    before = Window.orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *[F.col(n).alias(f"{n}_") for n in names],
        "_min",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
    )
    same = F.lit(True)
    for n in names:
        same = same & (F.col(n) == F.col(f"{n}_"))
    number = (F.col("_offset") + F.col("_at") - F.col("_min") + first).alias(name)
    kept = [c for c in rows.columns if c not in ("_file", "_start", "_at")]
    return keyed.join(mark(offsets), same).select(*kept, number)


def rows_in_order(rows: DataFrame, order: list[str], first: int, last: int) -> DataFrame:
    """Rows ``first`` to ``last`` (from 1, both included) in ``order``.

    Each task keeps its first ``last`` rows and one task merges them, so what meets there is
    bounded by ``last``; for deep ranges number the rows instead.
    """
    return rows.orderBy(*order).limit(last).offset(first - 1)


def row_range(numbered: DataFrame, number: str, first: int, last: int) -> DataFrame:
    """Rows ``first`` to ``last``, both included."""
    return numbered.where(F.col(number).between(first, last)).drop(number)

"""File sinks."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession

from ..schemas import CLEAN_COLUMNS, CLEAN_PARTITIONS, require_columns


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Set a session setting for the jobs run inside the block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def write_partitioned(
    df: DataFrame,
    path: str,
    partitions: tuple[str, ...],
    *,
    mode: str = "overwrite",
    gather: bool = True,
    merge_small: bool = False,
    file_rows: int | None = None,
) -> None:
    """Write Parquet in ``name=value`` folders.

    ``overwrite`` replaces only the partitions present in ``df``, so loading a day again does
    not repeat its rows; ``append`` adds files.

    ``gather`` brings rows of a partition together through Spark's REBALANCE, which also cuts a
    partition that is too large into several tasks (a plain repartition would give a hot day
    to one). Small partitions are not merged into one task: the files stay as many, and one
    task would open them one after another. ``merge_small`` lets Spark merge them up to its advisory
    size, for folders that are few or large.

    Without ``gather`` each task writes the days it read and nothing is shuffled: right for
    input files that are already large and hold one day each.

    Without ``merge_small``, merging is off for the whole session while it writes: don't run other
    queries in it meanwhile. Days whose rows were all rejected keep their earlier partition (loads,
    in ``spendmart.loads``, empty them).
    """
    tasks = nullcontext()
    if gather:
        df = df.hint("rebalance", *partitions)
    if gather and not merge_small:
        tasks = setting(df.sparkSession, "spark.sql.adaptive.coalescePartitions.enabled", "false")
    writer = df.write.mode(mode).partitionBy(*partitions)
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if file_rows is not None:
        writer = writer.option("maxRecordsPerFile", file_rows)
    with tasks:
        writer.parquet(path)


def write_clean(
    clean: DataFrame,
    path: str,
    *,
    mode: str = "overwrite",
    gather: bool = True,
    file_rows: int | None = None,
) -> None:
    """Write one channel's clean rows by year, month and day.

    Partition sizes decide how large files get. ``file_rows`` limits the rows of a file on top.
    """
    require_columns(clean.columns, [*CLEAN_COLUMNS, *CLEAN_PARTITIONS], "clean table")
    write_partitioned(clean, path, CLEAN_PARTITIONS, mode=mode, gather=gather, file_rows=file_rows)


def write_fact(fact: DataFrame, path: str, *, mode: str = "overwrite", gather: bool = True) -> None:
    """Write fact rows by ``date_id``."""
    write_partitioned(fact, path, ("date_id",), mode=mode, gather=gather)


def write_csv(df: DataFrame, path: str, *, file_rows: int | None = None) -> None:
    """Write CSV with a header to a path that does not exist yet, never over an input.

    Values keep their blanks. Those with line breaks are quoted; read them with ``multi_line``.
    """
    writer = df.write.option("header", True).option("escape", '"').mode("errorifexists")
    if file_rows is not None:
        writer = writer.option("maxRecordsPerFile", file_rows)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)

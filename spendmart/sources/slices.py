"""A range of rows of a CSV in file order, without reading the files behind it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.numbering import number_file_rows
from .files import read_csv


def _files(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """Every file below ``path`` in file order, as the scan spells it and as a path to read."""
    listed = spark.read.format("binaryFile").load(path)
    found = listed.select(F.col("_metadata.file_path").alias("file"), "path").collect()
    return sorted((row["file"], row["path"]) for row in found)


def _row_counts(spark: SparkSession, files: list[tuple[str, str]], **options) -> list[int]:
    rows = read_csv(spark, [path for _, path in files], **options)
    counted = rows.groupBy(F.col("_metadata.file_path").alias("file")).count().collect()
    found = {row["file"]: row["count"] for row in counted}
    return [found.get(file, 0) for file, _ in files]


def overlapping_files(
    spark: SparkSession, path: str, first: int, last: int, **options
) -> tuple[list[str], int]:
    """The files that hold rows ``first`` to ``last``, and how many rows lie before them.

    Files are counted in order, twice as many in each step, until the last row wanted is passed:
    what lies far behind it is never opened.
    """
    files = _files(spark, path)
    wanted: list[str] = []
    before = seen = at = 0
    step = max(spark.sparkContext.defaultParallelism, 1)
    while at < len(files) and seen < last:
        part = files[at : at + step]
        for (_, name), n in zip(part, _row_counts(spark, part, **options)):
            if seen + n < first:
                before = seen + n
            elif n and seen < last:
                wanted.append(name)
            seen += n
        at, step = at + step, 2 * step
    return wanted, before


def file_row_range(
    spark: SparkSession, path: str, first: int, last: int, *, name: str | None = None, **options
) -> DataFrame:
    """Rows ``first`` to ``last`` (from 1, both included; headers don't count) of the CSV at ``path``.

    Files follow each other by name. Only files that overlap the range are scanned, and their rows are
    numbered by block. ``name`` adds the row's number; other options are those of ``read_csv``.
    """
    if first > last:
        raise ValueError(f"no rows from {first} to {last}")
    wanted, before = overlapping_files(spark, path, first, last, **options)
    if not wanted:
        rows = read_csv(spark, path, **options).where("false")
        return rows if name is None else rows.withColumn(name, F.lit(0).cast("bigint"))
    number = name or "_row"
    numbered = number_file_rows(read_csv(spark, wanted, **options), number, before + 1)
    kept = numbered.where(F.col(number).between(first, last))
    return kept if name else kept.drop(number)

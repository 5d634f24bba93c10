"""File sources: raw JSON lines, CSV tables, the partitioned clean table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import date_id, parse_day
from ..functions.text import DATED_FILE_GLOB, file_day
from ..operators.shape import select_once
from ..schemas import CLEAN_PARTITIONS, CLEAN_SCHEMA, FACT_SCHEMA


def read_raw_lines(spark: SparkSession, path: str, *, dated_only: bool = True) -> DataFrame:
    """``line, file_name`` for every line of the ``.txt`` files below ``path``.

    With ``dated_only`` files whose name does not end in a real day are left out, most of them
    already when files are listed; ``undated_files`` names them.
    """
    lines = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", DATED_FILE_GLOB if dated_only else "*.txt")
        .text(path)
        .select(F.col("value").alias("line"), F.col("_metadata.file_name").alias("file_name"))
    )
    if dated_only:
        lines = lines.where(parse_day(file_day(F.col("file_name"))).isNotNull())
    return lines


def undated_files(spark: SparkSession, path: str) -> DataFrame:
    """``path, file_name`` of the ``.txt`` files that ``dated_only`` leaves out; no content is read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt")
    files = listed.load(path).select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"))
    return files.where(parse_day(file_day(F.col("file_name"))).isNull())


def dated_files(files: DataFrame) -> DataFrame:
    """Rows of a file list (``file_name``, any other columns) whose name ends in a real day,
    with that ``file_day``."""
    named = select_once(files, *files.columns, file_day(F.col("file_name")).alias("file_day"))
    return named.where(parse_day(F.col("file_day")).isNotNull())


def listed_files(spark: SparkSession, path: str) -> DataFrame:
    """``path, file_name, file_day, skipped`` of every ``.txt`` file below ``path``, listed once.

    ``skipped`` says why a file's lines are not for loading: its name ends in no day (``no_day``) or
    in one that doesn't exist (``no_such_day``). It is null for the others. No content is read; the
    driver holds the list, as it does in any scan.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt")
    name = F.element_at(F.split("path", "/"), -1)
    files = listed.load(path).select("path", name.alias("file_name"), file_day(name).alias("file_day"))
    why = F.when(F.col("file_day") == "", "no_day").when(parse_day(F.col("file_day")).isNull(), "no_such_day")
    found = files.withColumn("skipped", why).orderBy("path").collect()
    return spark.createDataFrame(found, "path string, file_name string, file_day string, skipped string")


def read_listed_lines(spark: SparkSession, files: DataFrame) -> DataFrame:
    """``line, file_name`` of the files of ``listed_files`` that aren't skipped."""
    paths = [row["path"] for row in files.where(F.col("skipped").isNull()).collect()]
    if not paths:
        return spark.createDataFrame([], "line string, file_name string")
    return spark.read.text(paths).select(F.col("value").alias("line"), F.col("_metadata.file_name").alias("file_name"))


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    *,
    missing: str | None = None,
    header: bool = True,
    multi_line: bool = False,
) -> DataFrame:
    """CSV with every column as text, named by the header.

    Columns are text so that no inference pass runs and no value is reinterpreted: the country
    code ``NA`` stays ``NA``. ``missing="NA"`` restores the reading in which it is null.

    ``multi_line`` reads quoted line breaks; a file is then one task, so it is for small lookups.
    Without it a record torn by a line break is an error, never two rows.
    """
    reader = spark.read.option("header", header).option("escape", '"').option("multiLine", multi_line)
    reader = reader.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    if not multi_line:
        reader = reader.option("mode", "FAILFAST")
    if missing is not None:
        reader = reader.option("nullValue", missing)
    return reader.csv(path)


def read_clean(
    spark: SparkSession,
    path: str,
    *,
    year: int | None = None,
    month: int | None = None,
    day_partition: str = "day_of_month",
) -> DataFrame:
    """``currency, country, date_id, impressions, cost`` of one channel's clean table.

    With ``year`` (and ``month``) only the folders of that period are listed and read; a period
    that was never written is an error. ``day_partition="day"`` reads tables laid out as
    ``year=/month=/day=``. The schema is given, so no footer is merged or inferred.
    """
    if month is not None and year is None:
        raise ValueError("a month needs its year")
    partitions = [*CLEAN_PARTITIONS[:2], day_partition]
    stored = ["currency", "country", "impressions", "cost"]
    schema = T.StructType([CLEAN_SCHEMA[name] for name in stored])
    for name in partitions:
        schema = schema.add(name, T.IntegerType())
    folder = path
    if year is not None:
        folder += f"/year={year}" + (f"/month={month}" if month is not None else "")
    rows = spark.read.schema(schema).option("basePath", path).parquet(folder)
    if year is not None:
        rows = rows.where(F.col("year") == year)
    if month is not None:
        rows = rows.where(F.col("month") == month)
    return rows.select(
        "currency",
        "country",
        date_id(F.col("year"), F.col("month"), F.col(day_partition)).alias("date_id"),
        "impressions",
        "cost",
    )


def read_fact(
    spark: SparkSession, path: str, *, first_day: str | None = None, last_day: str | None = None
) -> DataFrame:
    """The fact table, ``date_id`` as text. Only folders from ``first_day`` to ``last_day`` are read."""
    rows = spark.read.schema(FACT_SCHEMA).parquet(path)
    if first_day is not None:
        rows = rows.where(F.col("date_id") >= first_day)
    if last_day is not None:
        rows = rows.where(F.col("date_id") <= last_day)
    return rows.select(*FACT_SCHEMA.names)


def project(table: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Only the named columns, cast to the given types (an integer ``date_id`` becomes text)."""
    return table.select(*[F.col(name).cast(kind).alias(name) for name, kind in columns.items()])

"""Country dimension and the geo-targets file it comes from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.geo import curate_targets, rename_targets
from ..operators.numbering import number_file_rows, number_in_order, row_range
from ..schemas import DIM_COUNTRY_COLUMNS, GEO_FIRST_ROW, GEO_LAST_ROW, require_columns
from ..sources.files import project
from ..sources.slices import file_row_range
from ..staging import exists


def country_names(table: DataFrame) -> DataFrame:
    """``country, country_name`` as text."""
    require_columns(table.columns, ["country", "country_name"], "country names")
    return table.select(
        F.col("country").cast("string").alias("country"),
        F.col("country_name").cast("string").alias("country_name"),
    )


def build_dim_country(table: DataFrame, first_id: int = 1) -> DataFrame:
    """``country_id, country, country_name`` with ids counted up in country order.

    To extend an existing dimension pass only the new countries and the next free id.
    """
    numbered = number_in_order(country_names(table), "country", "country_id", first_id)
    return numbered.select(
        F.col("country_id").cast("int").alias("country_id"), "country", "country_name"
    )


def new_countries(table: DataFrame, stored: DataFrame) -> DataFrame:
    """Countries of ``table`` that ``stored`` lacks, once each, with ids that follow the largest one.

    Stored rows are not touched, so their ids stay and what refers to them stays right. A country
    that ``table`` repeats takes its first name in order.
    """
    names = country_names(table).groupBy("country").agg(F.min("country_name").alias("country_name"))
    known = stored.select(F.col("country").alias("_known"))
    fresh = names.join(known, F.col("country").eqNullSafe(F.col("_known")), "left_anti")
    return build_dim_country(fresh, (stored.agg(F.max("country_id")).first()[0] or 0) + 1)


def grow_dim_country(table: DataFrame, path: str) -> None:
    """Add the countries of ``table`` that the dimension at ``path`` lacks; the first call makes it.

    A call that is repeated, also after it failed, finds its countries there and adds nothing.
    """
    spark = table.sparkSession
    if exists(spark, path):
        stored = spark.read.parquet(path)
    else:
        stored = spark.createDataFrame([], ", ".join(f"{c} {kind}" for c, kind in DIM_COUNTRY_COLUMNS.items()))
    new_countries(table, project(stored, DIM_COUNTRY_COLUMNS)).write.mode("append").parquet(path)


def curated_slice(
    spark: SparkSession, path: str, first: int = GEO_FIRST_ROW, last: int = GEO_LAST_ROW, *, rename: bool = False
) -> DataFrame:
    """Rows ``first`` to ``last`` of the geo-targets CSV at ``path``, filtered, and renamed if asked.

    Files behind the last row are not read.
    """
    curated = curate_targets(file_row_range(spark, path, first, last))
    return rename_targets(curated) if rename else curated


def curate_target_file(
    targets: DataFrame, first: int = GEO_FIRST_ROW, last: int = GEO_LAST_ROW
) -> DataFrame:
    """Rows ``first`` to ``last`` of the geo-targets CSV (the header is row 0), then filtered.

    ``targets`` must come straight from ``read_csv``.
    """
    numbered = number_file_rows(targets, "_row")
    return curate_targets(row_range(numbered, "_row", first, last))

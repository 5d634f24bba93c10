"""Parquet written with differing schemas, read as one table.

Spark's own schema merging adds missing columns but fails where a column's type differs between
files. Here files are grouped by the schema in their footer, every group is read with its own
schema, and its columns are cast to a common one.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Footers read at the same time, by the driver.
READERS = 16
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONS = (T.FloatType, T.DoubleType)


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type both fit without loss of kind; text where nothing else does."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, _WHOLE) and isinstance(b, _WHOLE):
        return max(a, b, key=lambda t: _WHOLE.index(type(t)))
    if isinstance(a, (*_WHOLE, *_FRACTIONS)) and isinstance(b, (*_WHOLE, *_FRACTIONS)):
        return T.DoubleType()
    if isinstance(a, (T.DateType, T.TimestampType)) and isinstance(b, (T.DateType, T.TimestampType)):
        return T.TimestampType()
    return T.StringType()


def merged_schema(schemas: list[T.StructType]) -> T.StructType:
    """All columns of ``schemas`` in order of first appearance, each in a type that fits all."""
    found: dict[str, T.DataType] = {}
    for field in (f for schema in schemas for f in schema):
        found[field.name] = common_type(found[field.name], field.dataType) if field.name in found else field.dataType
    return T.StructType([T.StructField(name, kind) for name, kind in found.items()])


def aligned(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """``rows`` in the columns and types of ``schema``; a column it lacks is null.

    Casts are checked: a value that doesn't fit is an error, never a wrong number.
    """
    return rows.select(
        *((F.col(f"`{f.name}`") if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema)
    )


def files_by_schema(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Files below ``path`` by the schema in their footer (as JSON). Rows aren't read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    paths = sorted(row["path"] for row in listed.load(path).select("path").collect())
    with ThreadPoolExecutor(READERS) as pool:
        schemas = list(pool.map(lambda p: spark.read.parquet(p).schema.json(), paths))
    groups: dict[str, list[str]] = {}
    for schema, p in zip(schemas, paths):
        groups.setdefault(schema, []).append(p)
    return groups


def read_merged(
    spark: SparkSession,
    path: str,
    *,
    partitions: T.StructType | None = None,
    schema: T.StructType | None = None,
    base: str | None = None,
) -> DataFrame:
    """All Parquet below ``path`` as one table, whatever schemas its files have.

    ``partitions`` are columns named by folders below ``base`` (``path`` unless given). With
    ``schema`` the result has its columns and types, else the merged ones. The driver reads one
    footer per file; name a period's folder as ``path`` to read few.
    """
    partitions = partitions or T.StructType([])
    groups = files_by_schema(spark, path)
    own = {text: T.StructType.fromJson(json.loads(text)) for text in groups}
    if schema is None:
        schema = T.StructType([*merged_schema(list(own.values())), *partitions])
    if not groups:
        return spark.createDataFrame([], schema)
    parts = []
    for text, paths in sorted(groups.items()):
        stored = T.StructType([f for f in own[text] if f.name not in partitions.names])
        read = spark.read.schema(T.StructType([*stored, *partitions])).option("basePath", base or path)
        parts.append(aligned(read.parquet(*paths), schema))
    return reduce(DataFrame.unionByName, parts)

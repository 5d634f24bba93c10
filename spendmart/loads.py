"""Tables kept as loads: what a load saw replaces what was there, also where it left nothing.

A load writes its rows to a folder of its own, then a small manifest: which keys (days, say) it saw
and how many rows of each it wrote. The manifest is the commit. A reader takes every key from the
last load that saw it, so

* a day whose rows were all rejected on a rerun is empty, in the same commit that replaced the others;
* a reload of one channel leaves the other channel's rows alone;
* a load that died half-way is never seen, and its rerun repeats nothing;
* counts come from the rows that were committed, so task retries can't inflate them.

Keys needn't be folders: a table by month is replaced by day all the same. Readers name the folders
they want, so neither the tree nor other periods' folders are listed.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import require_columns
from .sinks.files import write_partitioned
from .sources.merged import aligned
from .staging import remove

ROWS, MANIFESTS = "rows", "loads"
#: The folder name of a null.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
#: Folder values that need no escaping.
PLAIN_VALUE = r"^[A-Za-z0-9_-]+\z"


@dataclass(frozen=True)
class Layout:
    """``schema``: all columns. ``folders``: the columns that name folders, outermost first.
    ``keys``: the columns whose values a load replaces as a whole.
    """

    schema: T.StructType
    folders: tuple[str, ...]
    keys: tuple[str, ...]

    @property
    def named(self) -> tuple[str, ...]:
        """Columns of the manifest that place rows: folders, then the other keys."""
        return (*self.folders, *(k for k in self.keys if k not in self.folders))

    @property
    def manifest_schema(self) -> T.StructType:
        fields = [T.StructField("load", T.StringType()), T.StructField("stored", T.StringType())]
        fields += [T.StructField(c, self.schema[c].dataType) for c in self.named]
        return T.StructType([*fields, T.StructField("n", T.LongType())])


def new_load() -> str:
    """A name that sorts after those of earlier loads."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def _plain(value: Column) -> Column:
    """The value, or an error if its folder's name would need escaping."""
    text = value.cast("string")
    wrong = F.raise_error(F.concat(F.lit("no name for a folder: "), text))
    return F.when(text.isNull() | text.rlike(PLAIN_VALUE), value).otherwise(wrong)


def write_load(
    rows: DataFrame,
    path: str,
    layout: Layout,
    *,
    seen: DataFrame | None = None,
    gather: bool = True,
    file_rows: int | None = None,
) -> str:
    """Write ``rows`` as one load and commit it; the load's name.

    Every key of ``rows`` is replaced, and so is every key of ``seen`` (the key columns): keys that
    were looked at and have no rows any more.
    """
    spark = rows.sparkSession
    require_columns(rows.columns, [*layout.folders, *layout.keys], "load")
    load = new_load()
    folder = f"{path}/{ROWS}/load={load}"
    write_partitioned(
        rows, folder, layout.folders, mode="errorifexists", gather=gather, merge_small=True, file_rows=file_rows
    )
    stored = T.StructType([f for f in rows.schema if f.name not in layout.folders])
    partitions = [layout.schema[c] for c in layout.folders]
    written = spark.read.schema(T.StructType([*stored, *partitions])).parquet(folder)
    # only the named columns are read back, folder columns from the paths
    counts = written.groupBy(*layout.named).agg(F.count("*").alias("n"))
    if seen is not None:
        emptied = seen.select(*layout.keys).distinct()
        empty = {c: F.lit(None) for c in layout.named if c not in layout.keys}
        counts = counts.unionByName(emptied.withColumns({**empty, "n": F.lit(0).cast("bigint")}))
    named = [_plain(F.col(c)).cast(layout.schema[c].dataType).alias(c) for c in layout.named]
    about = counts.select(F.lit(stored.json()).alias("stored"), *named, "n")
    about.coalesce(1).write.parquet(f"{path}/{MANIFESTS}/load={load}")
    return load


def manifest(spark: SparkSession, path: str, layout: Layout) -> DataFrame:
    """What each load saw, by folder and key, with ``live``: whether it still counts."""
    found = spark.read.schema(layout.manifest_schema).parquet(f"{path}/{MANIFESTS}")
    last = F.max("load").over(Window.partitionBy(*layout.keys))
    return found.withColumn("live", F.col("load") == last)


def load_counts(spark: SparkSession, path: str, layout: Layout, by: list[str], load: str | None = None) -> DataFrame:
    """Rows by columns of the manifest, from manifests alone: of one load, or of the whole table."""
    about = manifest(spark, path, layout)
    about = about.where(F.col("load") == load) if load else about.where("live")
    return about.where("n > 0").groupBy(*by).agg(F.sum("n").alias("n"))


def seen_keys(spark: SparkSession, path: str, layout: Layout, wanted: Column | None = None) -> DataFrame:
    """Every key that some load has seen, also those without rows."""
    about = manifest(spark, path, layout)
    return (about if wanted is None else about.where(wanted)).select(*layout.keys).distinct()


def _folder(row: T.Row, layout: Layout) -> str:
    parts = [f"load={row['load']}"]
    parts += [f"{c}={NO_VALUE if row[c] is None else row[c]}" for c in layout.folders]
    return "/".join(parts)


def read_loads(spark: SparkSession, path: str, layout: Layout, wanted: Column | None = None) -> DataFrame:
    """The rows that count, in the layout's columns.

    ``wanted`` is a condition on folder and key columns. Folders of which all keys count are read as
    they are; in others, rows are kept by a broadcast of the keys that count, one row per key, load
    and folder. Loads written with another schema are aligned to the layout's.
    """
    about = manifest(spark, path, layout)
    if wanted is not None:
        about = about.where(wanted)
    about = about.where("n > 0")
    folders = about.groupBy("load", "stored", *layout.folders).agg(F.bool_and("live").alias("whole"), F.bool_or("live").alias("any"))
    groups: dict[tuple[str, bool], list[str]] = {}
    for row in folders.where("any").collect():  # as many rows as folders to read
        groups.setdefault((row["stored"], row["whole"]), []).append(f"{path}/{ROWS}/{_folder(row, layout)}")
    parts = []
    for (stored, whole), paths in sorted(groups.items()):
        schema = T.StructType.fromJson(json.loads(stored))
        for c in ("load", *layout.folders):
            schema = schema.add(c, T.StringType() if c == "load" else layout.schema[c].dataType)
        rows = spark.read.schema(schema).option("basePath", f"{path}/{ROWS}").parquet(*sorted(paths))
        if not whole:
            keys = about.where("live").select("load", *layout.named)
            same = [rows[c].eqNullSafe(keys[c]) for c in ("load", *layout.named)]
            rows = rows.join(F.broadcast(keys), same, "left_semi")
        if wanted is not None:
            rows = rows.where(wanted)
        parts.append(aligned(rows, layout.schema))
    if not parts:
        return spark.createDataFrame([], layout.schema)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def remove_superseded(spark: SparkSession, path: str, layout: Layout) -> int:
    """Delete the folders of loads none of whose rows count any more; how many.

    Readers that planned before may still want them: leave time between a load and this.
    """
    about = manifest(spark, path, layout).groupBy("load").agg(F.bool_or(F.col("live") & (F.col("n") > 0)).alias("needed"))
    gone = [row["load"] for row in about.where("not needed").collect()]
    for load in gone:
        remove(spark, f"{path}/{ROWS}/load={load}")
    return len(gone)

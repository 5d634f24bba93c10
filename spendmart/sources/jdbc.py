"""JDBC tables: lookup tables in, fact and country rows out."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..schemas import JDBC_BATCH_ROWS
from .files import project

# Fixed value: driver class of the MySQL connector.
DRIVER = "com.mysql.jdbc.Driver"


@dataclass(frozen=True)
class Database:
    """Connection settings. Credentials come from the caller and are kept out of ``repr``."""

    host: str
    database: str
    port: int = 3306
    user: str = field(default="", repr=False)
    password: str = field(default="", repr=False)
    driver: str = DRIVER
    scheme: str = "jdbc:mysql"

    @property
    def url(self) -> str:
        return f"{self.scheme}://{self.host}:{self.port}/{self.database}"

    def options(self, table: str) -> dict[str, str]:
        return {
            "driver": self.driver,
            "url": self.url,
            "dbtable": table,
            "user": self.user,
            "password": self.password,
        }


def read_options(
    db: Database,
    table: str,
    *,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int = 1,
) -> dict[str, str]:
    """Options of a table scan; with a partition column the scan runs as parallel ranges."""
    options = db.options(table)
    if partition_column is not None:
        if bounds is None or partitions < 2:
            raise ValueError("a partitioned read needs bounds and at least two partitions")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def write_options(
    db: Database, table: str, *, batch_rows: int = JDBC_BATCH_ROWS, connections: int | None = None
) -> dict[str, str]:
    """Options of an append; ``connections`` caps how many tasks write at the same time."""
    options = db.options(table) | {"batchsize": str(batch_rows), "quoteIdentifiers": "true"}
    if connections is not None:
        options["numPartitions"] = str(connections)
    return options


def read_table(
    spark: SparkSession, db: Database, table: str, columns: dict[str, str], **ranges
) -> DataFrame:
    """The named columns of a table. The projection is pushed into the SQL that Spark sends.

    ``ranges`` are the partitioning arguments of ``read_options``.
    """
    options = read_options(db, table, **ranges)
    return project(spark.read.format("jdbc").options(**options).load(), columns)


def append_table(df: DataFrame, db: Database, table: str, connections: int | None = None) -> None:
    """Append rows. A task lost after its commit is run again and repeats its rows: append to a
    staging table and merge in the database where that matters."""
    options = write_options(db, table, connections=connections)
    df.write.format("jdbc").options(**options).mode("append").save()

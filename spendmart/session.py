"""Session settings the pipelines rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Splits hot shuffle partitions, sizes the rest, and carries out REBALANCE before writes.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
}


def get_session(app: str, **overrides: str) -> SparkSession:
    """A session with these settings, or the running one as it is."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app)
    for key, value in (SETTINGS | overrides).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

"""Prepares a session for these operators: code for the executors, batches fit for whole texts."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SENT: set[str] = set()
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Spark's own setting, meant for short rows, and the one for whole texts in small workers.
DEFAULT_ROWS, TEXT_ROWS = "10000", "1000"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Spark's own limit, and one that keeps batches of very long texts or sets small. A row isn't split.
DEFAULT_BYTES, TEXT_BYTES = str(64 << 20), str(4 << 20)


def ship(spark: SparkSession) -> None:
    """Once per application, add the package to what Spark hands to Python workers; and unless the
    session has batch sizes of its own, take ones that suit texts.

    The archive lies in the driver's own temporary folder and reaches executors over Spark's file
    service, as with ``--py-files``.
    """
    if spark.conf.get(BATCH_ROWS, DEFAULT_ROWS) == DEFAULT_ROWS:
        spark.conf.set(BATCH_ROWS, TEXT_ROWS)
    if spark.conf.get(BATCH_BYTES, DEFAULT_BYTES) == DEFAULT_BYTES:
        spark.conf.set(BATCH_BYTES, TEXT_BYTES)
    app = spark.sparkContext.applicationId
    if app in _SENT:
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="spendmart-code-")) / "spendmart_code.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, str(path.relative_to(root.parent)))
    spark.sparkContext.addPyFile(str(archive))
    _SENT.add(app)

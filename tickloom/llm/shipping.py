"""Prepares a session: this package on the executors' path, and Arrow batches bounded in bytes."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

#: Bytes of an Arrow batch between the JVM and Python. Both sides hold several, and texts are long.
BATCH_BYTES = 8 << 20

_SHIPPED: set[str] = set()


def ship(spark: SparkSession, batch_bytes: int = BATCH_BYTES) -> None:
    """Send the package's sources to all executors, once for each application, and bound this session's batches."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(batch_bytes))
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="run-"), f"{os.path.basename(package)}.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    file = os.path.join(folder, name)
                    archive.write(file, os.path.relpath(file, os.path.dirname(package)))
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)

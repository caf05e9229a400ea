"""Give Python workers this package, as ``spark-submit --py-files`` would."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()
# Bytes of a batch of rows sent to a worker, which holds it whole, as the task does, in and out.
BATCH_BYTES = 4 << 20
BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Bound batches sent to workers by bytes, unless the session says how.

    By default they are bounded by rows, and texts may be of any length.
    """
    if spark.conf.get(BATCH_LIMIT, None) is None:
        spark.conf.set(BATCH_LIMIT, BATCH_BYTES)


def ship_package(spark: SparkSession) -> None:
    """Send the library's modules to the workers of a session, once.

    Workers of a session that was started elsewhere may not have the library on their path.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    made = os.path.join(tempfile.mkdtemp(), f"{package.name}.zip")
    with zipfile.ZipFile(made, "w") as archive:
        for path in sorted(package.rglob("*.py")):
            archive.write(path, path.relative_to(package.parent))
    context.addPyFile(made)
    _SHIPPED.add(context.applicationId)

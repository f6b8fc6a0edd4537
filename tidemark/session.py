"""Session settings and shipping of the package to Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

#: Settings for local runs and tests; a cluster brings its own.
LOCAL = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.shuffle.partitions": "8",
    "spark.ui.enabled": "false",
}

#: Arrow batches for Python workers are bounded by bytes: texts of a batch differ in length by orders.
BATCH_BYTES = 4 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"

_SHIPPED: set[str] = set()


def local_session(cores: str = "*", **conf: str) -> SparkSession:
    """A local session with the settings of LOCAL and of ``conf`` (dots as ``__``)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("tidemark")
    for key, value in (LOCAL | {k.replace("__", "."): v for k, v in conf.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each application, and bound their Arrow batches."""
    if spark.conf.get(_BATCH_CONF, "64m") in ("64m", "64MB", "67108864", "67108864b"):  # nobody chose it
        spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    target = os.path.join(tempfile.mkdtemp(prefix="tidemark-"), "tidemark.zip")
    with zipfile.ZipFile(target, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)

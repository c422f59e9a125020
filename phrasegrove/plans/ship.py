"""Making this package importable in the executors' Python workers."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Add the package's archive to the session's Python files, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="phrasegrove-ship-")) / package.name
    archive = shutil.make_archive(str(target), "zip", package.parent, package.name)
    context.addPyFile(archive)
    _shipped.add(context.applicationId)

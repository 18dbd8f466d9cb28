"""Sending this library to the executors, whose Python workers import it."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_ROOT = Path(__file__).resolve().parents[1]
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add the library's sources to the application's Python files, once per application."""
    application = spark.sparkContext.applicationId
    if application in _SHIPPED:
        return
    archive = Path(tempfile.mkdtemp(prefix="shelfline-")) / "shelfline.zip"  # read by the driver alone, which serves it to executors
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted((_ROOT / "shelfline").rglob("*.py")):
            out.write(path, path.relative_to(_ROOT))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(application)

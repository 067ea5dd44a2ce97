"""Sends this package to the Python workers of a session, wherever they run and whatever their path is."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Adds the package to the session's Python files, once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="spatialfeat-")) / "spatialfeat.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(top.rglob("*.py")):
            out.write(file, file.relative_to(top.parent))
    spark.sparkContext.addPyFile(str(path))
    _shipped.add(app)

"""Makes this package importable in the Python workers of a cluster."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once per Spark application."""
    context = spark.sparkContext
    if getattr(context, "_sessionflow_shipped", False):
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp()) / "sessionflow.zip"  # Spark serves it from the driver
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._sessionflow_shipped = True

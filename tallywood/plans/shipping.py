"""The package on the executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def shipped(spark: SparkSession) -> None:
    """Send this package to the executors, once a session.

    Their Python workers import it by name; where it is installed on every machine
    this changes nothing.
    """
    context = spark.sparkContext
    if getattr(context, "_package_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    # Spark serves the file from the driver and keeps it as long as the session lives.
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._package_shipped = True

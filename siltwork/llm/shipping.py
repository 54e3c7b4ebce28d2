"""Send this package to the executors, for sessions that were not started with it."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parent.parent

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add the package to the application once, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    archive = Path(tempfile.mkdtemp(prefix="siltwork-")) / f"{PACKAGE.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(PACKAGE.rglob("*.py")):
            out.write(file, file.relative_to(PACKAGE.parent))
    context.addPyFile(str(archive))
    _sent.add(context.applicationId)

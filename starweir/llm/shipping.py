"""This package for the Python workers of a session that was started without it."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import starweir

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the workers the package, as ``--py-files`` would, once a session."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    source = Path(starweir.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="starweir-")) / "starweir.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(source.rglob("*.py")):
            out.write(file, file.relative_to(source.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)

"""Gives executors this package where it isn't installed on them."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_NAME = "turnweave_package.zip"


def ship(spark: SparkSession) -> None:
    """Adds a zip of the package to the session's Python files, once."""
    sc = spark.sparkContext
    if any(f.endswith(_NAME) for f in getattr(sc, "_python_includes", [])):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="turnweave-"), _NAME)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("turnweave", os.path.relpath(full, root)))
    sc.addPyFile(path)

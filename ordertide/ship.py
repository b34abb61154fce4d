"""Make this package importable by Python workers (what ``--py-files`` does)."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add a zip of the package to the SparkContext, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    root_dir = os.path.dirname(package)
    archive = os.path.join(tempfile.mkdtemp(prefix="ordertide-pyfiles-"), "ordertide.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for root, _, files in os.walk(package):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, root_dir))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)

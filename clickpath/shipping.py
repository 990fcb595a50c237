"""Ship this package to the Python workers of a cluster."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

PACKAGE_DIR = os.path.dirname(os.path.abspath(__file__))


def package_zip(folder: str) -> str:
    """Zip the package's modules into ``folder`` and return the archive's path."""
    path = os.path.join(folder, "clickpath.zip")
    root = os.path.dirname(PACKAGE_DIR)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for top, dirs, names in os.walk(PACKAGE_DIR):
            dirs[:] = sorted(d for d in dirs if d != "__pycache__")
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(top, name)
                    z.write(full, os.path.relpath(full, root))
    return path


def ship_package(spark: SparkSession) -> None:
    """Make the package importable on every executor (once per Spark context).

    Functions that run in Python workers are pickled by reference, so a worker must be able
    to import the package even where the driver found it by its own ``sys.path`` only.
    """
    sc = spark.sparkContext
    if not getattr(sc, "_clickpath_shipped", False):
        sc.addPyFile(package_zip(tempfile.mkdtemp(prefix="clickpath-ship-")))
        sc._clickpath_shipped = True

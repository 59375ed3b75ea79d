"""This package's code for executors whose Python can't import it by itself."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the session's executors, once for each application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="vellumgrid-")
    to = os.path.join(folder, "vellumgrid.zip")
    with zipfile.ZipFile(to, "w") as z:
        for at, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(at, name)
                    z.write(full, os.path.join("vellumgrid", os.path.relpath(full, top)))
    sc.addPyFile(to)
    _shipped.add(sc.applicationId)
    atexit.register(shutil.rmtree, folder, ignore_errors=True)

"""Sends this package to the Python workers, which need not share the driver's import path."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add the package to the job's Python files, once per application. Spark itself hands
    them to every executor, so the driver's temporary file need not be reachable from there."""
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    target = os.path.join(tempfile.mkdtemp(prefix="tickflow-package-"), "tickflow_package.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(_PACKAGE):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(_PACKAGE)))
    context.addPyFile(target)
    _sent.add(context.applicationId)

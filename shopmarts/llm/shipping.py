"""The library's code on the executors, whatever folder or path the driver was started with."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def shipped(spark: SparkSession) -> SparkSession:
    """Send the package to all Python workers of the application, once."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        root = os.path.dirname(package)
        archive = os.path.join(tempfile.mkdtemp(prefix="shopmarts-code-"), "shopmarts.zip")
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
            for folder, _, names in sorted(os.walk(package)):
                for name in sorted(names):
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        out.write(path, os.path.relpath(path, root))
        context.addPyFile(archive)
        _SHIPPED.add(context.applicationId)
    return spark

"""Makes this package importable on the executors of a session."""

from __future__ import annotations

import os
import tempfile
import zipfile
from functools import wraps

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends the package's sources to the executors, once for each application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    _SHIPPED.add(context.applicationId)
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="veinloom-"), "veinloom.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("veinloom", os.path.relpath(full, root)))
    context.addPyFile(path)


def shipped(query):
    @wraps(query)
    def run(spark, *args):
        ship(spark)
        return query(spark, *args)

    return run

"""The package's code for Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import dimspark


def ship(spark: SparkSession) -> None:
    """Let Spark send this package to the executors, once a session. Python
    workers then import it wherever they run, whatever their PYTHONPATH."""
    sc = spark.sparkContext
    if getattr(sc, "_dimspark_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(dimspark.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="dimspark-code-"), "dimspark_code.zip")  # served by the driver
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    sc._dimspark_shipped = True

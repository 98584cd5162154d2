"""Shipping the library to executors that do not have it installed."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import promptloom

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors' Python path, once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(promptloom.__file__)))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, names, files in os.walk(os.path.join(root, "promptloom")):
            names[:] = [n for n in names if n != "__pycache__"]
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, root))
    # Spark copies the archive to its own file server, from which executors fetch it.
    path = os.path.join(tempfile.mkdtemp(prefix="promptloom-"), "promptloom.zip")
    with open(path, "wb") as out:
        out.write(packed.getvalue())
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)

"""Makes this package importable where tasks run.

The tasks' functions are pickled by name.  ``ship`` gives Spark the package's
sources as a zip file, which it hands to every executor; where the package is
installed there anyway, this changes nothing.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    path = os.path.join(tempfile.mkdtemp(prefix="fragstat-sources-"), "fragstat-sources.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(_PACKAGE):
            for name in sorted(names):
                if name.endswith(".py"):
                    file = os.path.join(folder, name)
                    archive.write(file, os.path.relpath(file, os.path.dirname(_PACKAGE)))
    context.addPyFile(path)
    _shipped.add(context.applicationId)

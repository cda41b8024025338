"""Makes the package importable in the executors' Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_DONE: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package's source to the executors of the session, once for each application."""
    sc = spark.sparkContext
    if sc.applicationId in _DONE:
        return
    root = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="addrloom-src-")) / f"{root.name}_src.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, os.path.join(root.name, p.relative_to(root)))
    sc.addPyFile(str(path))
    _DONE.add(sc.applicationId)

"""Make the package importable in Python workers, wherever the driver found it."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application (a small zip through Spark's file server)."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    with tempfile.TemporaryDirectory() as tmp:
        copy = Path(tmp, "tree", root.name)
        shutil.copytree(root, copy, ignore=shutil.ignore_patterns("__pycache__"))
        made = shutil.make_archive(str(Path(tmp, root.name)), "zip", copy.parent, root.name)
        kept = Path(tempfile.mkdtemp(prefix="ship-"), Path(made).name)
        shutil.copy(made, kept)
    spark.sparkContext.addPyFile(str(kept))
    _SHIPPED.add(app)

"""Intermediate tables in the folder that driver and executors share (``spark.checkpoint.dir``)."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable
from contextvars import ContextVar
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

_MADE: dict[str, SparkSession] = {}
_TABLES: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
#: Folders made since the innermost ``settled`` of this thread began.
_STEP: ContextVar[list[str] | None] = ContextVar("step", default=None)


def scratch(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, removed when the driver ends. A setting without a scheme is a path in the
    cluster's default file system.

    Only a local master may do without that setting (single-machine tests): a temporary folder takes its place there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"file://{tempfile.gettempdir()}/tidewell-checkpoints"
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/tidewell-{uuid.uuid4().hex}")
    path = where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where).toString()
    if not _MADE:
        atexit.register(_clean)
    _MADE[path] = spark
    if (step := _STEP.get()) is not None:
        step.append(path)
    return path


def remove(path: str) -> None:
    spark = _MADE.pop(path, None)
    if spark is None:
        return
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def _clean() -> None:
    for path in list(_MADE):
        try:
            remove(path)
        except Exception:  # noqa: BLE001  the session may be gone already; the folder is only scratch
            pass


def written(df: DataFrame, name: str = "step") -> DataFrame:
    """``df`` as a Parquet table in the shared folder: lineage ends there, and it outlives a lost executor."""
    folder = scratch(df.sparkSession)
    df.write.parquet(f"{folder}/{name}")
    out = df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")
    _TABLES[out] = folder
    return out


def settled(make: Callable[[], DataFrame], name: str = "step") -> DataFrame:
    """``written(make())``, and the tables that making it left behind are removed: nothing of the result needs them. Tables
    of other threads, and those made before, stay."""
    token = _STEP.set(own := [])
    try:
        out = written(make(), name)
    finally:
        _STEP.reset(token)
    for path in own:
        if path != _TABLES[out] and path in _MADE:
            remove(path)
    if (outer := _STEP.get()) is not None:
        outer.append(_TABLES[out])
    return out


def discard(df: DataFrame) -> None:
    """Remove a table that ``written`` made once nothing reads it any more."""
    folder = _TABLES.pop(df, None)
    if folder in _MADE:
        remove(folder)

"""A folder for files that one query writes and reads again."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import SparkSession

from loomwork.core.artifacts import remove

_own: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, which driver and executors share.

    On a local master, where they are one process, a temporary folder that goes
    with the process stands in if the session names none; on a cluster that is
    an error.
    """
    global _own
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    if _own is None:
        _own = tempfile.mkdtemp(prefix="loomwork-")
        atexit.register(shutil.rmtree, _own, ignore_errors=True)
    return f"file://{_own}"


def fresh_folder(spark: SparkSession, name: str) -> str:
    """An empty place under the shared folder, the same for each run of ``name`` in an application, so that reruns leave nothing more."""
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}-{name}"
    remove(spark, path)
    return path

"""Staged tables: cut a plan by writing it to the cluster's shared folder.

A written table survives the loss of executors, is read by several consumers without
being computed (or fetched from a changing source) again, and has a known size, which
is what the broadcast decisions of later joins go by.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .storage import delete_dir

__all__ = ["Staged", "shared_folder", "shuffles_freed", "stage"]

_SETTING = "spark.checkpoint.dir"
_local: dict[str, str] = {}
_FREES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_freeing: dict[str, int] = {}  # jobs that free shuffles, by session
_lock = threading.Lock()


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What is run inside deletes its shuffle files when it ends; else they lie on the disks until the driver collects its garbage.

    For frames that are run once: one that is run again writes its shuffles again.
    """
    session = spark._jsparkSession.sessionUUID()
    with _lock:
        _freeing[session] = _freeing.get(session, 0) + 1
        if _freeing[session] == 1:
            spark.conf.set(_FREES, "true")
    try:
        yield
    finally:
        with _lock:
            _freeing[session] -= 1
            if not _freeing[session]:
                spark.conf.unset(_FREES)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a scratch folder, gone with the process, where it is unset (local tests)."""
    named = spark.conf.get(_SETTING, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder all executors share")
    if "dir" not in _local:
        _local["dir"] = tempfile.mkdtemp(prefix="tablesync-")
        atexit.register(shutil.rmtree, _local["dir"], ignore_errors=True)
    return _local["dir"]


@dataclass
class Staged:
    """A written intermediate table and its row count."""

    spark: SparkSession = field(repr=False)
    path: str
    rows: int

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def release(self) -> None:
        delete_dir(self.spark, self.path)


def stage(df: DataFrame, label: str) -> Staged:
    """Write a frame to the shared folder; rows are counted while writing."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/staged/{label}-{uuid.uuid4().hex}"
    seen = Observation()
    with shuffles_freed(spark):
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    return Staged(spark, path, seen.get["rows"])

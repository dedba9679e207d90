"""The session's shared folder and its Arrow batches."""

from __future__ import annotations

import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a temporary one only for a local master that names none."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not (spark.conf.get("spark.master", "") or "").startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if "dir" not in _LOCAL:
        _LOCAL["dir"] = "file://" + tempfile.mkdtemp(prefix="taxograph-")
    return _LOCAL["dir"]


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A setting of the session for the actions inside."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def arrow_rows(spark: SparkSession, rows: int):
    """At most so many rows in an Arrow batch for the actions inside, so that wide rows do not fill a Python worker."""
    return setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def split_bytes(spark: SparkSession, megabytes: int):
    """Tasks read about so much of files in the actions inside; packed triples are many rows in few bytes."""
    return setting(spark, "spark.sql.files.maxPartitionBytes", f"{megabytes}m")

"""Helpers shared by the corpus operators: shared folder, staged tables, packed arrays."""

from __future__ import annotations

import atexit
import ctypes
import tempfile
import uuid
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LOCAL: dict[str, str] = {}
#: Writers and readers hold a row group in memory; packed rows are large.
ROW_GROUP_BYTES = 16 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it in spark.checkpoint.dir.

    Only a local master may leave it unset (tests); a temporary folder is used then.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not (spark.conf.get("spark.master", "") or "").startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if "dir" not in _LOCAL:
        _LOCAL["dir"] = "file://" + tempfile.mkdtemp(prefix="taxograph-")
    return _LOCAL["dir"]


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, removed when the application ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def remove() -> None:
        try:
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(conf).delete(where, True)
        except Exception:  # noqa: BLE001  the session has ended already
            pass

    atexit.register(remove)
    return path


def staged(df: DataFrame, name: str, tasks: int | None = None) -> DataFrame:
    """df written to the shared folder and read back: cuts lineage, survives lost executors.

    tasks: at most so many write it, for results that are small next to what they are made from. The
    rows are counted while they are written, see rows_in().
    """
    spark, seen = df.sparkSession, Observation()
    path = new_path(spark, name)
    counted = (df if tasks is None else df.coalesce(tasks)).observe(seen, F.count(F.lit(1)).alias("n"))
    counted.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.rows_written = seen.get["n"]
    return out


def rows_in(df: DataFrame) -> int:
    """The rows of a staged table, known from its writing, or else counted."""
    known = df.__dict__.get("rows_written")
    return df.count() if known is None else known


def small_batches(spark: SparkSession, rows: int = 1024) -> None:
    """Keep Arrow batches of whole texts small; long texts would fill a Python worker otherwise.

    The session's setting is only ever lowered, since frames run after they are built: what is built
    later cannot give an earlier one larger batches.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def tidy(run):
    """run, a function over batches, that gives memory back to the machine when its task ends.

    Spark keeps Python workers for later tasks; what they have freed would stay with them otherwise.
    """

    def done(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            getattr(ctypes.CDLL(None), "malloc_trim", int)(0)  # glibc alone has it

    return done


def whole_id(df: DataFrame, id_col: str) -> Column:
    """The id as bigint; ids that are no whole numbers are refused rather than turned into null."""
    kind = df.schema[id_col].dataType
    if not isinstance(kind, T.IntegralType):
        raise TypeError(f"{id_col} is {kind.simpleString()}; whole numbers are needed")
    return F.col(id_col).cast("long")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def tasks_for(rows: int, each: int = 1_000_000) -> int:
    """Tasks that write so many rows, when a task takes `each`."""
    return -(-rows // each) or 1


def pack(a: np.ndarray, level: int = 1) -> bytes:
    return zstandard.ZstdCompressor(level=level).compress(np.ascontiguousarray(a).tobytes())


def unpack(b: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), dtype=dtype)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """At most so many rows in an Arrow batch for the actions inside; for rows of several MB."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def planes(a: np.ndarray) -> bytes:
    """pack() by byte planes, which zstandard shrinks better for small integers."""
    return pack(np.ascontiguousarray(a).view("u1").reshape(len(a), -1).T)


def unplanes(b: bytes, dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(unpack(b, "u1").reshape(width, -1).T).view(dtype).ravel()


#: Tables of ids of at most this many rows (16 to 32 bytes each) are broadcast; larger ones are joined by a shuffle.
BROADCAST_IDS = 200_000


def by_ids(df: DataFrame, ids: DataFrame, on: str | list[str], how: str, before_shuffle=None) -> DataFrame:
    """df joined with a staged table of distinct ids (semi, anti, or left with what they bring).

    While the ids are few, df's texts are spared the shuffle. before_shuffle turns df's rows into what
    is carried: after the join if ids are broadcast, before it if rows move. A key that holds many of
    df's rows is split by adaptive execution, the ids' side has one row for it.
    """
    carried = before_shuffle or (lambda rows: rows)
    if rows_in(ids) <= BROADCAST_IDS:
        return carried(df.join(F.broadcast(ids), on, how))
    return carried(df).join(ids, on, how)

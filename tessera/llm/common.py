"""Shared helpers: the shared folder, written intermediate tables, Arrow text access."""

from __future__ import annotations

import ctypes
import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: White space that separates words: blank, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"


#: Bytes of a row group of a written table, which a task gathers in memory.
ROW_GROUP_BYTES = 16 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    ``spark.checkpoint.dir`` where the session names it; in local mode, as in
    tests, otherwise a temporary folder of the application. A cluster must name one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return _local_folder(spark.sparkContext.applicationId)


@functools.cache
def _local_folder(application: str) -> str:
    return "file://" + tempfile.mkdtemp(prefix="tessera-shared-")


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/tessera/{spark.sparkContext.applicationId}"


#: The part of an application that intermediate tables are written for, by application.
_part: dict[str, str] = {}


@contextmanager
def part_of_run(spark: SparkSession, name: str) -> Iterator[None]:
    """Tables written within belong to this part, and ``drop_written`` can delete them apart from others."""
    application = spark.sparkContext.applicationId
    before = _part.get(application, "")
    _part[application] = f"{name}/"
    try:
        yield
    finally:
        _part[application] = before


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{_own_folder(spark)}/{_part.get(spark.sparkContext.applicationId, '')}{name}-{uuid.uuid4().hex}"


def drop_written(spark: SparkSession, part: str = "") -> None:
    """Delete the intermediate tables of this application, or of one part; results still unread must be written first."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{_own_folder(spark)}/{part}".rstrip("/"))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written to the shared folder and read again.

    Cuts lineage so that a lost executor costs a re-read and not a re-run,
    and lets several consumers share one computation.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes (uint8) and offsets (int64, from 0) of a string or binary array; nulls are empty."""
    kind = column.type
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(kind) or pa.types.is_large_binary(kind) else "")
    wide = pa.types.is_large_string(kind) or pa.types.is_large_binary(kind)
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


#: Bytes of an Arrow batch that goes to a Python worker; ten thousand long texts would not fit in memory.
BATCH_BYTES = 2 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes in this session, unless it sets a bound itself."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(BATCH_BYTES))


def release() -> None:
    """Give freed memory back to the system: idle workers live on beside the next stage's."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def mapped(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with byte-bounded batches, whose workers give their memory back at the end of a task."""
    bounded_batches(df.sparkSession)

    def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return df.mapInArrow(released, schema)

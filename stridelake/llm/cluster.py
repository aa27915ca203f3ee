"""Helpers that keep jobs restartable and Python batches bounded."""

from __future__ import annotations

import ctypes
import gc
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

SLICE_BYTES = 4 << 20


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a folder of its own where that is unset, which only a local master may do without."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="spark-", dir="/tmp")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def trim() -> None:
    """Give memory that a Python worker has freed back to the machine; workers outlive the stages that filled them."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


def trimmed(function: Callable) -> Callable:
    """function, after which its worker gives freed memory back."""

    def one(table: pa.Table) -> pa.Table:
        out = function(table)
        trim()
        return out

    def two(left: pa.Table, right: pa.Table) -> pa.Table:
        out = function(left, right)
        trim()
        return out

    return one if function.__code__.co_argcount == 1 else two


def cut(df: DataFrame) -> DataFrame:
    """Materialise df in the shared checkpoint folder, so that lost executors don't restart the plan."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Let Spark delete shuffle files and checkpoints of tables that nothing refers to any more.

    Spark does so when the driver collects its garbage, which a driver with memory
    to spare puts off while an iterative job fills the disks.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def text_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows holding about `limit` bytes of text; a longer text stands alone.

    Freed memory goes back to the machine behind the last of them.
    """
    values = batch.column(batch.schema.get_field_index(column))
    start = held = 0
    for i, size in enumerate(byte_lengths(values)):
        if i > start and held + size > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if batch.num_rows > start:
        yield batch.slice(start)
    trim()


def byte_lengths(values: pa.Array) -> list[int]:
    import pyarrow.compute as pc

    return [n or 0 for n in pc.binary_length(values).to_pylist()]


def sound_text(values: pa.Array) -> pa.Array:
    """values as strings; what isn't UTF-8, which Spark lets pass, becomes U+FFFD."""
    raw = values.cast(pa.binary())
    try:
        return raw.cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([None if x is None else x.decode("utf-8", "replace") for x in raw.to_pylist()], pa.string())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table that a job of ours wrote, wherever Spark's paths lead."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)

"""Shared pieces: the word pattern, the shared folder and column handling."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import re
import threading
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but the six ASCII white-space characters; on UTF-8 bytes this is bytes.split().
WORD = r"[^\x20\x09-\x0D]+"

_SCRATCH: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only a local session may do without it and gets one of its own."""
    context = spark.sparkContext
    found = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    current = context._jsc.sc().getCheckpointDir()
    if found:
        if current.isEmpty():
            context.setCheckpointDir(found)
        return found
    if current.isDefined():
        return current.get()
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    context.setCheckpointDir("/tmp/harrier-checkpoints")
    return context._jsc.sc().getCheckpointDir().get()


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; what is left there goes when the driver ends."""
    if not _SCRATCH:
        atexit.register(_sweep)
    path = f"{shared_dir(spark).rstrip('/')}/harrier-{name}-{uuid.uuid4().hex}"
    _SCRATCH.append((spark, path))
    return path


def remove(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def _sweep() -> None:
    for spark, path in _SCRATCH:
        try:
            remove(spark, path)
        except Exception:  # the JVM may already be gone
            return


def free(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files and checkpoints that nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def settle(df: DataFrame) -> DataFrame:
    """Cut the lineage: a reliable checkpoint in the shared folder, removed once nothing refers to it."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Cut the lineage by a Parquet table in the shared folder, and give its path."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def small_batches(spark: SparkSession, most: int = 4 << 20) -> None:
    """Let Spark hand rows to Python workers in batches of at most `most` bytes, unless the session says something itself."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not spark.sparkContext.getConf().contains(name):
        spark.conf.set(name, str(most))


def n_words(text: str | Column) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(f"({WORD})")), F.lit(0)).cast("long")


def fresh(name: str, taken: list[str]) -> str:
    """A column name that does not clash with the taken ones, compared without regard to case."""
    low = {x.lower() for x in taken}
    while name.lower() in low:
        name = f"_{name}"
    return name


#: Bytes of a batch that become Python objects at a time; a longer row is a slice of its own.
SLICE_BYTES = 2 << 20


def slices(batches: Iterator[pa.RecordBatch], most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `most` bytes, so that a task's memory hangs on its longest row, not on its number of rows.

    A worker process serves many tasks; soon after this one it gives the memory back that it doesn't use.
    """
    for batch in batches:
        step = max(1, int(batch.num_rows * most / max(1, batch.get_total_buffer_size() or 1)))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)
    timer = threading.Timer(1.0, trim)
    timer.daemon = True
    timer.start()


def trim() -> None:
    """Give memory that is free inside this process back to the system, where the C library can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def raws(column: pa.Array) -> list:
    """Strings as UTF-8 bytes, without a detour by str."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else pa.binary()).to_pylist()

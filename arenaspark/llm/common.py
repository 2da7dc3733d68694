"""What the training-data operators share: table reading, shared intermediate tables, bounded broadcasts."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arenaspark.session import ensure_checkpoint_dir

BATCH_ROWS = 2048  # rows of texts sent to a Python worker at a time

# The white space that separates words in the contracts.
WORD_SPACE = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs planned inside send ``BATCH_ROWS`` rows at a time to the Python workers, as both sides hold a batch in memory."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(name)
    spark.conf.set(name, str(min(BATCH_ROWS, int(old)) if int(old) > 0 else BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(name, old)


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage: every executor reads the written files, so a lost
    executor costs no recomputation of what came before.
    """
    path = scratch_path(df.sparkSession, name)
    with small_batches(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_memory() -> None:
    """Give a worker's freed memory back to the system, for workers are kept between tasks and stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library: it trims by itself or not at all
        pass


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], rows: int = 512):
    """``run`` over slices of at most ``rows`` rows, with memory given back when the task ends."""

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, rows):
                yield b.slice(i, rows)

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(sliced(batches))
        finally:
            release_memory()

    return wrapped


def small_side(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast hint for ``df`` if it has at most ``max_rows`` rows; beyond
    that the plain frame, which joins by shuffle."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col), F.lit(""))

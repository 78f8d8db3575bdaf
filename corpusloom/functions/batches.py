"""Arrow batches of long texts, small enough for the workers beside an executor's JVM."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Bytes of an Arrow batch.
BATCH_BYTES = 4 << 20
_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def small(spark: SparkSession) -> None:
    """Batches of the session get as small as BATCH_BYTES, unless it already asks for smaller ones."""
    size = re.fullmatch(r"(-?\d+)([kmg]?)b?", str(spark.conf.get(_SETTING)).lower())
    if size is None or not 0 < int(size[1]) << {"": 0, "k": 10, "m": 20, "g": 30}[size[2]] <= BATCH_BYTES:
        spark.conf.set(_SETTING, str(BATCH_BYTES))


def release() -> None:
    """Gives freed memory back to the system: Python workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another system: its allocator decides
        pass


def mapped(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """df.mapInArrow(fn, schema) over small batches; a task's memory goes back when it ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from fn(batches)
        finally:
            release()

    small(df.sparkSession)
    return df.mapInArrow(run, schema)

"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..sources.tables import read_table

TEXT_BYTES = 1 << 20  # texts handed to one numpy call together (one longer text goes alone)


def slices(sizes: list[int], limit: int = TEXT_BYTES) -> Iterator[slice]:
    """Consecutive slices of a batch, each of at most ``limit`` bytes or one row."""
    first = total = 0
    for i, n in enumerate(sizes):
        if i > first and total + n > limit:
            yield slice(first, i)
            first, total = i, 0
        total += n
    if first < len(sizes):
        yield slice(first, len(sizes))


def give_back() -> None:
    """Returns freed memory of a Python worker to the machine; workers live on between tasks and would keep it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def lean(run: Callable) -> Callable:
    """A mapInArrow function that gives its memory back when its partition ends."""
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def as_bytes(col: str) -> Column:
    """The text's UTF-8 bytes, so that Python never decodes it (null stays null)."""
    return F.col(col).cast("binary")


def saved(df: DataFrame) -> DataFrame:
    """The frame, computed once and kept in the shared checkpoint folder; survives lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def small(df: DataFrame, rows: int) -> bool:
    """Whether the frame has at most ``rows`` rows (reads no more than it must to tell)."""
    return df.limit(rows + 1).count() <= rows

"""Arrow batches cut to a bounded number of text bytes, so that a Python worker's memory is bounded."""

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

TEXT_BYTES = 4 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded(df: DataFrame, limit: int = TEXT_BYTES) -> DataFrame:
    """``df``, whose rows reach Python in Arrow batches of about ``limit`` bytes (a longer row comes alone).

    That is a setting of the session, which is lowered for good, as it is read when a plan runs: without it a task
    holds 10,000 texts at a time, in the JVM and in Python.
    """
    spark = df.sparkSession
    now = int(spark.conf.get(BATCH_SETTING).removesuffix("b"))
    if now > limit:
        spark.conf.set(BATCH_SETTING, f"{limit}b")
    return df


def text_slices(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = TEXT_BYTES
) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of ``batches`` with about ``limit`` bytes in ``column``, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.binary_length(batch.column(column)).fill_null(0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
        start, before = 0, 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start, before = stop, int(ends[stop - 1])


@contextmanager
def given_back(*clear: Callable[[], None]):
    """Workers live on after a task; what it cached and what Arrow keeps in reserve goes with it."""
    try:
        yield
    finally:
        for each in clear:
            each()
        give_back()


def give_back() -> None:
    """Free memory that Arrow and the C library keep in reserve goes back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """The column's texts, null as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """One batch for each run of equal ``keys`` (whole numbers) in sorted input."""
    open_parts: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy() for k in keys]
        changed = np.zeros(batch.num_rows, bool)
        for c in columns:
            changed[1:] |= c[1:] != c[:-1]
        changed[0] = last is not None and last != tuple(c[0] for c in columns)
        starts = [0, *np.flatnonzero(changed[1:]) + 1, batch.num_rows]
        if changed[0]:
            yield pa.concat_batches(open_parts)
            open_parts = []
        for begin, end in zip(starts[:-2], starts[1:-1]):
            open_parts.append(batch.slice(begin, end - begin))
            yield pa.concat_batches(open_parts) if len(open_parts) > 1 else open_parts[0]
            open_parts = []
        open_parts.append(batch.slice(starts[-2]))
        last = tuple(c[-1] for c in columns)
    if open_parts:
        yield pa.concat_batches(open_parts)

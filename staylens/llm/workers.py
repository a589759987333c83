"""Arrow batches through Python workers: their size, and what workers hold between tasks."""

from __future__ import annotations

import ctypes
import gc
import re
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Bytes of a batch that an executor hands to a worker at most, but for a longer single row.
BATCH_BYTES = 8_000_000
_KEY, _UNITS = "spark.sql.execution.arrow.maxBytesPerBatch", {"b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _give_back() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library keeps or returns freed memory by itself
        pass


def lean(run: Run) -> Run:
    """run, after which a worker gives freed memory back to the system: workers outlive their tasks, and several wait at an
    executor for a next one."""

    @wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            _give_back()

    return wrapped


def map_batches(df: DataFrame, run: Run, schema: str | T.StructType) -> DataFrame:
    """df.mapInArrow() in batches of bounded bytes, which the session's setting asks for unless it is smaller, by lean workers."""
    conf = df.sparkSession.conf
    digits, unit = re.fullmatch(r"(-?\d+)([bkmg]?)b?", conf.get(_KEY).lower()).groups()
    if not 0 < int(digits) * _UNITS.get(unit, 1) <= BATCH_BYTES:
        conf.set(_KEY, str(BATCH_BYTES))
    return df.mapInArrow(lean(run), schema)

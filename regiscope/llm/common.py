"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator, Sequence
from functools import cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from ..session import scratch_path

#: Bytes of text handed to one vectorised step inside a task.
CHUNK_BYTES = 1 << 20


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it
    back: lineage ends here, and a lost executor costs a reread only."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@cache
def _trim():
    """The C library's call that gives free memory back; nothing where there is none."""
    return getattr(ctypes.CDLL(None), "malloc_trim", lambda keep: 0)


def release() -> None:
    """Give memory that is free back to the system: a Python worker lives on for
    the next stages, beside the executor's heap, and keeps it otherwise."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def lists(batch: pa.RecordBatch, text: str, limit: int = CHUNK_BYTES) -> Iterator[dict[str, list]]:
    """Columns of ``batch`` as Python lists, in row ranges of about ``limit``
    bytes of the column ``text``; a longer text is a range of its own. Free
    memory is given back after the last."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
    start = held = 0
    for i, n in enumerate(sizes):
        if held and held + n > limit:
            yield batch.slice(start, i - start).to_pydict()
            start, held = i, 0
        held += n
    yield batch.slice(start).to_pydict()
    release()


def out_batch(columns: Sequence[tuple[str, pa.DataType]], values: Sequence) -> pa.RecordBatch:
    """A record batch of ``values``, one sequence per (name, type)."""
    return pa.RecordBatch.from_arrays([pa.array(v, t) for (_, t), v in zip(columns, values)],
                                      names=[n for n, _ in columns])

"""Helpers of the training-data operators: table reads, tables in the shared folder, label splits."""

from __future__ import annotations

import ctypes
import gc
import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import checkpoint_dir

#: One word: a run without the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared folder (our own only where none is set, as in tests)."""
    return f"{checkpoint_dir(spark, local_fallback=True).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, retries start there."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3. A null id has no fold: it counts as not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3, F.lit(0))


def held_out(doc_id: Column) -> Column:
    return fold(doc_id) == 1


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; null reads as the empty text."""
    return [x or "" for x in batch.column(column).to_pylist()]


def batches(rows: dict[str, list], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if rows and len(next(iter(rows.values()))):
        yield pa.RecordBatch.from_pydict(rows, schema=schema)


#: Rows of a batch that a worker turns into Python objects at a time: batches have up to 10,000, of texts of any length.
SLICE_ROWS = 500


def in_slices(parts: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The rows of the batches, at most ``rows`` at a time. What the task has freed goes back to the machine when it ends, as workers go on to other tasks or wait."""
    try:
        for batch in parts:
            for k in range(0, len(batch), rows):
                yield batch.slice(k, rows)
    finally:
        give_back()


def give_back() -> None:
    """Freed memory that the allocators hold goes back to the machine (the C library's only where it can)."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


_KEPT: dict = {}


def kept_alone(key, make):
    """What a Python worker keeps between its tasks, made once: one thing at a time, as workers go on to other operators' tasks.

    An encoder's and a parser's tables take hundreds of megabytes; the next operator's task lets go of them before it makes its own."""
    if key not in _KEPT:
        let_go()
        _KEPT[key] = make()
    return _KEPT[key]


def let_go() -> None:
    """Let go of what this worker keeps: for tasks that need the memory and keep nothing themselves."""
    if _KEPT:
        _KEPT.clear()
        gc.collect()
        give_back()


def ship(spark: SparkSession) -> None:
    """Python workers look for this package where the driver found it, besides what the cluster ships to them."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])

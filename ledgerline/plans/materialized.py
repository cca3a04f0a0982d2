"""Materialise an input once, query it many times (the Spark form of CREATE TABLE AS).

``none`` (default): recomputed by every query, so that filters and columns reach the scans and nothing can go
stale. ``table``: written as Parquet to a fresh folder below the one that ``spark.checkpoint.dir`` names and read
back, which also cuts the lineage. ``cache``: a cached temp view, only on request; see :func:`release`.

Both kinds are known by the paths, sizes and modification times of all files that the input reads: when a file
changes, the next ``Inputs`` builds the input anew; the queries of one ``Inputs`` see the state at its first use.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.sources.sinks import materialize, table_path

MODES = ("none", "table", "cache")
_PREFIX = "ll_shared_"


def fingerprint(df: DataFrame, known: dict[str, str] | None = None) -> str:
    """A hash over path, size and modification time of every file that ``df`` reads (no content is read).

    The listing is added up by Spark, so one row comes back however many files there are. ``known`` keeps the hash of a file
    list for as long as its owner wants it to hold (one ``Inputs``: all its queries see the same state)."""
    files = sorted(df.inputFiles())
    if not files:
        return hashlib.sha256(b"").hexdigest()
    listed = hashlib.sha256("\n".join(files).encode()).hexdigest()
    if known is None or listed not in known:
        of_file = [F.xxhash64(F.lit(k), "path", "length", "modificationTime").cast("decimal(38,0)") for k in range(2)]
        found = df.sparkSession.read.format("binaryFile").load(files).agg(F.count(F.lit(1)), *(F.sum(c) for c in of_file)).first()
        known = {} if known is None else known
        known[listed] = hashlib.sha256(repr(tuple(found)).encode()).hexdigest()
    return known[listed]


def shared_input(spark: SparkSession, name: str, build: Callable[[], DataFrame], mode: str = "none", known: dict[str, str] | None = None) -> DataFrame:
    """The input ``name``, built by ``build`` at most once for each state of its files (``known``: see :func:`fingerprint`)."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    df = build()
    if mode == "none":
        return df
    view = f"{_PREFIX}{name}_{mode}_{fingerprint(df, known)}"
    if spark.catalog.tableExists(view):
        return spark.table(view)
    if mode == "table":  # the view is made when the table is complete, so a failed write leaves nothing to read
        df = materialize(df, table_path(spark, f"{view}-{uuid.uuid4().hex}"))
    df.createOrReplaceTempView(view)
    if mode == "cache":
        spark.catalog.cacheTable(view, StorageLevel.MEMORY_AND_DISK)
    return spark.table(view)


def release(spark: SparkSession) -> None:
    """Drop all shared views of the session, cached blocks included."""
    for t in spark.catalog.listTables():
        if t.name.startswith(_PREFIX):
            if spark.catalog.isCached(t.name):
                spark.catalog.uncacheTable(t.name)
            spark.catalog.dropTempView(t.name)

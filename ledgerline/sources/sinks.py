"""Table sinks: the Spark form of CREATE TABLE AS / INSERT / DROP-and-recreate.

Tables are Parquet folders under a base path; on a cluster that base is the shared folder the
session names (``spark.checkpoint.dir``) or a catalog location chosen by the caller.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import checkpoint_dir


def table_path(spark: SparkSession, name: str, base: str | None = None, local_fallback: bool = False) -> str:
    root = base or checkpoint_dir(spark, local_fallback=local_fallback)
    return f"{root.rstrip('/')}/tables/{name}"


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> str:
    """Write ``df`` as a Parquet table. ``overwrite`` replaces it, ``append`` inserts rows."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def save_as(df: DataFrame, table: str, mode: str = "overwrite") -> None:
    """Write ``df`` as the catalog table ``schema.table`` (CREATE TABLE AS; ``append`` inserts rows)."""
    df.write.mode(mode).saveAsTable(table)


def save_bucketed(df: DataFrame, table: str, keys: list[str], buckets: int, path: str | None = None) -> None:
    """CREATE TABLE AS with a layout: rows of equal ``keys`` lie in one of ``buckets`` buckets, sorted by them.

    Tables that are bucketed alike by their join keys join without moving a row; an aggregate by the keys needs no shuffle either.
    Rows are dealt by key before they are written, so each bucket is one file."""
    writer = df.repartition(buckets, *keys).write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def insert_batch(df: DataFrame, path: str, batch_id: int, column: str = "batch_id") -> str:
    """INSERT that may be repeated: the batch's own partition is replaced, so running it twice equals running it once.

    An empty batch leaves what is stored under its id as it is."""
    writer = df.withColumn(column, F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(column).parquet(path)
    return path


def write_in_order(df: DataFrame, path: str, order: list[Column], files: int, columns: list[str] | None = None) -> str:
    """A stored order: files in name order, and rows in each, follow ``order``; ``columns`` are what is kept, so the order may be by others.

    Rows are range-partitioned by a sample and sorted within the ranges. Name enough columns in ``order``: equal rows of it lie in one file."""
    ranged = df.repartitionByRange(files, *order).sortWithinPartitions(*order)
    (ranged.select(*columns) if columns else ranged).write.mode("overwrite").parquet(path)
    return path


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def make_folder(spark: SparkSession, path: str) -> None:
    """Make a folder where it is not there yet, in whatever file system it lies."""
    folder, files = _folder(spark, path)
    files.mkdirs(folder)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate results."""
    folder, files = _folder(spark, path)
    files.delete(folder, True)


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write once and read back: cuts the lineage so later queries and retries start from the table."""
    write_table(df, path, "overwrite")
    return df.sparkSession.read.parquet(path)

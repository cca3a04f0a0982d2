"""Declared tables: types, required columns, defaults, checks and a key, kept by catalog tables (CREATE TABLE and INSERT of the reference).

``create`` makes a catalog table with the declared types and column defaults, partitioned by batch and bucketed by its key, and a table
of rejects beside it. ``insert`` loads one batch:

* types are matched by Spark's rules for stores (numbers that fit, no text for a number), so a wrong type fails before anything is written, and so do
  columns that the table lacks;
* columns that the batch lacks are left out of the INSERT's column list, so the write fills in their defaults (NULL without one);
* rows that miss a required column, fail a check, or break the key (missing, repeated in the batch, stored by another batch) go to the rejects with their
  reason; nothing is dropped. Of a key that occurs twice in a batch no row is taken, as which came first isn't known;
* both tables overwrite the batch's own partition and nothing else: a batch loaded again (after a failure or on purpose) changes nothing.

The key is checked by an anti join with the stored keys. The stored side is read as it lies, by buckets and key column only; what is shuffled
is the new batch. One batch is loaded at a time; batch ids are whole numbers chosen by the caller (a stream has its own).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.sources.sinks import drop_folder, make_folder, materialize, table_path

BATCH, REASON = "batch_id", "reject_reason"


@dataclass(frozen=True)
class Field:
    """A column: name, SQL type; ``default`` (SQL), ``check`` (SQL condition, NULL passes) and the reason that a failing one gets."""

    name: str
    type: str
    required: bool = False
    default: str | None = None
    check: str | None = None
    reason: str = "check fails"


@dataclass(frozen=True)
class Declared:
    """A table ``schema.name`` with a key and the number of buckets that it is stored in."""

    name: str
    fields: tuple[Field, ...]
    key: tuple[str, ...]
    buckets: int = 8

    @property
    def rejects(self) -> str:
        return f"{self.name}_rejects"

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]


def _quoted(names: Sequence[str]) -> str:
    return ", ".join(f"`{n}`" for n in names)


def create(spark: SparkSession, table: Declared, location: str | None = None, rejects_location: str | None = None) -> None:
    """Create both tables where they are not there yet; with locations, batches that lie there already belong to them."""
    if "." in table.name:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{table.name.split('.')[0]}`")

    def place(path: str | None) -> str:
        return f" LOCATION '{path}'" if path else ""

    columns = ", ".join(f"`{f.name}` {f.type}" + (" NOT NULL" if f.required else "") + (f" DEFAULT {f.default}" if f.default else "") for f in table.fields)
    keyed = f"CLUSTERED BY ({_quoted(table.key)}) SORTED BY ({_quoted(table.key)}) INTO {table.buckets} BUCKETS"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table.name} ({columns}, {BATCH} BIGINT) USING parquet PARTITIONED BY ({BATCH}) {keyed}{place(location)}")
    plain = ", ".join(f"`{f.name}` {f.type}" for f in table.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table.rejects} ({plain}, {REASON} STRING, {BATCH} BIGINT) USING parquet PARTITIONED BY ({BATCH}){place(rejects_location)}")
    for name, path in ((table.name, location), (table.rejects, rejects_location)):
        if path:
            make_folder(spark, path)
            spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")


def stored_keys(spark: SparkSession, table: Declared, but_batch: int) -> DataFrame:
    """The keys that other batches have stored and which one did; a scan of the key columns that keeps the buckets' partitioning."""
    return spark.table(table.name).where(F.col(BATCH) != but_batch).select(*table.key, F.col(BATCH).alias("_stored"))


def typed(rows: DataFrame, table: Declared) -> DataFrame:
    """The rows with the declared types; columns that the table lacks, missing required ones and unsafe types are errors, before anything runs."""
    unknown = set(rows.columns) - set(table.columns)
    if unknown:
        raise ValueError(f"{table.name} has no column {', '.join(sorted(unknown))}")
    lacking = [f.name for f in table.fields if f.name not in rows.columns and (f.required or f.name in table.key) and not f.default]
    if lacking:
        raise ValueError(f"{table.name} needs {', '.join(lacking)}")
    names = [f for f in table.fields if f.name in rows.columns]
    return rows.to(T.StructType([T.StructField(f.name, T.DataType.fromDDL(f.type)) for f in names]))


def checked(rows: DataFrame, table: Declared, batch_id: int) -> DataFrame:
    """The batch's rows with their ``reject_reason`` (NULL: to be stored)."""
    spark = rows.sparkSession
    key = list(table.key)
    twice = rows.groupBy(*key).agg((F.count(F.lit(1)) > 1).alias("_twice")).where("_twice").dropna(subset=key)
    # the stored side is unique by key, so no row is repeated; a left join keeps the batch's rows and marks the stored ones
    marked = rows.join(twice, key, "left").join(stored_keys(spark, table, batch_id), key, "left")
    reasons: list[tuple[Column, str]] = [(F.col(k).isNull(), f"{k} missing") for k in key]
    reasons += [(F.col("_twice"), f"{', '.join(key)} duplicated"), (F.col("_stored") < batch_id, f"{', '.join(key)} stored")]
    for f in table.fields:
        if f.required and f.name in rows.columns and f.name not in key:
            reasons.append((F.col(f.name).isNull(), f"{f.name} missing"))
    reasons += [(~F.expr(f.check), f"{f.name} {f.reason}") for f in table.fields if f.check and f.name in rows.columns]
    # last: a row that is sound now, though a later batch took its key when it was not (its batch is loaded again with other rows)
    reasons.append((F.col("_stored") > batch_id, f"{', '.join(key)} stored later"))
    return marked.select(*rows.columns, F.coalesce(*(F.when(c, F.lit(r)) for c, r in reasons)).alias(REASON))


def insert(rows: DataFrame, table: Declared, batch_id: int) -> None:
    """Load ``rows`` as the batch ``batch_id``, in place of what that batch stored before.

    The checked rows are written beside the tables first: both inserts see the same ones, and neither reads the table it writes."""
    spark = rows.sparkSession
    names = [c for c in table.columns if c in rows.columns]
    path = table_path(spark, f"{table.name}-{uuid.uuid4().hex}", local_fallback=True)
    staged = materialize(checked(typed(rows, table), table, batch_id), path)
    try:
        for target, columns, part in ((table.name, names, F.col(REASON).isNull()), (table.rejects, [*names, REASON], F.col(REASON).isNotNull())):
            view = f"ledgerline_batch_{uuid.uuid4().hex}"
            staged.where(part).createOrReplaceTempView(view)
            spark.sql(f"INSERT OVERWRITE TABLE {target} PARTITION ({BATCH} = {int(batch_id)}) ({_quoted(columns)}) SELECT {_quoted(columns)} FROM {view}")
            spark.catalog.dropTempView(view)
    finally:
        drop_folder(spark, path)

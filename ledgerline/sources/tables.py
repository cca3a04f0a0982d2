"""Reading input tables. Only the named columns reach the scan's ReadSchema.

A scope names where the tables are: a folder of Parquet tables (``/data/sf1``), or ``catalog:schema`` for the tables of a
catalog schema (``catalog:sales`` reads ``sales.orders``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CATALOG = "catalog:"

#: Rows of a fact table that one task of a keyed step gets.
ROWS_A_TASK = 200_000


def read_table(spark: SparkSession, scope: str, name: str, *cols: str) -> DataFrame:
    if scope.startswith(CATALOG):
        df = spark.table(f"{scope[len(CATALOG):]}.{name}")
    else:
        df = spark.read.parquet(f"{scope.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def tasks_for(spark: SparkSession, scope: str, name: str, rows: int = ROWS_A_TASK) -> int:
    """Tasks that share the table's rows, about ``rows`` to each, and at least one a core; the count comes from the file footers.

    A shuffle to this number is left alone by AQE, which would merge its partitions by their compressed size: order lines take
    twenty times as much in a hash table."""
    return max(spark.sparkContext.defaultParallelism, -(-read_table(spark, scope, name).count() // rows))

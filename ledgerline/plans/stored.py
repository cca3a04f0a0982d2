"""Registered queries that store tables first: key-checked and repeatable inserts, table-wide row numbers, bucketed tables.

The tables go below the folder that ``spark.checkpoint.dir`` names, each time under a name of their own.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import ingest, loyalty
from ledgerline.operators.rank import number_rows
from ledgerline.sources import bindings as b
from ledgerline.sources import declared
from ledgerline.sources.sinks import insert_batch, save_bucketed, table_path
from ledgerline.sources.tables import read_table

#: Columns of an order line by which the table-wide numbers go; the remaining ones break ties.
LINE_ORDER = ["order_id", "pizza_id"]
SALES_BUCKETS = 8


def _fresh(spark: SparkSession, name: str) -> tuple[str, str]:
    """A table name and a folder that nobody uses yet."""
    own = f"{name}_{uuid.uuid4().hex}"
    return own, table_path(spark, own, local_fallback=True)


def keyed_ratings_insert(raw: DataFrame) -> DataFrame:
    """Two deliveries of ratings into the declared table: the even ids, then all of them; the second one is loaded twice."""
    spark = raw.sparkSession
    name, path = _fresh(spark, "ratings")
    table = declared.Declared(name, ingest.RATINGS.fields, ingest.RATINGS.key, ingest.RATINGS.buckets)
    declared.create(spark, table, path, f"{path}_rejects")
    ingest.insert_ratings([raw.where(F.col("rating_id") % 2 == 0), raw], table)
    declared.insert(raw, table, 1)
    stored = spark.table(table.name).withColumn(declared.REASON, F.lit(None).cast("string"))
    return stored.unionByName(spark.table(table.rejects)).select(*ingest.RATING_COLUMNS, "batch_id", "reject_reason")


def bridge_insert_repeated(recipes: DataFrame, new_rows: DataFrame) -> DataFrame:
    """C07 as a stored table: the rebuilt bridge is one batch, the appended rows are another, which is inserted twice."""
    path = _fresh(recipes.sparkSession, "bridge")[1]
    insert_batch(ingest.extend_bridge_table(recipes), path, 0)
    for _ in range(2):
        insert_batch(new_rows, path, 1)
    return recipes.sparkSession.read.parquet(path).select("pizza_id", "topping_id")


def order_lines_numbered(lines: DataFrame, tasks: int | None = None) -> DataFrame:
    """Every order line under a table-wide number (``ROW_NUMBER() OVER ()``, with a defined order), in ``tasks`` ranges."""
    return number_rows(lines, LINE_ORDER, "record_id", tasks)


def bucketed_sales(spark: SparkSession, sf_dir: str, buckets: int = SALES_BUCKETS) -> DataFrame:
    """``sales`` from copies of its two facts that are bucketed by order key: their join moves no row."""
    lines, at = _fresh(spark, "lineitem")
    save_bucketed(read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey"), lines, ["l_orderkey"], buckets, at)
    orders, at = _fresh(spark, "orders")
    save_bucketed(read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate"), orders, ["o_orderkey"], buckets, at)
    return b.sales_of(spark.table(lines), spark.table(orders))


def total_spend_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L01 over the bucketed facts."""
    return loyalty.total_spend_by_customer(bucketed_sales(spark, sf_dir), b.menu(spark, sf_dir))

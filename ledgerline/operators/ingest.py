"""Bridge rebuild and append (C07), validated ratings ingest (C08), ordered preview."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.clean import normalize_list_column
from ledgerline.sources import declared
from ledgerline.sources.declared import Declared, Field

#: The ratings table as the reference declares it: key, required columns, range, and the time of loading as a default.
RATINGS = Declared(
    "ledgerline.runner_ratings",
    (
        Field("rating_id", "BIGINT"),
        Field("order_id", "BIGINT", required=True),
        Field("rating", "INT", required=True, check="rating BETWEEN 1 AND 5", reason="out of range"),
        Field("review_text", "STRING"),
        Field("rating_time", "TIMESTAMP_NTZ", default="localtimestamp()"),
    ),
    key=("rating_id",),
)
RATING_COLUMNS = tuple(RATINGS.columns)


def extend_bridge_table(recipes: DataFrame, new_rows: DataFrame | None = None, key: str = "pizza_id",
                        list_col: str = "toppings", item_col: str = "topping_id") -> DataFrame:
    """Rebuild the (key, item) bridge from the delimited lists, then append ``new_rows``.

    Rows are data: no completeness is implied for a new entity (it may lack a name or some items).
    Write the result with ``sinks.write_table(..., mode='overwrite')`` to replace the stored table.
    """
    bridge = normalize_list_column(recipes, key, list_col, item_col).select(
        F.col(key).cast("int").alias(key), F.col(item_col).cast("int").alias(item_col))
    if new_rows is None:
        return bridge
    return bridge.unionByName(new_rows.select(
        F.col(key).cast("int").alias(key), F.col(item_col).cast("int").alias(item_col)))


def ratings_ingest(rows: DataFrame, low: int = 1, high: int = 5) -> DataFrame:
    """Check submitted ratings against the table's constraints.

    ``rating_id`` is the key: a missing one, and every row of one that occurs twice, is rejected (which
    of them came first is not known). ``order_id`` and ``rating`` are required; the rating is a whole number in
    ``[low, high]``. A missing ``rating_time`` defaults to the ingest time. Every input row comes out
    once with ``accepted`` and ``reject_reason`` (NULL when accepted), so nothing is silently dropped.
    """
    twice = rows.groupBy("rating_id").agg((F.count(F.lit(1)) > 1).alias("_twice")).where("_twice AND rating_id IS NOT NULL")
    rows = rows.join(twice, "rating_id", "left")
    rating = F.col("rating")
    reason = (F.when(F.col("rating_id").isNull(), F.lit("rating_id missing"))
              .when(F.col("_twice"), F.lit("rating_id duplicated"))
              .when(F.col("order_id").isNull(), F.lit("order_id missing"))
              .when(rating.isNull(), F.lit("rating missing"))
              .when(rating != F.floor(rating), F.lit("rating not whole"))
              .when((rating < low) | (rating > high), F.lit("rating out of range"))
              .otherwise(F.lit(None).cast("string")))
    return rows.select(
        F.col("rating_id"), F.col("order_id"), rating.cast("int").alias("rating"), F.col("review_text"),
        F.coalesce(F.col("rating_time"), F.localtimestamp()).alias("rating_time"),
        reason.isNull().alias("accepted"),
        reason.alias("reject_reason"),
    )


def ratings_table(ingested: DataFrame) -> DataFrame:
    """Content of the ratings table = the accepted rows of C08."""
    return ingested.where("accepted").select(*RATING_COLUMNS)


def insert_ratings(batches: list[DataFrame], table: Declared) -> DataFrame:
    """Load batches of submitted ratings, numbered from 0, into the ratings table; every row of every batch with its ``batch_id`` and
    ``reject_reason`` (NULL: stored). A key is stored once, whichever batches send it; loading the batches again gives the same tables."""
    spark = batches[0].sparkSession
    for k, rows in enumerate(batches):
        declared.insert(rows, table, k)
    stored = spark.table(table.name).withColumn(declared.REASON, F.lit(None).cast("string"))
    return stored.unionByName(spark.table(table.rejects))


def ordered_preview(df: DataFrame, order_by: list[str], n: int = 10) -> DataFrame:
    """The first ``n`` rows by a total order (``LIMIT`` alone leaves the choice undefined).

    Planned as ``TakeOrderedAndProject``: each task keeps ``n`` rows, the driver merges them.
    """
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order_by]).limit(n)

"""Per-key ranking building blocks (first/last/favourite, top-k, line ids).

Skew: one key may hold a large share of the rows, so the top-1 forms are aggregations with map-side
partial results (a struct is compared by a sort aggregate; callers reduce to the best date with a hash
aggregate first), "keep ties" is a rank filter that Spark pre-applies per map task (``WindowGroupLimit``;
the ties themselves still meet in one task), and ranks over a whole key are computed on its distinct
order values only.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.sources.sinks import materialize, table_path


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str],
                  descending: bool = False) -> DataFrame:
    """One row per key: the ``values`` of the smallest (or largest) ``order`` tuple.

    The order tuple continues with ``values`` so ties are broken deterministically (the reference's
    ROW_NUMBER picks an arbitrary row). A NULL comes after all values, in either direction, so a key keeps
    a row even if its order values are all NULL.
    """
    parts = []
    for c in list(order) + [v for v in values if v not in order]:
        missing = F.col(c).isNull()
        parts += [(~missing if descending else missing).alias(f"_has_{c}"), F.col(c)]
    best = (F.max if descending else F.min)(F.struct(*parts)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{v}").alias(v) for v in values])


def keep_best_ties(df: DataFrame, keys: Sequence[str], order: str, descending: bool = False) -> DataFrame:
    """Rows whose ``order`` value is the best within their key (``DENSE_RANK() = 1``, ties kept).

    Planned with a partial ``WindowGroupLimit`` before the shuffle: every map task forwards only
    its best-ranked rows per key. All ties of a key reach one task: use it where they are few.
    """
    o = F.col(order).desc_nulls_last() if descending else F.col(order).asc_nulls_last()
    w = Window.partitionBy(*keys).orderBy(o)
    return df.withColumn("_rank", F.dense_rank().over(w)).where(F.col("_rank") == 1).drop("_rank")


def dense_ranks(df: DataFrame, keys: Sequence[str], order: str, out: str) -> DataFrame:
    """The distinct (keys, order) values with ``out`` = their dense rank by ``order`` within keys.

    A hot key cannot blow this up beyond its number of distinct order values.
    """
    distinct = df.select(*keys, order).where(F.col(order).isNotNull()).distinct()
    w = Window.partitionBy(*keys).orderBy(F.col(order))
    return distinct.withColumn(out, F.row_number().over(w))


def dense_rank_distinct(df: DataFrame, keys: Sequence[str], order: str, out: str) -> DataFrame:
    """``DENSE_RANK() OVER (PARTITION BY keys ORDER BY order)`` attached to every row, via
    :func:`dense_ranks` joined back on (keys, order), which spreads a hot key over its order values."""
    return df.join(dense_ranks(df, keys, order, out), on=[*keys, order], how="left")


def top_n(df: DataFrame, order: Sequence, n: int = 1) -> DataFrame:
    """Global top-``n`` by a total order; each task keeps ``n`` rows (``TakeOrderedAndProject``)."""
    return df.orderBy(*order).limit(n)


def line_number_ranges(df: DataFrame, key: str, content: Sequence[str]) -> DataFrame:
    """Per (key, distinct content): ``_first`` and ``_n`` such that its rows are numbered
    ``_first .. _first + _n - 1`` within the key, in content order (NULLs first).

    ``ROW_NUMBER() OVER ()`` is unordered; identical rows are interchangeable, so rows are counted
    per distinct content first (map-side) and numbered by cumulative counts: a key with many
    identical rows costs one row in the window, not n. Work that depends only on the content can
    run on these ranges before :func:`expand_ranges` turns them back into one row per line.
    """
    counted = df.groupBy(key, *content).agg(F.count(F.lit(1)).alias("_n"))
    w = (Window.partitionBy(key).orderBy(*[F.col(c).asc_nulls_first() for c in content])
         .rowsBetween(Window.unboundedPreceding, -1))
    return counted.withColumn("_first", F.coalesce(F.sum("_n").over(w), F.lit(0)) + 1)


def expand_ranges(ranges: DataFrame, out: str = "line_no", chunk: int = 1 << 20) -> DataFrame:
    """One row per number of each range; numbers are generated in chunks of at most ``chunk``, so no
    single array grows with a hot key."""
    n, first, c = F.col("_n"), F.col("_first"), F.col("_c")
    return (ranges
            .withColumn("_c", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / chunk).cast("long"))))
            .withColumn(out, F.explode(F.sequence(first + c * chunk, first + F.least(n, (c + 1) * chunk) - 1)))
            .drop("_n", "_first", "_c"))


def number_lines(df: DataFrame, key: str, content: Sequence[str], out: str = "line_no",
                 chunk: int = 1 << 20) -> DataFrame:
    """Number the rows of each ``key`` 1..n, ordered by ``content`` (NULLs first); the result has the
    key, the content columns and ``out``. See :func:`line_number_ranges`."""
    return expand_ranges(line_number_ranges(df, key, content), out, chunk)


def number_rows(df: DataFrame, order: Sequence[str], out: str = "row_number", partitions: int | None = None,
                chunk: int = 1 << 20) -> DataFrame:
    """``ROW_NUMBER() OVER (ORDER BY order, all other columns)``: dense table-wide numbers 1..n, NULLs first, never in one task.

    Equal rows are interchangeable, so distinct contents are counted first (map-side): a content that makes up a third of the table is one row
    from here on. The contents are range-partitioned, sorted and saved with the number of their range, so a retry sees the
    same layout; the rows of each range are added up (one number a range goes into the offsets), and a content's numbers start after its
    range's offset and what precedes it in the range. ``expand_ranges`` turns the counts back into rows.
    """
    spark = df.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    columns = df.columns
    by = [F.col(c).asc_nulls_first() for c in [*order, *(c for c in columns if c not in order)]]
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")).repartitionByRange(partitions, *by).sortWithinPartitions(*by)
    # the number of the range in the upper bits, the place within the range in the lower 33
    placed = materialize(counted.withColumn("_place", F.monotonically_increasing_id()), table_path(spark, f"numbered-{uuid.uuid4().hex}", local_fallback=True))
    placed = placed.withColumn("_range", F.shiftright("_place", 33)).repartition(partitions, "_range")
    totals = placed.groupBy("_range").agg(F.sum("_n").alias("_total"))
    listed = totals.agg(F.array_sort(F.collect_list(F.struct("_range", "_total"))).alias("all")).select(F.posexplode("all").alias("k", "r"), "all")
    before = F.aggregate(F.slice("all", 1, F.col("k")), F.lit(0).cast("long"), lambda a, r: a + r["_total"])
    offsets = listed.select("r._range", before.alias("_offset"))
    inside = Window.partitionBy("_range").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    ranges = placed.withColumn("_first", F.coalesce(F.sum("_n").over(inside), F.lit(0)) + 1).join(F.broadcast(offsets), "_range")
    return expand_ranges(ranges.withColumn("_first", F.col("_first") + F.col("_offset")).select(*columns, "_n", "_first"), out, chunk).select(out, *columns)

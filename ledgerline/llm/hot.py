"""Joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot if it has more than one row in so many; so there are fewer hot keys than this.
SHARE = 200


def hot_keys(left: DataFrame, keys: list[str]) -> DataFrame:
    """The hot keys of ``left`` and how many parts of at most a ``SHARE``-th of the rows theirs make: at most ``SHARE`` rows, whatever the input's size."""
    total = left.select(F.count(F.lit(1))).scalar()
    counts = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).withColumn("total", total)
    return counts.filter(F.col("n_rows") * SHARE > F.col("total")).select(*keys, F.ceil(F.col("n_rows") * SHARE / F.col("total")).cast("int").alias("parts"))


def join_unique(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``left`` joined (inner or left) with ``right``, which has each key once.

    Hot keys meet their row of ``right`` by broadcast (at most ``SHARE`` rows); only the other rows are dealt by key.
    ``left`` is read three times: hand over a saved table. Null keys match nothing."""
    hot = hot_keys(left, keys).select(*keys)
    few = F.broadcast(right.join(F.broadcast(hot), keys, "left_semi"))
    rest = left.join(F.broadcast(hot), keys, "left_anti").join(right, keys, how)
    often = left.join(F.broadcast(hot), keys, "left_semi").join(few, keys, how)
    return rest.unionByName(often)

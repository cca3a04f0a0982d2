"""Share-of-total and the two averages (M06, M07, M09) over the clean weekly mart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.numeric import round_ratio


def share_of_total(df: DataFrame, measure: str, within: Sequence[str], by: Sequence[str],
                   out: str = "sales_percentage", scale: int = 2) -> DataFrame:
    """100 × Σmeasure of each ``by`` group / Σmeasure of its ``within`` group, rounded exactly.

    Aggregates first (map-side partial aggregation), so the window only sees one row per
    (within, by) group: its partitions are as small as the number of ``by`` values.
    """
    grouped = df.groupBy(*within, *by).agg(F.sum(measure).alias("_part"))
    total = F.sum("_part").over(Window.partitionBy(*within))
    return grouped.select(*within, *by, round_ratio(F.col("_part") * 100, total, scale).alias(out))


def avg_transaction_two_ways(mart: DataFrame, keys: Sequence[str] = ("calendar_year", "platform")) -> DataFrame:
    """Mean of the per-row averages (``incorrect_average``) next to Σsales / Σtransactions
    (``correct_average``), both rounded to 2 decimals exactly."""
    avg_cents = F.col("avg_transaction") * 100
    return mart.groupBy(*keys).agg(
        round_ratio(F.sum(avg_cents), F.count("avg_transaction") * 100, 2).alias("incorrect_average"),
        round_ratio(F.sum("sales"), F.sum("transactions"), 2).alias("correct_average"))


def sum_by(df: DataFrame, keys: Sequence[str], measure: str, out: str) -> DataFrame:
    """Σ ``measure`` per key."""
    return df.groupBy(*keys).agg(F.sum(measure).cast("long").alias(out))

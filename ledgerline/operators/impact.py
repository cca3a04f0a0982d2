"""Before/after impact analysis and calendar checks on the clean weekly mart.

All impact variants are one conditional aggregation: every row lands in "before", "after" or
neither by its week number, so one scan with map-side partial sums replaces self-joins, and a
low-cardinality ``by`` key cannot skew (one partial row per key and task).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.dates import day_name
from ledgerline.functions.numeric import round_ratio


def week_date_weekday(mart: DataFrame, col: str = "week_date") -> DataFrame:
    """Distinct (blank-padded) weekday names of the week dates."""
    return mart.select(day_name(F.col(col), padded=True).alias("day_of_week")).distinct()


def missing_weeks(mart: DataFrame, first: int = 1, last: int = 52, col: str = "week_number") -> DataFrame:
    """Week numbers in ``[first, last]`` that no row has.

    ``NOT IN`` semantics: if any row's week is NULL, nothing is reported (a NULL could be any week).
    """
    spark: SparkSession = mart.sparkSession
    weeks = spark.range(first, last + 1).select(F.col("id").alias("missing_week_number"))
    # only numbers in the asked range matter, so the distinct set has at most last - first + 1 rows and is broadcast
    present = F.broadcast(mart.where(F.col(col).between(first, last)).select(F.col(col).alias("_w")).distinct())
    has_null = mart.where(F.col(col).isNull()).exists()
    return (weeks.join(present, weeks.missing_week_number == present._w, "left_anti")
            .where(~has_null))


def _pct(after: Column, before: Column, scale: int = 2) -> Column:
    # (after - before) / before × 100, multiplied first, rounded exactly
    return round_ratio((after - before) * 100, before, scale)


def event_week(mart: DataFrame, event_date: str, date_col: str = "week_date", week_col: str = "week_number") -> Column:
    """The week number of ``event_date`` looked up in the mart, as a scalar subquery (NULL if absent)."""
    return mart.where(F.col(date_col) == F.lit(event_date).cast("date")).select(week_col).distinct().scalar()


def before_after(mart: DataFrame, event_date: str, weeks: int, year: int | None = None, measure: str = "sales",
                 week_col: str = "week_number") -> DataFrame:
    """Σmeasure in the ``weeks`` weeks before the event week and in the event week plus the
    ``weeks - 1`` after it, their difference and % change (2 decimals). Weeks do not wrap across
    years. If the event date is not in the mart, every figure is NULL.
    """
    df = mart if year is None else mart.where(F.col("calendar_year") == year)
    # the looked-up week is projected once, so the plan carries a single scalar subquery
    df = df.select(week_col, measure, event_week(mart, event_date, week_col=week_col).alias("_event_week"))
    w, wk, m = F.col("_event_week"), F.col(week_col), F.col(measure)
    found = w.isNotNull()
    before = F.sum(F.when(found, F.when(wk.between(w - weeks, w - 1), m).otherwise(0)))
    after = F.sum(F.when(found, F.when(wk.between(w, w + weeks - 1), m).otherwise(0)))
    sums = df.agg(before.cast("long").alias("before_change_sales"), after.cast("long").alias("after_change_sales"))
    b, a = F.col("before_change_sales"), F.col("after_change_sales")
    return sums.select(b, a, (a - b).alias("sales_difference"), _pct(a, b).alias("percentage_change"))


def window_sums(df: DataFrame, by: Sequence[str], windows: dict[str, tuple[int, int]], measure: str = "sales",
                week_col: str = "week_number") -> DataFrame:
    """Σmeasure per ``by`` group for each named inclusive week range, in one aggregation."""
    wk, m = F.col(week_col), F.col(measure)
    aggs = [F.sum(F.when(wk.between(lo, hi), m).otherwise(0)).cast("long").alias(name)
            for name, (lo, hi) in windows.items()]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def _pct_text(after: Column, before: Column) -> Column:
    # CONCAT(x, '%') keeps '%' when x is NULL (Spark's concat would give NULL)
    return F.concat(F.coalesce(_pct(after, before).cast("string"), F.lit("")), F.lit("%"))


def impact_by_year(mart: DataFrame, short: tuple[tuple[int, int], tuple[int, int]] = ((21, 24), (25, 28)),
                   long: tuple[tuple[int, int], tuple[int, int]] = ((13, 24), (25, 36)),
                   measure: str = "sales") -> DataFrame:
    """Per calendar year, % change for fixed short and long before/after week ranges, as text ``'x.xx%'``."""
    s = window_sums(mart, ["calendar_year"], {"_b4": short[0], "_a4": short[1], "_b12": long[0], "_a12": long[1]}, measure)
    return s.select("calendar_year",
                    _pct_text(F.col("_a4"), F.col("_b4")).alias("pct_change_4wk"),
                    _pct_text(F.col("_a12"), F.col("_b12")).alias("pct_change_12wk"))


def impact_by(mart: DataFrame, dim: str, year: int | None = None,
              before_weeks: tuple[int, int] = (13, 24), after_weeks: tuple[int, int] = (25, 36),
              measure: str = "sales") -> DataFrame:
    """% change per value of ``dim`` between two week ranges of one year, for groups with
    positive before-sales."""
    df = mart if year is None else mart.where(F.col("calendar_year") == year)
    s = window_sums(df, [dim], {"before_sales": before_weeks, "after_sales": after_weeks}, measure)
    return s.where(F.col("before_sales") > 0).select(
        dim, _pct(F.col("after_sales"), F.col("before_sales")).alias("percentage_change"))

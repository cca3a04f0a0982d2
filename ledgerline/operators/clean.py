"""Cleaning and normalisation.

The reference cleans with UPDATE/ALTER chains that only work once and in order; here each step is
a pure projection, so it is idempotent and fuses into the scan stage (no shuffle).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.dates import parse_day_month_yy
from ledgerline.functions.numeric import round_ratio
from ledgerline.functions.text import DEFAULT_SENTINELS, null_if_sentinel, remove_words, split_ids, strip_chars

# Unit spellings removed from the delivery text, longest first.
DISTANCE_UNIT_CHARS = "km"
DURATION_UNITS = ("minutes", "minute", "mins")
#: Decimals that a distance may have.
DISTANCE_DIGITS = 10


def clean_sentinels(df: DataFrame, cols: Iterable[str], sentinels: Iterable[str] = DEFAULT_SENTINELS) -> DataFrame:
    """``''`` / ``'null'`` (or other sentinels) become NULL in ``cols``; other columns untouched."""
    targets = set(cols)
    sentinels = tuple(sentinels)
    return df.select(*[
        null_if_sentinel(F.col(c), sentinels).alias(c) if c in targets else F.col(c) for c in df.columns
    ])


def _retype(df: DataFrame, col: str, cleaned: Column, dtype: str, rejects: str | None) -> DataFrame:
    """``col`` as ``dtype``; text that is not one becomes NULL and, with ``rejects``, is kept in that column.

    A decimal takes only text that it holds in full: digits beyond its scale would be rounded away, so such text is none
    (zeros aside), and neither is a negative power of ten."""
    typed = cleaned.try_cast(dtype)
    if dtype.startswith("decimal"):
        scale = int(dtype.rstrip(")").split(",")[1])
        typed = F.when(~cleaned.rlike(rf"\.\d{{{scale}}}\d*[1-9]") & ~cleaned.rlike("[eE]-"), typed)
    if rejects:
        df = df.withColumn(rejects, F.when(cleaned.isNotNull() & typed.isNull(), F.col(col)))
    return df.withColumn(col, typed)


def clean_pickup_time(df: DataFrame, col: str = "pickup_time", rejects: str | None = None) -> DataFrame:
    """``'null'`` -> NULL, text -> TIMESTAMP_NTZ. ``rejects`` names a column for text that is no time."""
    return _retype(df, col, null_if_sentinel(F.col(col), ("null",)), "timestamp_ntz", rejects)


def clean_distance(df: DataFrame, col: str = "distance", unit_chars: str = DISTANCE_UNIT_CHARS,
                   dtype: str = f"decimal(28,{DISTANCE_DIGITS})", rejects: str | None = None) -> DataFrame:
    """``'null'`` -> NULL, strip unit characters at both ends (``'23.4 km'``, ``'20km'``), cast.

    DECIMAL instead of REAL so that sums do not depend on partitioning; text with more decimals than the type (zeros aside) is no distance.
    """
    return _retype(df, col, strip_chars(null_if_sentinel(F.col(col), ("null",)), unit_chars), dtype, rejects)


def clean_duration(df: DataFrame, col: str = "duration", units: Iterable[str] = DURATION_UNITS, rejects: str | None = None) -> DataFrame:
    """``'null'`` -> NULL, remove unit words in the given order, cast to INT."""
    return _retype(df, col, remove_words(null_if_sentinel(F.col(col), ("null",)), units), "int", rejects)


def clean_cancellation(df: DataFrame, col: str = "cancellation") -> DataFrame:
    """``''`` / ``'null'`` -> NULL."""
    return clean_sentinels(df, [col])


def clean_runner_orders(df: DataFrame) -> DataFrame:
    """C02-C05 in one projection: the typed runner_orders table."""
    return clean_cancellation(clean_duration(clean_distance(clean_pickup_time(df))))


def clean_customer_orders(df: DataFrame) -> DataFrame:
    """C01 applied to the order lines' modification lists."""
    return clean_sentinels(df, ["exclusions", "extras"])


def normalize_list_column(df: DataFrame, key: str, list_col: str, item_col: str = "item_id",
                          sep: str = ", ") -> DataFrame:
    """One row per (key, id) from a delimited id list; NULL or empty lists give no row."""
    return df.select(F.col(key), F.explode(split_ids(F.col(list_col), sep)).alias(item_col))


def clean_weekly_sales(df: DataFrame, pivot: int = 70, iso_year: bool = False) -> DataFrame:
    """The analysis-ready weekly mart (13 columns).

    ``iso_year``: ``calendar_year`` is the year that the ISO week belongs to (2021-01-03 lies in week 53 of 2020), so that a
    week number and its year never name different weeks; by default it is the date's own year, as in the reference.

    ``week_date`` text ``d/M/yy`` -> DATE (two-digit years pivot at ``pivot``); ISO week, month, year;
    segment NULL/'null' -> 'Unknown'; age band from the segment's last character, demographic from
    its first; ``avg_transaction = ROUND(sales / transactions, 2)`` exactly (NULL for 0 transactions).
    """
    seg = F.col("segment")
    week_date = parse_day_month_yy(F.col("week_date"), pivot)
    # Segment code -> age band / demographic.
    age_band = (F.when(seg.like("%1"), "Young Adults").when(seg.like("%2"), "Middle Aged")
                .when(seg.like("%3") | seg.like("%4"), "Retirees").otherwise("Unknown"))
    demographic = F.when(seg.like("C%"), "Couples").when(seg.like("F%"), "Families").otherwise("Unknown")
    return df.select(
        week_date.alias("week_date"),
        F.weekofyear(week_date).alias("week_number"),
        F.month(week_date).alias("month_number"),
        (F.extract(F.lit("YEAROFWEEK"), week_date) if iso_year else F.year(week_date)).alias("calendar_year"),
        F.col("region"),
        F.col("platform"),
        F.when((seg == "null") | seg.isNull(), "Unknown").otherwise(seg).alias("segment"),
        age_band.alias("age_band"),
        demographic.alias("demographic"),
        F.col("customer_type"),
        F.col("transactions"),
        F.col("sales"),
        round_ratio(F.col("sales"), F.col("transactions"), 2).alias("avg_transaction"),
    )

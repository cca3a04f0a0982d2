"""Text cleaning: sentinel nulls, unit suffixes and delimited id lists."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The spellings of "missing" found in the delivery data.
DEFAULT_SENTINELS = ("", "null")


def null_if_sentinel(c: Column, sentinels: Iterable[str] = DEFAULT_SENTINELS) -> Column:
    """NULL where the text is one of ``sentinels`` (SQL NULL stays NULL), else the text."""
    return F.when(c.isin(list(sentinels)), F.lit(None)).otherwise(c)


def strip_chars(c: Column, chars: str) -> Column:
    """Remove any of ``chars`` from both ends (a character set, like ``TRIM(chars FROM c)``), then spaces."""
    return F.trim(F.btrim(c, F.lit(chars)))


def remove_words(c: Column, words: Iterable[str]) -> Column:
    """Remove each word in turn (list longer spellings first), then surrounding spaces."""
    for word in words:
        c = F.replace(c, F.lit(word), F.lit(""))
    return F.trim(c)


def split_ids(c: Column, sep: str = ", ") -> Column:
    """Delimited id list as ``array<int>``; NULL stays NULL."""
    return F.split(c, re.escape(sep)).cast("array<int>")


def collated(c: Column, collation: str | None = None) -> Column:
    """The text under a collation, for grouping and comparing (``UNICODE``, ``UNICODE_CI``, ``de_AI``, ...); as it is without one."""
    return F.collate(c, collation) if collation else c


def sort_key(c: Column, collation: str | None = None) -> Column:
    """What text is ordered by: its collation, and bytewise where that makes no difference, so that every order is total."""
    return F.struct(F.collate(c, collation), c.alias("text")) if collation else F.struct(c.alias("text"))

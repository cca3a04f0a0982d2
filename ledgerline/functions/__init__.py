"""Column-level helpers (all built-in Catalyst expressions, no Python UDFs)."""

from ledgerline.functions.dates import day_name, parse_day_month_yy, seconds_between, week_start
from ledgerline.functions.numeric import as_reported, round_ratio
from ledgerline.functions.text import null_if_sentinel, remove_words, split_ids, strip_chars

__all__ = [
    "as_reported", "day_name", "null_if_sentinel", "parse_day_month_yy", "remove_words", "round_ratio",
    "seconds_between", "split_ids", "strip_chars", "week_start",
]

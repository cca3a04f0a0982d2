"""Loyalty family (L01-L12): fact ``sales`` (customer_id, order_date, product_id), dims ``menu``
(product_id, product_name, price) and ``members`` (customer_id, join_date).

Joins are written on keys only and the planner picks broadcast vs. shuffle from table sizes
(``autoBroadcastJoinThreshold`` statically, AQE at runtime): ``menu`` and ``members`` grow with the
data, so they are never forced into a broadcast. Reductions shuffle by customer after map-side
partial aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.text import sort_key
from ledgerline.operators.rank import dense_ranks, keep_best_ties, top_n


def _priced(sales: DataFrame, menu: DataFrame) -> DataFrame:
    return sales.join(menu, "product_id")


def _as_members(sales: DataFrame, menu: DataFrame, members: DataFrame, how: str = "inner") -> DataFrame:
    return _priced(sales, menu).join(members, "customer_id", how)


def _known(sales: DataFrame, menu: DataFrame) -> DataFrame:
    """The sales of products on the menu, by their keys alone: the inner join's rows without its columns."""
    return sales.join(menu.select("product_id"), "product_id", "left_semi")


def _on_best_day(rows: DataFrame, best) -> DataFrame:
    """The rows (ties kept) on each customer's first (``F.min``) or last (``F.max``) date.

    A hash aggregate of the date, joined back on customer and date, which adaptive execution can split. A customer
    whose dates are all NULL keeps those rows; else a NULL date is never the best."""
    days = rows.groupBy(F.col("customer_id").alias("_customer")).agg(best("order_date").alias("_day"))
    return rows.join(days, F.col("customer_id").eqNullSafe(F.col("_customer")) & F.col("order_date").eqNullSafe(F.col("_day"))).drop("_customer", "_day")


def _bought(sales: DataFrame, menu: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Purchases counted per (keys, product_id) *before* the menu join, then priced and named.

    Eager aggregation: the fact is reduced map-side on numeric keys, so the join with the menu (which
    grows with the data) sees one row per (keys, product) instead of one per sale. Used where the
    query aggregates per product anyway (L04: down to one row per product; L05: per customer and
    item), not where only a per-customer total is wanted.
    """
    counted = (sales.where(F.col("product_id").isNotNull())
               .groupBy(*keys, "product_id").agg(F.count(F.lit(1)).alias("_bought")))
    return counted.join(menu, "product_id")


def total_spend_by_customer(sales: DataFrame, menu: DataFrame) -> DataFrame:
    """Σ price per customer."""
    # one reduction key (customer): repeat (customer, product) pairs are too rare for an early
    # aggregation to pay for its extra shuffle, so the join comes first
    return _priced(sales, menu).groupBy("customer_id").agg(F.sum("price").alias("total_spent"))


def visit_days_by_customer(sales: DataFrame) -> DataFrame:
    """Distinct purchase dates per customer."""
    return sales.groupBy("customer_id").agg(F.count_distinct("order_date").alias("visit_count"))


def first_item_by_customer(sales: DataFrame, menu: DataFrame, collation: str | None = None) -> DataFrame:
    """One earliest item per customer (ties on the date broken by product name, bytewise or by ``collation``)."""
    best = _on_best_day(_known(sales, menu).select("customer_id", "order_date", "product_id"), F.min)
    named = best.select("customer_id", "product_id").distinct().join(menu.select("product_id", "product_name"), "product_id")
    if collation:
        least = F.min(F.when(F.col("product_name").isNotNull(), sort_key(F.col("product_name"), collation)))
        return named.groupBy("customer_id").agg(least["text"].alias("product_name"))
    return named.groupBy("customer_id").agg(F.min("product_name").alias("product_name"))


def most_purchased_item(sales: DataFrame, menu: DataFrame, n: int = 1) -> DataFrame:
    """The ``n`` best-selling item names with their purchase counts (ties by name)."""
    counts = (_bought(sales, menu, []).groupBy("product_name")
              .agg(F.sum("_bought").cast("long").alias("times_purchased")))
    return top_n(counts, [F.desc("times_purchased"), F.asc("product_name")], n)


def favourite_item_by_customer(sales: DataFrame, menu: DataFrame) -> DataFrame:
    """Most bought item name(s) per customer, ties kept."""
    counts = (_bought(sales, menu, ["customer_id"]).groupBy("customer_id", "product_name")
              .agg(F.sum("_bought").cast("long").alias("purchase_count")))
    return keep_best_ties(counts, ["customer_id"], "purchase_count", descending=True).select(
        "customer_id", "product_name", "purchase_count")


def first_item_after_joining(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    """item(s) bought on the first date on or after ``join_date``; ties kept, non-members dropped."""
    after = _known(sales, menu).join(members, "customer_id").where(F.col("order_date") >= F.col("join_date"))
    best = _on_best_day(after.select("customer_id", "order_date", "product_id"), F.min)
    return best.join(menu.select("product_id", "product_name"), "product_id").select("customer_id", "order_date", "product_name")


def last_item_before_joining(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    """One latest item bought before ``join_date`` (ties on the date: greatest name)."""
    before = _known(sales, menu).join(members, "customer_id").where(F.col("order_date") < F.col("join_date"))
    best = _on_best_day(before.select("customer_id", "order_date", "product_id"), F.max)
    named = best.select("customer_id", "product_id").distinct().join(menu.select("product_id", "product_name"), "product_id")
    return named.groupBy("customer_id").agg(F.max("product_name").alias("product_name"))


def pre_membership_totals(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    """Items and spend before joining."""
    before = _as_members(sales, menu, members).where(F.col("order_date") < F.col("join_date"))
    return before.groupBy("customer_id").agg(
        F.count("product_id").alias("total_items"), F.sum("price").alias("total_spent"))


def points_with_item_bonus(sales: DataFrame, menu: DataFrame, bonus_item: str, base: int = 10,
                           multiplier: int = 2) -> DataFrame:
    """``price × base`` points, ``× multiplier`` more for ``bonus_item``."""
    price = F.col("price")
    points = F.when(F.col("product_name") == bonus_item, price * (base * multiplier)).otherwise(price * base)
    return _priced(sales, menu).groupBy("customer_id").agg(F.sum(points).alias("total_points"))


def points_with_welcome_week(sales: DataFrame, menu: DataFrame, members: DataFrame, bonus_item: str,
                             until: str | None = None, customers: Sequence | None = None, days: int = 6,
                             base: int = 10, multiplier: int = 2) -> DataFrame:
    """Members earn ``× multiplier`` on every item from ``join_date`` to ``join_date + days``,
    otherwise as L09. Purchases before joining still count; ``until`` and ``customers`` filter.
    """
    df = _as_members(sales, menu, members)
    if customers is not None:
        df = df.where(F.col("customer_id").isin(list(customers)))
    if until is not None:
        df = df.where(F.col("order_date") <= F.lit(until).cast("date"))
    price, d, j = F.col("price"), F.col("order_date"), F.col("join_date")
    points = (F.when(d.between(j, F.date_add(j, days)), price * (base * multiplier))
              .when(F.col("product_name") == bonus_item, price * (base * multiplier))
              .otherwise(price * base))
    return df.groupBy("customer_id").agg(F.sum(points).alias("total_points"))


def sales_with_member_flag(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    """Every sale with ``member`` 'Y' from the join date on, else 'N' (also for non-members)."""
    df = _as_members(sales, menu, members, how="left")
    member = F.when(F.col("order_date") >= F.col("join_date"), F.lit("Y")).otherwise(F.lit("N"))
    return df.select("customer_id", "order_date", "product_name", "price", member.alias("member"))


def rank_member_purchases(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    """L11 plus ``ranking`` = dense rank of the date among the customer's member purchases
    (NULL for 'N' rows)."""
    flagged = sales_with_member_flag(sales, menu, members)
    # the ranks come from a narrow frame of their own: names and prices are joined for the result only
    since = _known(sales, menu).join(members, "customer_id").where(F.col("order_date") >= F.col("join_date"))
    member_rows = since.select("customer_id", "order_date")
    ranks = dense_ranks(member_rows, ["customer_id"], "order_date", "ranking")
    # a customer's 'Y' and 'N' dates never overlap (the flag is a function of the date),
    # so joining the 'Y' ranks on (customer, date) leaves NULL exactly on the 'N' rows
    return flagged.join(ranks, on=["customer_id", "order_date"], how="left").select(
        "customer_id", "order_date", "product_name", "price", "member", "ranking")

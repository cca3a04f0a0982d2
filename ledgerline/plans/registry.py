"""The registered queries: every SURVEY §2.2 operator bound to the driver tables.

``QUERIES[key](inputs)`` builds a lazy DataFrame; :func:`build` adds the shared result typing
(:func:`ledgerline.functions.numeric.as_reported`). Parameters that the reference hard-codes
(the bonus item, the event date, …) come from ``sources.bindings``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.numeric import as_reported
from ledgerline.operators import clean, delivery, impact, ingest, loyalty, modify, shares
from ledgerline.plans import stored
from ledgerline.plans.materialized import shared_input
from ledgerline.sources import bindings as b
from ledgerline.sources.sinks import write_in_order
from ledgerline.sources.tables import tasks_for

# The rows the reference appends for its new all-toppings item (ids 3 and 8 absent).
NEW_ITEM_TOPPINGS = (1, 2, 4, 5, 6, 7, 9, 10, 11, 12)
NEW_ITEM_ID = 5  # the next free item id of the bound item dimension (ids 0-4)


class Inputs:
    """Logical inputs for one scale-factor folder, built lazily (in mode ``none`` nothing runs until an action, but that the mart and
    ``lines_by_order`` count the line items by the files' footers; the other modes look at the input files once for each ``Inputs``).

    The inputs that the reference keeps as tables and that are derived here by joins (``sales``, the
    cleaned order lines and runner orders, ratings, the recipe bridge, the clean weekly mart) can be
    materialised and shared (``mode``, see ``plans.materialized``); by default every query computes them,
    so only its own columns are read. Plain scans (menu, members, …) stay scans.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, mode: str = "none"):
        self.spark, self.d, self.mode = spark, sf_dir, mode
        self._known: dict[str, str] = {}

    def _shared(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        return shared_input(self.spark, name, build, self.mode, self._known)

    SHARED = ("sales", "lines", "orders", "bridge", "ingested_ratings", "mart")

    def materialize_all(self) -> None:
        """Build every shared input now (one action each)."""
        for name in self.SHARED:
            getattr(self, name).count()

    @cached_property
    def sales(self) -> DataFrame:
        return self._shared("sales", lambda: b.sales(self.spark, self.d))

    @cached_property
    def menu(self) -> DataFrame:
        return b.menu(self.spark, self.d)

    @cached_property
    def members(self) -> DataFrame:
        return b.members(self.spark, self.d)

    @cached_property
    def raw_lines(self) -> DataFrame:
        return b.customer_orders(self.spark, self.d)

    @cached_property
    def raw_orders(self) -> DataFrame:
        return b.runner_orders(self.spark, self.d)

    @cached_property
    def lines(self) -> DataFrame:
        return self._shared("customer_orders_clean", lambda: clean.clean_customer_orders(self.raw_lines))

    @cached_property
    def tasks(self) -> int:
        """Tasks that share the order lines."""
        return tasks_for(self.spark, self.d, "lineitem")

    @cached_property
    def lines_by_order(self) -> DataFrame:
        """``lines``, dealt by order to :attr:`tasks`: for steps that number, expand or regroup the lines of an order."""
        if self.mode != "none":
            return self.lines.repartition(self.tasks, "order_id")
        return clean.clean_customer_orders(b.customer_orders(self.spark, self.d, self.tasks))

    @cached_property
    def orders(self) -> DataFrame:
        return self._shared("runner_orders_clean", lambda: clean.clean_runner_orders(self.raw_orders))

    @cached_property
    def runners(self) -> DataFrame:
        return b.runners(self.spark, self.d)

    @cached_property
    def names(self) -> DataFrame:
        return b.pizza_names(self.spark, self.d)

    @cached_property
    def toppings(self) -> DataFrame:
        return b.pizza_toppings(self.spark, self.d)

    @cached_property
    def recipes(self) -> DataFrame:
        return b.pizza_recipes(self.spark, self.d)

    @cached_property
    def bridge(self) -> DataFrame:
        return self._shared("pizza_recipes_normalized", lambda: ingest.extend_bridge_table(self.recipes))

    @cached_property
    def ingested_ratings(self) -> DataFrame:
        return self._shared("runner_ratings", lambda: ingest.ratings_ingest(b.runner_ratings_raw(self.spark, self.d)))

    @cached_property
    def ratings(self) -> DataFrame:
        return ingest.ratings_table(self.ingested_ratings)

    @cached_property
    def mart(self) -> DataFrame:
        return self._shared("clean_weekly_sales", self.build_mart)

    def build_mart(self, iso_year: bool = False) -> DataFrame:
        return clean.clean_weekly_sales(b.weekly_sales(self.spark, self.d), iso_year=iso_year)


def _new_item_rows(i: Inputs) -> DataFrame:
    return i.spark.createDataFrame([(NEW_ITEM_ID, t) for t in NEW_ITEM_TOPPINGS], "pizza_id int, topping_id int")


PREVIEW_ORDER = ["week_date", "region", "platform", "segment", "customer_type", "transactions", "sales"]

QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {
    # cleaning and normalisation
    "clean_sentinels": lambda i: clean.clean_sentinels(i.raw_lines, ["exclusions", "extras"]),
    "clean_pickup_time": lambda i: clean.clean_pickup_time(i.raw_orders).select("order_id", "pickup_time"),
    "clean_distance": lambda i: clean.clean_distance(i.raw_orders).select("order_id", "distance"),
    "clean_duration": lambda i: clean.clean_duration(i.raw_orders).select("order_id", "duration"),
    "clean_cancellation": lambda i: clean.clean_cancellation(i.raw_orders).select("order_id", "cancellation"),
    "normalize_list_column": lambda i: clean.normalize_list_column(i.recipes, "pizza_id", "toppings", "topping_id"),
    "extend_bridge_table": lambda i: ingest.extend_bridge_table(i.recipes, _new_item_rows(i)),
    "ratings_ingest": lambda i: ingest.ratings_ingest(b.runner_ratings_raw(i.spark, i.d)),
    "clean_weekly_sales": lambda i: i.build_mart(),
    "weekly_preview": lambda i: ingest.ordered_preview(i.mart, PREVIEW_ORDER, 10),
    "keyed_ratings_insert": lambda i: stored.keyed_ratings_insert(b.runner_ratings_raw(i.spark, i.d)),
    "bridge_insert_repeated": lambda i: stored.bridge_insert_repeated(i.recipes, _new_item_rows(i)),
    # loyalty
    "total_spend_bucketed": lambda i: stored.total_spend_bucketed(i.spark, i.d),
    "total_spend_by_customer": lambda i: loyalty.total_spend_by_customer(i.sales, i.menu),
    "visit_days_by_customer": lambda i: loyalty.visit_days_by_customer(i.sales),
    "first_item_by_customer": lambda i: loyalty.first_item_by_customer(i.sales, i.menu),
    "most_purchased_item": lambda i: loyalty.most_purchased_item(i.sales, i.menu, 1),
    "favourite_item_by_customer": lambda i: loyalty.favourite_item_by_customer(i.sales, i.menu),
    "first_item_after_joining": lambda i: loyalty.first_item_after_joining(i.sales, i.menu, i.members),
    "last_item_before_joining": lambda i: loyalty.last_item_before_joining(i.sales, i.menu, i.members),
    "pre_membership_totals": lambda i: loyalty.pre_membership_totals(i.sales, i.menu, i.members),
    "points_with_item_bonus": lambda i: loyalty.points_with_item_bonus(i.sales, i.menu, b.BONUS_ITEM),
    "points_with_welcome_week": lambda i: loyalty.points_with_welcome_week(
        i.sales, i.menu, i.members, b.BONUS_ITEM, until=b.POINTS_UNTIL),
    "sales_with_member_flag": lambda i: loyalty.sales_with_member_flag(i.sales, i.menu, i.members),
    "rank_member_purchases": lambda i: loyalty.rank_member_purchases(i.sales, i.menu, i.members),
    # delivery
    "items_ordered": lambda i: delivery.items_ordered(i.lines),
    "unique_orders": lambda i: delivery.unique_orders(i.lines),
    "successful_orders_by_runner": lambda i: delivery.successful_orders_by_runner(i.orders),
    "items_delivered_by_type": lambda i: delivery.items_delivered_by_type(i.lines, i.orders, i.names),
    "items_by_customer_and_type": lambda i: delivery.items_by_customer_and_type(i.lines, i.names),
    "largest_delivered_order": lambda i: delivery.largest_delivered_order(i.lines, i.orders, 1),
    "max_items_in_order": lambda i: delivery.max_items_in_order(i.lines, i.orders),
    "changed_vs_unchanged": lambda i: delivery.changed_vs_unchanged(i.lines, i.orders),
    "both_changes": lambda i: delivery.both_changes(i.lines, i.orders),
    "both_changes_count": lambda i: delivery.both_changes_count(i.lines, i.orders),
    "volume_by_hour": lambda i: delivery.volume_by_hour(i.lines),
    "volume_by_weekday": lambda i: delivery.volume_by_weekday(i.lines),
    "volume_by_weekday_padded": lambda i: delivery.volume_by_weekday(i.lines, padded=True),
    "signups_by_week": lambda i: delivery.signups_by_week(i.runners),
    "avg_pickup_minutes_by_runner": lambda i: delivery.avg_pickup_minutes_by_runner(i.lines, i.orders),
    "prep_time_vs_order_size": lambda i: delivery.prep_time_vs_order_size(i.lines, i.orders),
    "avg_distance_by_customer": lambda i: delivery.avg_distance_by_customer(i.lines, i.orders),
    "delivery_time_spread": lambda i: delivery.delivery_time_spread(i.orders),
    "delivery_speed": lambda i: delivery.delivery_speed(i.orders),
    "success_rate_by_runner": lambda i: delivery.success_rate_by_runner(i.orders),
    "standard_ingredients": lambda i: delivery.standard_ingredients(i.bridge, i.names, i.toppings),
    "top_extra": lambda i: delivery.top_extra(i.lines, i.toppings, 1),
    "top_exclusion": lambda i: delivery.top_exclusion(i.lines, i.toppings, 1),
    "order_item_label": lambda i: modify.order_item_label(i.lines_by_order, i.names, i.toppings, tasks=i.tasks),
    "ingredient_list_with_multiplier": lambda i: modify.ingredient_list_with_multiplier(
        i.lines_by_order, i.bridge, i.names, i.toppings),
    "ingredient_usage_delivered": lambda i: modify.ingredient_usage_delivered(i.lines, i.orders, i.bridge, i.toppings),
    "order_lines_numbered": lambda i: stored.order_lines_numbered(i.lines_by_order, i.tasks),
    "order_item_label_relational": lambda i: modify.order_item_label(i.lines_by_order, i.names, i.toppings, method="relational"),
    "ingredient_list_relational": lambda i: modify.ingredient_list_with_multiplier(
        i.lines_by_order, i.bridge, i.names, i.toppings, method="relational"),
    "ingredient_usage_relational": lambda i: modify.ingredient_usage_delivered(
        i.lines_by_order, i.orders, i.bridge, i.toppings, method="relational"),
    "revenue_fixed_price": lambda i: delivery.revenue_fixed_price(i.lines, i.orders, i.names, b.PREMIUM_ITEM),
    "revenue_with_extras": lambda i: delivery.revenue_with_extras(i.lines, i.orders, i.names, b.PREMIUM_ITEM),
    "ratings_table": lambda i: i.ratings,
    "delivery_summary": lambda i: delivery.delivery_summary(i.lines, i.orders, i.ratings),
    "profit_after_runner_pay": lambda i: delivery.profit_after_runner_pay(i.lines, i.orders, i.names, b.PREMIUM_ITEM),
    # weekly mart
    "week_date_weekday": lambda i: impact.week_date_weekday(i.mart),
    "missing_weeks": lambda i: impact.missing_weeks(i.mart),
    "missing_weeks_of_events": lambda i: impact.missing_weeks(b.event_weeks(i.spark, i.d)),
    "transactions_by_year": lambda i: shares.sum_by(i.mart, ["calendar_year"], "transactions", "total_transactions"),
    "sales_by_region_month": lambda i: shares.sum_by(i.mart, ["region", "month_number"], "sales", "total_sales"),
    "transactions_by_platform": lambda i: shares.sum_by(i.mart, ["platform"], "transactions", "total_transactions"),
    "platform_share_by_month": lambda i: shares.share_of_total(i.mart, "sales", ["month_number"], ["platform"]),
    "demographic_share_by_year": lambda i: shares.share_of_total(i.mart, "sales", ["calendar_year"], ["demographic"]),
    "top_retail_segments": lambda i: shares.sum_by(
        i.mart.where(F.col("platform") == "Retail"), ["age_band", "demographic"], "sales", "total_retail_sales"),
    "avg_transaction_two_ways": lambda i: shares.avg_transaction_two_ways(i.mart),
    "impact_4_weeks": lambda i: impact.before_after(i.mart, b.EVENT_DATE, 4, b.EVENT_YEAR),
    "impact_12_weeks": lambda i: impact.before_after(i.mart, b.EVENT_DATE, 12, b.EVENT_YEAR),
    "impact_by_year": lambda i: impact.impact_by_year(i.mart),
    "clean_weekly_sales_iso": lambda i: i.build_mart(iso_year=True),
    "impact_by_iso_year": lambda i: impact.impact_by_year(i.build_mart(iso_year=True)),
    "impact_by_region": lambda i: impact.impact_by(i.mart, "region", b.EVENT_YEAR),
    "impact_by_platform": lambda i: impact.impact_by(i.mart, "platform", b.EVENT_YEAR),
    "impact_by_age_band": lambda i: impact.impact_by(i.mart, "age_band", b.EVENT_YEAR),
    "impact_by_demographic": lambda i: impact.impact_by(i.mart, "demographic", b.EVENT_YEAR),
    "impact_by_customer_type": lambda i: impact.impact_by(i.mart, "customer_type", b.EVENT_YEAR),
}


# Integer measures that can be NULL are reported as DOUBLE: pandas has no NULL for a plain integer
# column, so each engine would otherwise hand such a column over in its own way.
NULLABLE_INT_AS_DOUBLE = {
    "clean_duration": ("duration",),
    "rank_member_purchases": ("ranking",),
    "delivery_summary": ("rating",),
}


# The order in which a report lists its rows: column, or "-column" for descending; NULLs as in PostgreSQL
# (last when ascending, first when descending).
RESULT_ORDER: dict[str, tuple[str, ...]] = {
    "total_spend_by_customer": ("customer_id",),
    "favourite_item_by_customer": ("customer_id", "product_name"),
    "first_item_after_joining": ("customer_id", "product_name"),
    "pre_membership_totals": ("customer_id",),
    "points_with_item_bonus": ("customer_id",),
    "points_with_welcome_week": ("customer_id",),
    "sales_with_member_flag": ("customer_id", "order_date", "product_name"),
    "rank_member_purchases": ("customer_id", "order_date", "product_name"),
    "items_by_customer_and_type": ("customer_id", "pizza_name"),
    "volume_by_hour": ("hour_of_day",),
    "signups_by_week": ("registration_week",),
    "delivery_speed": ("runner_id", "order_id"),
    "order_item_label": ("order_id", "record_id"),
    "ingredient_list_with_multiplier": ("order_id", "record_id"),
    "ingredient_usage_delivered": ("-total_quantity", "topping_name"),
    "transactions_by_year": ("calendar_year",),
    "sales_by_region_month": ("region", "month_number"),
    "platform_share_by_month": ("month_number", "platform"),
    "demographic_share_by_year": ("calendar_year", "demographic"),
    "top_retail_segments": ("-total_retail_sales",),
    "avg_transaction_two_ways": ("calendar_year", "platform"),
    "impact_by_year": ("calendar_year",),
    "impact_by_region": ("percentage_change",),
    "missing_weeks": ("missing_week_number",),
    "missing_weeks_of_events": ("missing_week_number",),
}


# Reports that are sorted by a column which they don't list: the query with that column, for the sort only.
HIDDEN_ORDER: dict[str, tuple[Callable[[Inputs], DataFrame], str]] = {
    "order_item_label": (lambda i: modify.order_item_label(i.lines_by_order, i.names, i.toppings, record_id=True, tasks=i.tasks), "record_id"),
}


def order_of(key: str, df: DataFrame, collation: str | None = None) -> list[Column]:
    """The sort columns of the report ``key`` with PostgreSQL's NULL placement; text by ``collation``, if there is one."""
    def by(name: str) -> Column:
        text = collation and isinstance(df.schema[name].dataType, T.StringType)
        return F.collate(name, collation) if text else F.col(name)

    return [by(c[1:]).desc_nulls_first() if c[0] == "-" else by(c).asc_nulls_last() for c in RESULT_ORDER.get(key, ())]


def in_order(key: str, df: DataFrame, collation: str | None = None) -> DataFrame:
    """The rows in the report's order (a range-partitioned sort); keys without one are left as they are."""
    columns = order_of(key, df, collation)
    return df.orderBy(*columns) if columns else df


def build(key: str, spark: SparkSession, sf_dir: str, inputs: Inputs | None = None, ordered: bool = False,
          collation: str | None = None) -> DataFrame:
    """The registered query ``key`` on the tables in ``sf_dir``, with the shared result typing; ``ordered`` sorts it, text
    by ``collation``. A sort column that the report doesn't list is dropped after the sort."""
    hidden = HIDDEN_ORDER.get(key) if ordered else None
    df = as_reported((hidden[0] if hidden else QUERIES[key])(inputs or Inputs(spark, sf_dir)))
    for c in NULLABLE_INT_AS_DOUBLE.get(key, ()):
        df = df.withColumn(c, F.col(c).cast("double"))
    df = in_order(key, df, collation) if ordered else df
    return df.drop(hidden[1]) if hidden else df


def store_in_order(key: str, spark: SparkSession, sf_dir: str, path: str, files: int, inputs: Inputs | None = None) -> str:
    """The report ``key`` as files whose names' order and rows' order are the report's; see ``sinks.write_in_order``."""
    hidden = HIDDEN_ORDER.get(key)
    df = as_reported((hidden[0] if hidden else QUERIES[key])(inputs or Inputs(spark, sf_dir)))
    return write_in_order(df, path, order_of(key, df), files, [c for c in df.columns if not hidden or c != hidden[1]])

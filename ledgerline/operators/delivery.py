"""Delivery family.

Inputs: ``lines`` = cleaned customer orders (order_id, customer_id, pizza_id, exclusions, extras,
order_time), ``orders`` = cleaned runner orders (order_id, runner_id, pickup_time, distance,
duration, cancellation), and the small dimensions ``names`` (pizza_id, pizza_name), ``toppings``
(topping_id, topping_name), ``runners`` (runner_id, registration_date), ``bridge`` (pizza_id,
topping_id). A line is delivered when its order has a runner order with NULL cancellation.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.dates import day_name, seconds_between, week_start
from ledgerline.functions.numeric import round_ratio
from ledgerline.functions.text import collated, sort_key, split_ids
from ledgerline.operators.clean import DISTANCE_DIGITS
from ledgerline.operators.rank import top_n


def delivered(lines: DataFrame, orders: DataFrame, *order_cols: str) -> DataFrame:
    """Lines joined to their successful runner orders (inner join, as the reference writes it)."""
    ok = orders.where(F.col("cancellation").isNull()).select("order_id", *order_cols)
    return lines.join(ok, "order_id")


def items_ordered(lines: DataFrame) -> DataFrame:
    """D01."""
    return lines.agg(F.count(F.lit(1)).alias("total_pizzas_ordered"))


def unique_orders(lines: DataFrame) -> DataFrame:
    """D02."""
    return lines.agg(F.count_distinct("order_id").alias("unique_orders"))


def successful_orders_by_runner(orders: DataFrame) -> DataFrame:
    """D03."""
    return (orders.where(F.col("cancellation").isNull()).groupBy("runner_id")
            .agg(F.count("order_id").alias("successful_orders")))


def items_delivered_by_type(lines: DataFrame, orders: DataFrame, names: DataFrame) -> DataFrame:
    """D04."""
    return (delivered(lines, orders).join(names, "pizza_id").groupBy("pizza_name")
            .agg(F.count("pizza_id").alias("pizzas_delivered")))


def items_by_customer_and_type(lines: DataFrame, names: DataFrame) -> DataFrame:
    """Only combinations that occur."""
    return (lines.join(names, "pizza_id").groupBy("customer_id", "pizza_name")
            .agg(F.count("pizza_id").alias("pizza_count")))


def _delivered_order_sizes(lines: DataFrame, orders: DataFrame) -> DataFrame:
    return delivered(lines, orders).groupBy("order_id").agg(F.count("pizza_id").alias("pizza_count"))


def largest_delivered_order(lines: DataFrame, orders: DataFrame, n: int = 1) -> DataFrame:
    """The delivered order(s) with most lines (ties by order id)."""
    return top_n(_delivered_order_sizes(lines, orders), [F.desc("pizza_count"), F.asc("order_id")], n)


def max_items_in_order(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """The same as a scalar maximum."""
    return _delivered_order_sizes(lines, orders).agg(F.max("pizza_count").alias("max_pizzas_in_order"))


def _changed(df_cols=("exclusions", "extras")):
    a, b = (F.col(c) for c in df_cols)
    return a.isNotNull() | b.isNotNull()


def changed_vs_unchanged(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Delivered lines with at least one change vs none, per customer."""
    changed = _changed()
    return delivered(lines, orders).groupBy("customer_id").agg(
        F.sum(F.when(changed, 1).otherwise(0)).cast("long").alias("pizzas_with_changes"),
        F.sum(F.when(~changed, 1).otherwise(0)).cast("long").alias("pizzas_with_no_changes"))


def _both():
    return F.col("exclusions").isNotNull() & F.col("extras").isNotNull()


def both_changes(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Delivered lines with exclusions and extras, as a conditional sum (NULL on no input)."""
    return delivered(lines, orders).agg(F.sum(F.when(_both(), 1).otherwise(0)).cast("long").alias("pizzas_with_changes"))


def both_changes_count(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """The same by filter + count (0 on no input)."""
    return delivered(lines, orders).where(_both()).agg(F.count("pizza_id").alias("pizzas_with_both_changes"))


def volume_by_hour(lines: DataFrame) -> DataFrame:
    """D09."""
    return lines.groupBy(F.hour("order_time").alias("hour_of_day")).agg(F.count("order_id").alias("pizza_count"))


def volume_by_weekday(lines: DataFrame, padded: bool = False) -> DataFrame:
    """Lines per weekday name (``padded`` = 9-character ``'Day'`` form)."""
    return (lines.groupBy(day_name(F.col("order_time"), padded).alias("day_of_week"))
            .agg(F.count("order_id").alias("pizza_count")))


def signups_by_week(runners: DataFrame, anchor: str | None = None) -> DataFrame:
    """Runners per week (Monday weeks, or 7-day periods from ``anchor``)."""
    return (runners.groupBy(week_start(F.col("registration_date"), anchor).alias("registration_week"))
            .agg(F.count("runner_id").alias("runners_signed_up")))


def avg_pickup_minutes_by_runner(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Mean order->pickup minutes per runner, rounded to whole minutes.

    One observation per line (multi-line orders weigh more), as the reference computes it;
    AVG(s / 60) = Σs / (60·n), so the rounding is exact.
    """
    picked = lines.join(orders.where(F.col("pickup_time").isNotNull()).select("order_id", "runner_id", "pickup_time"),
                        "order_id")
    secs = seconds_between(F.col("order_time"), F.col("pickup_time"))
    return picked.groupBy("runner_id").agg(
        round_ratio(F.sum(secs), F.count(secs) * 60, 0).alias("avg_pickup_minutes"))


def prep_time_vs_order_size(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Per picked-up order, its line count and minutes from first order time to first pickup."""
    picked = lines.join(orders.where(F.col("pickup_time").isNotNull()).select("order_id", "pickup_time"), "order_id")
    per_order = picked.groupBy("order_id").agg(
        F.count("pizza_id").alias("number_of_pizzas"),
        F.min("pickup_time").alias("_pickup"), F.min("order_time").alias("_ordered"))
    return per_order.select(
        "number_of_pizzas",
        (seconds_between(F.col("_ordered"), F.col("_pickup")) / 60.0).alias("prep_time_minutes"))


def avg_distance_by_customer(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Mean distance per customer over distinct (customer, order, distance), 2 decimals."""
    trips = (lines.select("order_id", "customer_id")
             .join(orders.where(F.col("distance").isNotNull()).select("order_id", "distance"), "order_id")
             .select("customer_id", "order_id", "distance").distinct())
    return trips.groupBy("customer_id").agg(
        round_ratio(F.sum("distance"), F.count("distance"), 2, DISTANCE_DIGITS).alias("avg_distance_km"))


def delivery_time_spread(orders: DataFrame) -> DataFrame:
    """Longest minus shortest duration."""
    d = orders.where(F.col("duration").isNotNull())
    return d.agg((F.max("duration") - F.min("duration")).cast("long").alias("delivery_time_difference_minutes"))


def _speed(distance: str = "distance", duration: str = "duration"):
    # distance / (duration / 60) = distance·60 / duration
    return round_ratio(F.col(distance) * 60, F.col(duration), 2, DISTANCE_DIGITS)


def delivery_speed(orders: DataFrame) -> DataFrame:
    """km/h per delivery, 2 decimals; NULL duration gives NULL speed."""
    return orders.where(F.col("distance").isNotNull()).select(
        "runner_id", "order_id", "distance", F.col("duration").alias("duration_minutes"), _speed().alias("speed_kmh"))


def success_rate_by_runner(orders: DataFrame) -> DataFrame:
    """100 × successful / all orders, whole percent."""
    ok = F.sum(F.when(F.col("cancellation").isNull(), 1).otherwise(0))
    return orders.groupBy("runner_id").agg(round_ratio(ok * 100, F.count("order_id"), 0).alias("success_percentage"))


def standard_ingredients(bridge: DataFrame, names: DataFrame, toppings: DataFrame, collation: str | None = None) -> DataFrame:
    """Alphabetical ingredient list per item name: bytewise, or by ``collation``."""
    named = bridge.join(names, "pizza_id").join(toppings, "topping_id").where(F.col("topping_name").isNotNull())
    items = F.array_sort(F.collect_list(sort_key(F.col("topping_name"), collation)))
    return named.groupBy("pizza_name").agg(
        F.array_join(F.transform(items, lambda s: s["text"]), ", ").alias("standard_ingredients"))


def _top_listed(lines: DataFrame, toppings: DataFrame, col: str, out: str, n: int, collation: str | None = None) -> DataFrame:
    ids = lines.where(F.col(col).isNotNull()).select(F.explode(split_ids(F.col(col))).alias("topping_id"))
    # count per id first: map-side partial aggregation leaves one row per id and task
    per_id = ids.groupBy("topping_id").agg(F.count(F.lit(1)).alias("_n"))
    named = per_id.join(toppings, "topping_id")
    if collation:  # names that the collation takes for equal are one; the bytewise smallest spelling stands for them
        per_name = named.groupBy(collated(F.col("topping_name"), collation).alias("_name")).agg(
            F.min("topping_name").alias("topping_name"), F.sum("_n").cast("long").alias(out))
        return top_n(per_name, [F.desc(out), F.asc("_name")], n).select("topping_name", out)
    per_name = named.groupBy("topping_name").agg(F.sum("_n").cast("long").alias(out))
    return top_n(per_name, [F.desc(out), F.asc("topping_name")], n)


def top_extra(lines: DataFrame, toppings: DataFrame, n: int = 1, collation: str | None = None) -> DataFrame:
    """Most frequently added extra over all lines (ties by name, bytewise or by ``collation``)."""
    return _top_listed(lines, toppings, "extras", "times_added", n, collation)


def top_exclusion(lines: DataFrame, toppings: DataFrame, n: int = 1, collation: str | None = None) -> DataFrame:
    """Most frequent exclusion."""
    return _top_listed(lines, toppings, "exclusions", "times_excluded", n, collation)


def _line_price(premium_item: str, premium_price: int, base_price: int):
    return F.when(F.col("pizza_name") == premium_item, F.lit(premium_price)).otherwise(F.lit(base_price))


def revenue_fixed_price(lines: DataFrame, orders: DataFrame, names: DataFrame, premium_item: str,
                        premium_price: int = 12, base_price: int = 10) -> DataFrame:
    """Delivered lines priced ``premium_price`` for ``premium_item``, else ``base_price``."""
    return (delivered(lines, orders).join(names, "pizza_id")
            .agg(F.sum(_line_price(premium_item, premium_price, base_price)).cast("long").alias("total_revenue")))


def revenue_with_extras(lines: DataFrame, orders: DataFrame, names: DataFrame, premium_item: str,
                        premium_price: int = 12, base_price: int = 10, per_extra: int = 1) -> DataFrame:
    """D24 plus ``per_extra`` for every listed extra."""
    n_extras = F.when(F.col("extras").isNull(), 0).otherwise(F.size(F.split(F.col("extras"), ", ")))
    price = _line_price(premium_item, premium_price, base_price) + n_extras * per_extra
    return (delivered(lines, orders).join(names, "pizza_id")
            .agg(F.sum(price).cast("long").alias("total_revenue_with_extras")))


def delivery_summary(lines: DataFrame, orders: DataFrame, ratings: DataFrame) -> DataFrame:
    """One row per successful order (and per distinct customer/order time of it) with rating
    (NULL if unrated), times, pickup minutes, duration, speed and number of lines.

    The lines are read once: counted per (order, customer, order time) map-side, and these counts are
    summed per order, so an order with very many lines costs one row per distinct (customer, order time).
    """
    who = lines.groupBy("order_id", "customer_id", "order_time").agg(F.count("pizza_id").alias("_n"))
    who = who.withColumn("total_pizzas", F.sum("_n").over(Window.partitionBy("order_id"))).drop("_n")
    ok = orders.where(F.col("cancellation").isNull())
    j = (ok.join(who, "order_id")
         .join(ratings.select("order_id", "rating"), "order_id", "left"))
    return j.select(
        "customer_id", "order_id", "runner_id", "rating", "order_time", "pickup_time",
        round_ratio(seconds_between(F.col("order_time"), F.col("pickup_time")), F.lit(60), 0).alias("pickup_minutes"),
        F.col("duration").alias("delivery_duration_minutes"),
        _speed().alias("avg_speed_kmh"),
        "total_pizzas")


def profit_after_runner_pay(lines: DataFrame, orders: DataFrame, names: DataFrame, premium_item: str,
                            pay_per_km: Decimal = Decimal("0.30"), premium_price: int = 12,
                            base_price: int = 10) -> DataFrame:
    """D24 revenue minus ``pay_per_km`` × every recorded distance (cancelled or not, as the
    reference counts it). The cost is a scalar subquery: both sides are single-row aggregates."""
    cost = orders.where(F.col("distance").isNotNull()).agg(F.sum("distance") * F.lit(pay_per_km))
    revenue = revenue_fixed_price(lines, orders, names, premium_item, premium_price, base_price)
    return revenue.select((F.col("total_revenue") - cost.scalar()).alias("profit"))

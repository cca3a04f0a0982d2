"""Logical inputs of the three workload families, derived from the driver tables.

This is the only module that knows the driver tables. Every binding is a pure projection or
aggregation of them, so its size grows with the scale factor. The raw text columns are kept
messy on purpose ('null', '', '20km', '25mins', …): the cleaning operators are tested on them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.sources.tables import read_table, tasks_for

# Fixed values of the bindings (see FIXTURES.md §3).
MEMBER_JOIN_BASE = "1996-01-01"       # members: join_date = base + custkey % 1500 days
RUNNER_SIGNUP_BASE = "1995-01-01"     # runners: registration_date = base + custkey % 365 days
EVENT_DATE = "1998-06-15"             # the mart's event week (a Monday, ISO week 25)
EVENT_YEAR = 1998
BONUS_ITEM = "red plate"              # menu item earning the points multiplier
PREMIUM_ITEM = "AMERICA"              # delivery item priced 12 instead of 10
POINTS_UNTIL = "1998-01-31"           # points are counted up to the end of this January


def _str(c: Column) -> Column:
    return c.cast("string")


def _plus_seconds(ts: Column, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds, ts)


# ---------------------------------------------------------------- loyalty family

def sales(spark: SparkSession, d: str) -> DataFrame:
    li = read_table(spark, d, "lineitem", "l_orderkey", "l_partkey")
    return sales_of(li, read_table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderdate"))


def sales_of(li: DataFrame, o: DataFrame) -> DataFrame:
    """The sales of given line items and orders (of any layout)."""
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("l_partkey").alias("product_id"),
    )


def menu(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "part", "p_partkey", "p_name", "p_retailprice").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("price"),
    )


def members(spark: SparkSession, d: str) -> DataFrame:
    c = read_table(spark, d, "customer", "c_custkey")
    return c.where(F.col("c_custkey") % 3 != 0).select(
        F.col("c_custkey").alias("customer_id"),
        F.date_add(F.lit(MEMBER_JOIN_BASE).cast("date"), (F.col("c_custkey") % 1500).cast("int")).alias("join_date"),
    )


# ---------------------------------------------------------------- delivery family

def customer_orders(spark: SparkSession, d: str, tasks: int | None = None) -> DataFrame:
    """The order lines; with ``tasks`` dealt to so many by order, so that steps keyed by the order need no other shuffle."""
    li = read_table(spark, d, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    o = read_table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    if tasks:
        li, o = li.repartition(tasks, "l_orderkey"), o.repartition(tasks, "o_orderkey")
    p, s, ln = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    exclusions = (F.when(p % 4 == 0, F.lit("")).when(p % 4 == 1, F.lit("null"))
                  .when(p % 4 == 2, _str(s % 25))
                  .otherwise(F.concat(_str(s % 25), F.lit(", "), _str((s + 7) % 25))))
    extras = (F.when(ln % 4 == 0, F.lit("")).when(ln % 4 == 1, F.lit("null"))
              .when(ln % 4 == 2, F.lit(None).cast("string"))
              .otherwise(F.concat(_str(p % 25), F.lit(", "), _str((p + 11) % 25))))
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        (p % 5).cast("int").alias("pizza_id"),
        exclusions.alias("exclusions"),
        extras.alias("extras"),
        _plus_seconds(F.col("o_orderdate"), (F.col("o_orderkey") * 37) % 86400).alias("order_time"),
    )


def runner_orders(spark: SparkSession, d: str) -> DataFrame:
    o = read_table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    k = F.col("o_orderkey")
    gone = k % 11 == 0
    pickup = _plus_seconds(F.col("o_orderdate"), (k * 37) % 86400 + 300 + (k * 13) % 1800)
    km = _str(5 + k % 20)
    mins = _str(10 + k % 30)
    return o.select(
        k.alias("order_id"),
        (F.col("o_custkey") % 20).cast("int").alias("runner_id"),
        F.when(gone, F.lit("null")).otherwise(_str(pickup)).alias("pickup_time"),
        F.when(gone, F.lit("null")).when(k % 3 == 0, F.concat(km, F.lit("km")))
         .when(k % 3 == 1, F.concat(km, F.lit(".4 km"))).otherwise(km).alias("distance"),
        F.when(gone, F.lit("null")).when(k % 4 == 0, F.concat(mins, F.lit(" minutes")))
         .when(k % 4 == 1, F.concat(mins, F.lit("mins"))).when(k % 4 == 2, F.concat(mins, F.lit(" minute")))
         .otherwise(mins).alias("duration"),
        F.when(gone, F.lit("Restaurant Cancellation")).when(k % 3 == 0, F.lit(""))
         .when(k % 3 == 1, F.lit("null")).otherwise(F.lit(None).cast("string")).alias("cancellation"),
    )


def runners(spark: SparkSession, d: str) -> DataFrame:
    c = read_table(spark, d, "customer", "c_custkey")
    return c.select(
        F.col("c_custkey").alias("runner_id"),
        F.date_add(F.lit(RUNNER_SIGNUP_BASE).cast("date"), (F.col("c_custkey") % 365).cast("int")).alias("registration_date"),
    )


def pizza_names(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "region", "r_regionkey", "r_name").select(
        F.col("r_regionkey").alias("pizza_id"), F.col("r_name").alias("pizza_name"))


def pizza_toppings(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "nation", "n_nationkey", "n_name").select(
        F.col("n_nationkey").alias("topping_id"), F.col("n_name").alias("topping_name"))


def pizza_recipes(spark: SparkSession, d: str) -> DataFrame:
    """Recipes as delimited text ``'1, 2, 3'`` (ids ascending), one row per item."""
    n = read_table(spark, d, "nation", "n_nationkey", "n_regionkey")
    ids = F.array_sort(F.collect_list("n_nationkey"))
    return n.groupBy(F.col("n_regionkey").alias("pizza_id")).agg(
        F.array_join(F.transform(ids, lambda x: x.cast("string")), ", ").alias("toppings"))


def runner_ratings_raw(spark: SparkSession, d: str) -> DataFrame:
    """Submitted ratings; some are out of range (0 and 6) and must be rejected by the ingest."""
    o = read_table(spark, d, "orders", "o_orderkey", "o_orderdate")
    k = F.col("o_orderkey")
    return o.where(k % 3 != 0).select(
        k.alias("rating_id"),
        k.alias("order_id"),
        (k % 7).cast("int").alias("rating"),
        F.when(k % 2 == 0, F.concat(F.lit("review "), _str(k))).otherwise(F.lit(None).cast("string")).alias("review_text"),
        F.timestamp_add("DAY", F.lit(2), F.col("o_orderdate")).alias("rating_time"),
    )


# ---------------------------------------------------------------- weekly mart

def event_weeks(spark: SparkSession, d: str) -> DataFrame:
    """The ISO week of every event; the events cover only part of the year."""
    return read_table(spark, d, "events", "ts").select(F.weekofyear("ts").alias("week_number"))


def weekly_sales(spark: SparkSession, d: str) -> DataFrame:
    """Raw weekly mart: text week (``dd/MM/yy``, Monday), five dimensions, transactions, sales.

    Line items meet their orders last, dealt by order to a number of tasks that grows with the line items: the distinct orders
    of a group are found there, without another shuffle."""
    li = read_table(spark, d, "lineitem", "l_orderkey", "l_extendedprice", "l_returnflag", "l_shipdate")
    o = read_table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderpriority")
    c = read_table(spark, d, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    n = read_table(spark, d, "nation", "n_nationkey", "n_regionkey")
    r = read_table(spark, d, "region", "r_regionkey", "r_name")
    tasks = tasks_for(spark, d, "lineitem")
    placed = (o.join(c, o.o_custkey == c.c_custkey)
              .join(n, c.c_nationkey == n.n_nationkey)
              .join(r, n.n_regionkey == r.r_regionkey)
              .select("o_orderkey", "o_orderpriority", "c_custkey", "c_mktsegment", "r_name").repartition(tasks, "o_orderkey"))
    j = li.repartition(tasks, "l_orderkey").join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
    key = F.col("c_custkey")
    seg = F.col("c_mktsegment")
    segment = (F.when(seg == "HOUSEHOLD", F.concat(F.lit("F"), _str(1 + key % 4)))
               .when(seg == "BUILDING", F.concat(F.lit("C"), _str(1 + key % 4)))
               .when(seg == "AUTOMOBILE", F.concat(F.lit("C"), _str(1 + key % 3)))
               .when(seg == "FURNITURE", F.lit("null")).otherwise(F.lit(None).cast("string")))
    flag = F.col("l_returnflag")
    return j.groupBy(
        F.date_format(F.date_trunc("week", F.col("l_shipdate")), "dd/MM/yy").alias("week_date"),
        F.col("r_name").alias("region"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.lit("Shopify")).otherwise(F.lit("Retail")).alias("platform"),
        segment.alias("segment"),
        F.when(flag == "A", F.lit("Guest")).when(flag == "R", F.lit("Existing")).otherwise(F.lit("New")).alias("customer_type"),
    ).agg(
        F.count_distinct("o_orderkey").alias("transactions"),
        F.sum(F.floor("l_extendedprice").cast("long")).cast("long").alias("sales"),
    )

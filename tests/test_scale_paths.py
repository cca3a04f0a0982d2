"""Paths that only matter at scale, exercised on small data: chunked line numbering for a hot key,
unknown ids and unnamed items in the label forms, and table materialisation."""

import datetime as dt
from decimal import Decimal

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ledgerline.functions.numeric import round_ratio
from ledgerline.operators import clean, delivery, ingest, loyalty, modify
from ledgerline.operators.rank import dense_rank_distinct, first_per_key, number_lines
from ledgerline.plans.materialized import release
from ledgerline.plans.registry import Inputs, build, in_order
from ledgerline.sources.sinks import save_as, write_table
from ledgerline.sources.tables import read_table
from tests.conftest import SF_SMALL, rows


def test_number_lines_hot_key_chunks(spark):
    hot = spark.range(0, 25).select(F.lit(7).alias("order_id"), (F.col("id") % 2).alias("pizza_id"))
    other = spark.createDataFrame([(1, 0), (1, 0)], "order_id long, pizza_id long")
    out = number_lines(hot.unionByName(other), "order_id", ["pizza_id"], chunk=4)
    got = sorted((r["order_id"], r["line_no"], r["pizza_id"]) for r in out.collect())
    assert [n for o, n, _ in got if o == 7] == list(range(1, 26))
    assert [p for o, _, p in got if o == 7] == [0] * 13 + [1] * 12  # numbered in content order
    assert [n for o, n, _ in got if o == 1] == [1, 2]


def test_rank_helpers_on_a_skewed_key(spark):
    df = spark.range(0, 1000).select(
        F.when(F.col("id") < 900, F.lit(1)).otherwise(F.col("id")).alias("k"),
        (F.lit(dt.date(2020, 1, 1)) + (F.col("id") % 10).cast("int")).alias("d"),
        (F.col("id") % 7).cast("string").alias("v"))
    first = dict(rows(first_per_key(df, ["k"], ["d", "v"], ["v"])))
    assert first[1] == "0"
    ranked = dense_rank_distinct(df, ["k"], "d", "r")
    assert ranked.count() == 1000
    assert sorted(r[0] for r in ranked.where("k = 1").select("r").distinct().collect()) == list(range(1, 11))


def test_unknown_ids_and_missing_names_are_dropped_like_inner_joins(spark):
    names = spark.createDataFrame([(1, "Meatlovers")], "pizza_id int, pizza_name string")
    toppings = spark.createDataFrame([(1, "Bacon"), (2, "Beef")], "topping_id int, topping_name string")
    bridge = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "pizza_id int, topping_id int")
    lines = spark.createDataFrame([(1, 1, 1, "9", "9, 2", None), (1, 1, 2, None, None, None), (2, 1, 1, "1, 2", "9", None)],
                                  "order_id long, customer_id long, pizza_id int, exclusions string, extras string, "
                                  "order_time timestamp_ntz")
    for method in ("lists", "relational"):
        assert rows(modify.order_item_label(lines, names, toppings, method=method)) == [
            (1, 1, "Meatlovers - Extra Beef"), (2, 1, "Meatlovers - Exclude Bacon, Beef")]
    for method in ("combinations", "relational"):
        # order 2 keeps only the unknown extra 9: no named ingredient, no row; pizza 2 has no name
        assert rows(modify.ingredient_list_with_multiplier(lines, bridge, names, toppings, method=method)) == [
            (1, 1, "Meatlovers: Bacon, 2x Beef")]


def test_table_materialisation_mode(spark):
    cached = build("impact_by_region", spark, SF_SMALL, Inputs(spark, SF_SMALL, mode="cache"))
    tabled = build("impact_by_region", spark, SF_SMALL, Inputs(spark, SF_SMALL, mode="table"))
    assert rows(cached) == rows(tabled)
    assert any(t.name.startswith("ll_shared_clean_weekly_sales_table_") for t in spark.catalog.listTables())


def test_nothing_runs_while_a_query_is_built(spark):
    jobs = spark.sparkContext.statusTracker()
    bound = Inputs(spark, SF_SMALL)
    lines, bridge, names, toppings = bound.lines, bound.bridge, bound.names, bound.toppings  # reads the files' schemas
    spark.sparkContext.setJobGroup("build-only", "build-only")
    modify.order_item_label(lines, names, toppings)
    modify.ingredient_list_with_multiplier(lines, bridge, names, toppings)
    assert not jobs.getJobIdsForGroup("build-only")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_shared_inputs_follow_their_files(spark, tmp_path):
    """A table that is replaced changes the next answer, in every mode; the default keeps nothing."""
    import shutil

    for name in ("lineitem", "orders"):
        shutil.copy(f"{SF_SMALL}/{name}.parquet", tmp_path)
    ask = lambda mode: build("items_ordered", spark, str(tmp_path), Inputs(spark, str(tmp_path), mode=mode)).first()[0]
    n = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    assert [ask(m) for m in ("none", "table", "cache")] == [n] * 3
    half = pq.read_table(f"{SF_SMALL}/lineitem.parquet").slice(0, n // 2)
    (tmp_path / "lineitem.parquet").unlink()
    pq.write_table(half, tmp_path / "lineitem.parquet")
    spark.catalog.refreshByPath(str(tmp_path))
    assert [ask(m) for m in ("none", "table", "cache")] == [n // 2] * 3
    release(spark)
    assert not any(t.name.startswith("ll_shared_") for t in spark.catalog.listTables())
    assert not any(t.name.startswith("ll_shared_") for t in spark.catalog.listTables()) and Inputs(spark, SF_SMALL).mode == "none"


def test_results_in_order(spark):
    got = [tuple(r) for r in build("sales_by_region_month", spark, SF_SMALL, ordered=True).collect()]
    assert got == sorted(got) and len(got) > 1
    top = [r.total_retail_sales for r in build("top_retail_segments", spark, SF_SMALL, ordered=True).collect()]
    assert top == sorted(top, reverse=True)
    nulls = spark.createDataFrame([(1,), (None,), (2,)], "total_retail_sales long")
    assert [r[0] for r in in_order("top_retail_segments", nulls).collect()] == [None, 2, 1]
    nulls = spark.createDataFrame([(2,), (None,), (1,)], "hour_of_day long")
    assert [r[0] for r in in_order("volume_by_hour", nulls).collect()] == [1, 2, None]


def test_missing_weeks_of_events_is_not_empty(spark):
    got = rows(build("missing_weeks_of_events", spark, SF_SMALL))
    weeks = {r[0] for r in spark.read.parquet(f"{SF_SMALL}/events.parquet").selectExpr("weekofyear(ts)").distinct().collect()}
    assert sorted(got) == [(w,) for w in range(1, 53) if w not in weeks] and got


def test_null_dates_come_last(spark):
    import datetime as dt

    menu = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "c", 1)], "product_id long, product_name string, price int")
    d = dt.date(2020, 1, 5)
    sales = spark.createDataFrame([(1, None, 1), (1, d, 2), (2, None, 3), (2, None, 2), (3, d, 9), (3, dt.date(2020, 2, 1), 1), (4, d, 3), (4, d, 2)],
                                  "customer_id long, order_date date, product_id long")
    assert rows(loyalty.first_item_by_customer(sales, menu)) == [(1, "b"), (2, "b"), (3, "a"), (4, "b")]
    members = spark.createDataFrame([(i, dt.date(2020, 1, 1)) for i in (1, 2, 4)], "customer_id long, join_date date")
    assert rows(loyalty.first_item_after_joining(sales, menu, members), "customer_id", "product_name") == [(1, "b"), (4, "b"), (4, "c")]
    late = spark.createDataFrame([(i, dt.date(2021, 1, 1)) for i in (1, 2, 3, 4)], "customer_id long, join_date date")
    assert rows(loyalty.last_item_before_joining(sales, menu, late)) == [(1, "b"), (3, "a"), (4, "c")]
    packed = spark.createDataFrame([(1, None, "x"), (1, 2, "y"), (1, 3, "z"), (2, None, "w")], "k int, o int, v string")
    assert rows(first_per_key(packed, ["k"], ["o"], ["v"])) == [(1, "y"), (2, "w")]
    assert rows(first_per_key(packed, ["k"], ["o"], ["v"], descending=True)) == [(1, "z"), (2, "w")]


def test_distances_keep_their_digits(spark):
    from decimal import Decimal as D

    raw = spark.createDataFrame([(1, "23.456km"), (2, "0.004 km"), (3, "null"), (4, "n/a"), (5, "7")], "order_id long, distance string")
    got = {r.order_id: (r.distance, r.bad) for r in clean.clean_distance(raw, rejects="bad").collect()}
    assert got == {1: (D("23.456"), None), 2: (D("0.004"), None), 3: (None, None), 4: (None, "n/a"), 5: (D("7"), None)}
    orders = clean.clean_distance(raw).selectExpr("order_id", "1 runner_id", "distance", "7 duration", "cast(null as string) cancellation")
    assert rows(delivery.delivery_speed(orders), "order_id", "speed_kmh")[:2] == [(1, D("201.05")), (2, D("0.03"))]
    lines = spark.createDataFrame([(1, 5, 1), (2, 5, 1), (1, 5, 1)], "order_id long, customer_id long, pizza_id int")
    assert rows(delivery.avg_distance_by_customer(lines, orders)) == [(5, D("11.73"))]
    assert clean.clean_duration(spark.createDataFrame([("15 mins",), ("soon",)], "duration string"), rejects="bad").collect()[1].bad == "soon"
    assert clean.clean_pickup_time(spark.createDataFrame([("",)], "pickup_time string"), rejects="bad").first().bad == ""


def test_ratio_refuses_unknown_decimals(spark):
    df = spark.createDataFrame([("1.25",)], "x string").selectExpr("cast(x as decimal(10,2)) x")
    assert df.select(round_ratio(F.col("x"), F.lit(2), 2, digits=2)).first()[0] == Decimal("0.63")
    with pytest.raises(Exception, match="decimals"):
        df.select(round_ratio(F.col("x"), F.lit(2), 2)).collect()


def test_rating_key_and_whole_numbers(spark):
    raw = spark.createDataFrame([(1, 1, 4.0, None, None), (2, 1, 4.7, None, None), (3, 1, 5.0, None, None), (3, 2, 5.0, None, None), (None, 2, 5.0, None, None)],
                                "rating_id long, order_id long, rating double, review_text string, rating_time timestamp_ntz")
    got = sorted((r.rating_id or 0, r.accepted, r.reject_reason) for r in ingest.ratings_ingest(raw).collect())
    assert got == [(0, False, "rating_id missing"), (1, True, None), (2, False, "rating not whole"), (3, False, "rating_id duplicated"), (3, False, "rating_id duplicated")]


def test_usage_option_is_never_ignored(spark):
    b = Inputs(spark, SF_SMALL)
    with pytest.raises(ValueError, match="count_extras_twice"):
        modify.ingredient_usage_delivered(b.lines, b.orders, b.bridge, b.toppings, method="relational", count_extras_twice=True)


def test_table_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, 1), (2, 1)], "pizza_id int, topping_id int")
    path = write_table(df, str(tmp_path / "bridge"), partition_by=["topping_id"])
    write_table(df.withColumn("topping_id", F.lit(2)), path, mode="append", partition_by=["topping_id"])
    assert spark.read.parquet(path).count() == 4
    write_table(df, path)
    assert spark.read.parquet(path).count() == 2
    spark.sql("DROP SCHEMA IF EXISTS ll_sink CASCADE")
    spark.sql(f"CREATE SCHEMA ll_sink LOCATION '{tmp_path}/ll_sink'")
    save_as(df, "ll_sink.bridge")
    save_as(df, "ll_sink.bridge", mode="append")
    assert read_table(spark, "catalog:ll_sink", "bridge", "pizza_id").count() == 4
    save_as(df, "ll_sink.bridge")
    assert spark.table("ll_sink.bridge").count() == 2
    spark.sql("DROP SCHEMA ll_sink CASCADE")


def _rows_a_task(df):
    return [n for n in df.rdd.mapPartitions(lambda p: [sum(1 for _ in p)]).collect() if n]


def test_lines_are_dealt_by_order_however_few_bytes(spark):
    """Partitions that AQE would merge stay apart: the order's tasks are fixed, and numbering doesn't shuffle again."""
    from ledgerline.sources import bindings as b
    from ledgerline.sources.tables import tasks_for

    n = read_table(spark, SF_SMALL, "lineitem").count()
    assert tasks_for(spark, SF_SMALL, "lineitem", 500) == -(-n // 500) > spark.sparkContext.defaultParallelism
    assert tasks_for(spark, SF_SMALL, "lineitem") == spark.sparkContext.defaultParallelism
    lines = clean.clean_customer_orders(b.customer_orders(spark, SF_SMALL, 12))
    assert rows(lines) == rows(Inputs(spark, SF_SMALL).lines)
    numbered = modify.line_ids(lines)
    dealt = _rows_a_task(numbered)
    assert len(dealt) == 12 and max(dealt) < n / 6
    bound = Inputs(spark, SF_SMALL)
    assert len(_rows_a_task(modify.tagged_toppings(numbered, bound.bridge))) == 12


def test_lines_of_one_frequent_list_are_dealt(spark):
    """A list that all lines have, and lines without a list, don't meet in one task."""
    names = spark.createDataFrame([(1, "Meatlovers")], "pizza_id int, pizza_name string")
    toppings = spark.createDataFrame([(1, "Bacon"), (2, "Beef")], "topping_id int, topping_name string")
    lines = spark.range(4000).selectExpr("id order_id", "id customer_id", "1 pizza_id", "'2, 1' exclusions", "cast(null as string) extras", "cast(null as timestamp_ntz) order_time")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = modify.order_item_label(lines, names, toppings, tasks=6)
        dealt = _rows_a_task(out)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(dealt) == 4000 and max(dealt) < 2000
    assert {r.order_item for r in out.collect()} == {"Meatlovers - Exclude Beef, Bacon"}


def test_weekly_groups_and_numbers_keep_their_tasks(spark):
    """Line items meet their orders in the tasks where the distinct orders are counted."""
    from ledgerline.operators.rank import number_rows
    from ledgerline.sources import bindings as b

    plan = b.weekly_sales(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") >= 1
    assert sum("hashpartitioning" in x and "o_orderkey" in x and "week" in x.lower() for x in plan.splitlines()) == 0
    df = spark.range(1000).selectExpr("id % 300 a", "id % 7 b")
    got = sorted(r.n for r in number_rows(df, ["a"], "n", partitions=9).collect())
    assert got == list(range(1, 1001))

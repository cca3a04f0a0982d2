"""D01-D28 semantics on micro-frames, plus the equivalences of SURVEY §5 (array vs relational
resolution, D06 vs D06b, D08 vs D08b) on the driver tables."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import delivery, modify
from ledgerline.plans.registry import Inputs
from tests.conftest import SF_SMALL, rows

T = dt.datetime
LINE_SCHEMA = "order_id long, customer_id long, pizza_id int, exclusions string, extras string, order_time timestamp_ntz"
ORDER_SCHEMA = ("order_id long, runner_id int, pickup_time timestamp_ntz, distance decimal(10,2), duration int, "
                "cancellation string")


def dims(spark):
    names = spark.createDataFrame([(1, "Meatlovers"), (2, "Vegetarian")], "pizza_id int, pizza_name string")
    toppings = spark.createDataFrame([(1, "Bacon"), (2, "BBQ Sauce"), (3, "Beef"), (4, "Cheese"), (5, "Chicken"),
                                      (6, "Mushrooms"), (7, "Onions")], "topping_id int, topping_name string")
    bridge = spark.createDataFrame([(1, 1), (1, 2), (1, 3), (1, 4), (2, 4), (2, 6), (2, 7)], "pizza_id int, topping_id int")
    return names, toppings, bridge


def lines(spark):
    return spark.createDataFrame([
        (1, 101, 1, None, None, T(2020, 1, 1, 18, 5, 2)),
        (2, 101, 1, "4", "1, 5", T(2020, 1, 1, 19, 0, 52)),      # extra already in recipe (1) and new (5)
        (2, 101, 1, "4", "1, 5", T(2020, 1, 1, 19, 0, 52)),      # identical line in the same order
        (3, 102, 2, "4, 6, 7", None, T(2020, 1, 2, 23, 51, 23)),  # excludes its whole recipe
        (4, 103, 1, "3", "3", T(2020, 1, 4, 13, 23, 46)),         # same id excluded and extra
        (4, 103, 2, None, "9", T(2020, 1, 4, 13, 23, 46)),        # unknown topping id
        (5, 104, 3, None, None, T(2020, 1, 8, 21, 0, 29)),        # item without a name
    ], LINE_SCHEMA)


def orders(spark):
    return spark.createDataFrame([
        (1, 1, T(2020, 1, 1, 18, 15, 34), Decimal("20.00"), 32, None),
        (2, 1, T(2020, 1, 1, 19, 10, 54), Decimal("20.00"), 27, None),
        (3, 2, None, None, None, "Restaurant Cancellation"),
        (4, 2, T(2020, 1, 4, 13, 53, 3), Decimal("23.40"), 40, None),
        (5, 3, T(2020, 1, 8, 21, 10, 57), Decimal("10.00"), 15, None),
    ], ORDER_SCHEMA)


@pytest.mark.parametrize("method", ["lists", "relational"])
def test_order_item_labels(spark, method):
    names, toppings, _ = dims(spark)
    got = rows(modify.order_item_label(lines(spark), names, toppings, method=method))
    assert got == sorted([
        (1, 1, "Meatlovers"),
        (2, 1, "Meatlovers - Exclude Cheese - Extra Bacon, Chicken"),
        (2, 1, "Meatlovers - Exclude Cheese - Extra Bacon, Chicken"),
        (3, 2, "Vegetarian - Exclude Cheese, Mushrooms, Onions"),
        (4, 1, "Meatlovers - Exclude Beef - Extra Beef"),
        (4, 2, "Vegetarian"),
    ], key=repr)


@pytest.mark.parametrize("method", ["combinations", "relational"])
def test_ingredient_lists(spark, method):
    names, toppings, bridge = dims(spark)
    got = rows(modify.ingredient_list_with_multiplier(lines(spark), bridge, names, toppings, method=method))
    assert got == sorted([
        (1, 1, "Meatlovers: BBQ Sauce, Bacon, Beef, Cheese"),
        (2, 1, "Meatlovers: BBQ Sauce, 2x Bacon, Beef, 2x Chicken"),   # every extra marked, even a new one
        (2, 2, "Meatlovers: BBQ Sauce, 2x Bacon, Beef, 2x Chicken"),
        (4, 1, "Meatlovers: BBQ Sauce, Bacon, Cheese"),                 # excluded wins over extra
        (4, 2, "Vegetarian: Cheese, Mushrooms, Onions"),
    ], key=repr)  # order 3 lost every ingredient; order 5 has no item name


@pytest.mark.parametrize("method", ["array", "relational"])
def test_ingredient_usage(spark, method):
    _, toppings, bridge = dims(spark)
    got = dict(rows(modify.ingredient_usage_delivered(lines(spark), orders(spark), bridge, toppings, method=method)))
    # delivered: orders 1, 2, 4, 5 (3 cancelled); Bacon: line 1 + two lines of order 2 + order 4 line 1
    assert got == {"Bacon": 4, "BBQ Sauce": 4, "Beef": 3, "Cheese": 3, "Chicken": 2, "Mushrooms": 1, "Onions": 1}


def test_ingredient_usage_counting_extras_twice(spark):
    _, toppings, bridge = dims(spark)
    got = dict(rows(modify.ingredient_usage_delivered(lines(spark), orders(spark), bridge, toppings, count_extras_twice=True)))
    assert got["Bacon"] == 6 and got["Chicken"] == 2


def test_line_ids_number_identical_lines(spark):
    ids = modify.line_ids(lines(spark))
    assert sorted(r["record_id"] for r in ids.where("order_id = 2").collect()) == [1, 2]
    assert ids.count() == 7


def test_metrics(spark):
    li, ro = lines(spark), orders(spark)
    names, toppings, bridge = dims(spark)
    assert delivery.items_ordered(li).first()[0] == 7
    assert delivery.unique_orders(li).first()[0] == 5
    assert rows(delivery.successful_orders_by_runner(ro)) == [(1, 2), (2, 1), (3, 1)]
    assert rows(delivery.largest_delivered_order(li, ro)) == [(2, 2)]
    assert delivery.max_items_in_order(li, ro).first()[0] == 2
    assert rows(delivery.changed_vs_unchanged(li, ro)) == [(101, 2, 1), (103, 2, 0), (104, 0, 1)]
    assert delivery.both_changes(li, ro).first()[0] == 3
    assert delivery.both_changes_count(li, ro).first()[0] == 3
    assert rows(delivery.avg_pickup_minutes_by_runner(li, ro)) == [(1, Decimal("10")), (2, Decimal("29")), (3, Decimal("10"))]
    assert rows(delivery.delivery_speed(ro), "order_id", "speed_kmh") == [
        (1, Decimal("37.50")), (2, Decimal("44.44")), (4, Decimal("35.10")), (5, Decimal("40.00"))]
    assert rows(delivery.success_rate_by_runner(ro)) == [(1, Decimal("100")), (2, Decimal("50")), (3, Decimal("100"))]
    assert delivery.delivery_time_spread(ro).first()[0] == 25
    assert rows(delivery.standard_ingredients(bridge, names, toppings)) == [
        ("Meatlovers", "BBQ Sauce, Bacon, Beef, Cheese"), ("Vegetarian", "Cheese, Mushrooms, Onions")]
    assert rows(delivery.top_extra(li, toppings)) == [("Bacon", 2)]
    assert rows(delivery.top_exclusion(li, toppings)) == [("Cheese", 3)]
    assert delivery.revenue_fixed_price(li, ro, names, "Meatlovers").first()[0] == 12 * 4 + 10
    assert delivery.revenue_with_extras(li, ro, names, "Meatlovers").first()[0] == 12 * 4 + 10 + 2 + 2 + 1 + 1
    # cost counts every recorded distance: 73.40 * 0.30 = 22.02
    assert delivery.profit_after_runner_pay(li, ro, names, "Meatlovers").first()[0] == Decimal(58) - Decimal("22.0200")


def test_empty_input_sum_is_null_count_is_zero(spark):
    li = lines(spark).where("order_id < 0")
    ro = orders(spark)
    assert delivery.both_changes(li, ro).first()[0] is None
    assert delivery.both_changes_count(li, ro).first()[0] == 0


def test_delivery_summary(spark):
    ratings = spark.createDataFrame([(1, 1, 5)], "rating_id long, order_id long, rating int")
    out = delivery.delivery_summary(lines(spark), orders(spark), ratings)
    got = {r["order_id"]: r for r in out.collect()}
    assert sorted(got) == [1, 2, 4, 5]
    assert got[1]["rating"] == 5 and got[2]["rating"] is None
    assert got[2]["total_pizzas"] == 2 and got[2]["pickup_minutes"] == Decimal("10")
    assert got[4]["total_pizzas"] == 2 and got[4]["avg_speed_kmh"] == Decimal("35.10")


@pytest.fixture(scope="module")
def bound(spark):
    return Inputs(spark, SF_SMALL, mode="none")


def test_array_and_relational_forms_agree_on_driver_tables(spark, bound):
    a = modify.ingredient_list_with_multiplier(bound.lines, bound.bridge, bound.names, bound.toppings)
    r = modify.ingredient_list_with_multiplier(bound.lines, bound.bridge, bound.names, bound.toppings, method="relational")
    assert a.exceptAll(r).count() == 0 and r.exceptAll(a).count() == 0
    a = modify.order_item_label(bound.lines, bound.names, bound.toppings)
    r = modify.order_item_label(bound.lines, bound.names, bound.toppings, method="relational")
    assert a.exceptAll(r).count() == 0 and r.exceptAll(a).count() == 0
    a = modify.ingredient_usage_delivered(bound.lines, bound.orders, bound.bridge, bound.toppings, method="array")
    r = modify.ingredient_usage_delivered(bound.lines, bound.orders, bound.bridge, bound.toppings, method="relational")
    assert rows(a) == rows(r)


def test_two_formulations_agree(spark, bound):
    top = delivery.largest_delivered_order(bound.lines, bound.orders).first()["pizza_count"]
    assert top == delivery.max_items_in_order(bound.lines, bound.orders).first()[0]
    assert (delivery.both_changes(bound.lines, bound.orders).first()[0]
            == delivery.both_changes_count(bound.lines, bound.orders).first()[0])


def test_invariants_on_driver_tables(spark, bound):
    delivered = delivery.delivered(bound.lines, bound.orders).count()
    cv = delivery.changed_vs_unchanged(bound.lines, bound.orders).agg(
        F.sum("pizzas_with_changes") + F.sum("pizzas_with_no_changes")).first()[0]
    assert cv == delivered
    labels = modify.ingredient_list_with_multiplier(bound.lines, bound.bridge, bound.names, bound.toppings).count()
    assert labels <= bound.lines.count()

"""L01-L12 on a micro-frame: ties, join-date boundaries, welcome week, non-members (FIXTURES.md §2)."""

import datetime as dt
from decimal import Decimal

from ledgerline.operators import loyalty
from tests.conftest import rows

D = dt.date


def frames(spark):
    menu = spark.createDataFrame([(1, "sushi", Decimal("10")), (2, "curry", Decimal("15")), (3, "ramen", Decimal("12"))],
                                 "product_id long, product_name string, price decimal(12,2)")
    members = spark.createDataFrame([("A", D(2021, 1, 7)), ("B", D(2021, 1, 9))], "customer_id string, join_date date")
    sales = spark.createDataFrame([
        ("A", D(2021, 1, 1), 1), ("A", D(2021, 1, 1), 2), ("A", D(2021, 1, 7), 2), ("A", D(2021, 1, 10), 3),
        ("A", D(2021, 1, 11), 3), ("A", D(2021, 1, 13), 1), ("A", D(2021, 1, 14), 2), ("A", D(2021, 2, 1), 1),
        ("B", D(2021, 1, 1), 2), ("B", D(2021, 1, 2), 2), ("B", D(2021, 1, 4), 1), ("B", D(2021, 1, 8), 3),
        ("B", D(2021, 1, 9), 1), ("B", D(2021, 1, 15), 3), ("B", D(2021, 1, 16), 3),
        ("C", D(2021, 1, 1), 3), ("C", D(2021, 1, 1), 3), ("C", D(2021, 1, 7), 3),
    ], "customer_id string, order_date date, product_id long")
    return sales, menu, members


def test_basic_totals(spark):
    s, m, _ = frames(spark)
    assert rows(loyalty.total_spend_by_customer(s, m)) == [("A", Decimal("99.00")), ("B", Decimal("86.00")), ("C", Decimal("36.00"))]
    assert rows(loyalty.visit_days_by_customer(s)) == [("A", 7), ("B", 7), ("C", 2)]
    assert rows(loyalty.most_purchased_item(s, m)) == [("ramen", 8)]


def test_first_item_tie_is_deterministic(spark):
    s, m, _ = frames(spark)
    # A bought sushi and curry on the first date: the name order breaks the tie
    assert rows(loyalty.first_item_by_customer(s, m)) == [("A", "curry"), ("B", "curry"), ("C", "ramen")]


def test_favourite_keeps_ties(spark):
    s, m, _ = frames(spark)
    got = rows(loyalty.favourite_item_by_customer(s, m))
    assert got == [("A", "curry", 3), ("A", "sushi", 3), ("B", "ramen", 3), ("C", "ramen", 3)]


def test_membership_boundaries(spark):
    s, m, mem = frames(spark)
    assert rows(loyalty.first_item_after_joining(s, m, mem)) == [("A", D(2021, 1, 7), "curry"), ("B", D(2021, 1, 9), "sushi")]
    assert rows(loyalty.last_item_before_joining(s, m, mem)) == [("A", "sushi"), ("B", "ramen")]
    assert rows(loyalty.pre_membership_totals(s, m, mem)) == [("A", 2, Decimal("25.00")), ("B", 4, Decimal("52.00"))]


def test_points(spark):
    s, m, mem = frames(spark)
    pts = dict(rows(loyalty.points_with_item_bonus(s, m, "sushi")))
    assert pts["C"] == Decimal("360.00") and pts["A"] == Decimal("1290.00")
    week = dict(rows(loyalty.points_with_welcome_week(s, m, mem, "sushi", until="2021-01-31", customers=["A", "B"])))
    # A: before joining 10*20 + 15*10; joined 01-07: 07 (curry), 10, 11, 13 (+6) doubled; 14 (+7) not
    assert week["A"] == Decimal(200 + 150 + 300 + 240 + 240 + 200 + 150)
    # B: 15*10 + 15*10 + 10*20 + 12*10, then 01-09 sushi 200, 01-15 ramen (+6) 240, 01-16 (+7) 120
    assert week["B"] == Decimal(150 + 150 + 200 + 120 + 200 + 240 + 120)
    assert "C" not in week


def test_member_flag_and_ranking(spark):
    s, m, mem = frames(spark)
    flagged = loyalty.sales_with_member_flag(s, m, mem)
    assert flagged.count() == s.count()
    assert flagged.where("customer_id = 'C' AND member = 'Y'").count() == 0
    ranked = loyalty.rank_member_purchases(s, m, mem)
    a = [(r["order_date"], r["member"], r["ranking"]) for r in ranked.where("customer_id = 'A'").orderBy("order_date", "product_name").collect()]
    assert a == [(D(2021, 1, 1), "N", None), (D(2021, 1, 1), "N", None), (D(2021, 1, 7), "Y", 1), (D(2021, 1, 10), "Y", 2),
                 (D(2021, 1, 11), "Y", 3), (D(2021, 1, 13), "Y", 4), (D(2021, 1, 14), "Y", 5), (D(2021, 2, 1), "Y", 6)]

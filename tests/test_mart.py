"""M01-M17 semantics: shares, NOT IN, missing event week, invariants across impact dimensions."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerline.operators import clean, impact, shares
from ledgerline.plans.registry import Inputs
from tests.conftest import SF_SMALL, rows
from tests.test_cleaning import WEEKLY_SCHEMA


def mart(spark):
    data = []
    for week in range(1, 53):
        if week in (5, 6, 40):
            continue
        monday = dt.date(2020, 1, 6) + dt.timedelta(weeks=week - 2)
        for region, platform, seg, kind, sales in [("ASIA", "Retail", "C1", "New", 100 + week),
                                                    ("USA", "Shopify", "F2", "Guest", 50 + 2 * week),
                                                    ("USA", "Retail", None, "Existing", 10)]:
            data.append((monday.strftime("%d/%m/%y"), region, platform, seg, kind, 2, sales))
    return clean.clean_weekly_sales(spark.createDataFrame(data, WEEKLY_SCHEMA))


def test_missing_weeks_and_null_aware_not_in(spark):
    m = mart(spark)
    assert sorted(r[0] for r in impact.missing_weeks(m).collect()) == [5, 6, 40]
    with_null = m.unionByName(m.limit(1).withColumn("week_number", F.lit(None).cast("int")))
    assert impact.missing_weeks(with_null).count() == 0


def test_weekday_names(spark):
    assert rows(impact.week_date_weekday(mart(spark))) == [("Monday   ",)]


def test_shares_sum_to_100(spark):
    m = mart(spark)
    s = shares.share_of_total(m, "sales", ["month_number"], ["platform"])
    for month, total in rows(s.groupBy("month_number").agg(F.sum("sales_percentage"))):
        assert abs(total - 100) <= Decimal("0.01")


def test_before_after_and_absent_event(spark):
    m = mart(spark)
    event = dt.date(2020, 6, 15)  # ISO week 25
    r = impact.before_after(m, event.isoformat(), 4, 2020).first()
    before = sum((100 + w) + (50 + 2 * w) + 10 for w in range(21, 25))
    after = sum((100 + w) + (50 + 2 * w) + 10 for w in range(25, 29))
    assert (r["before_change_sales"], r["after_change_sales"], r["sales_difference"]) == (before, after, after - before)
    assert r["percentage_change"] == (Decimal((after - before) * 100) / before).quantize(Decimal("0.01"))
    gone = impact.before_after(m, "2020-06-16", 4, 2020).first()
    assert gone["before_change_sales"] is None and gone["percentage_change"] is None


def test_impact_by_dimension_groups_and_zero_guard(spark):
    m = mart(spark)
    by_region = dict(rows(impact.impact_by(m, "region", 2020)))
    assert set(by_region) == {"ASIA", "USA"}
    empty = impact.impact_by(m.where("week_number > 24"), "region", 2020)
    assert empty.count() == 0  # no before-sales: guarded instead of dividing by zero


def test_impact_sums_agree_across_dimensions(spark):
    m = Inputs(spark, SF_SMALL, mode="none").mart
    totals = set()
    for dim in ("region", "platform", "age_band", "demographic", "customer_type"):
        s = impact.window_sums(m.where("calendar_year = 1998"), [dim], {"b": (13, 24), "a": (25, 36)})
        totals.add(tuple(s.agg(F.sum("b"), F.sum("a")).first()))
    assert len(totals) == 1


def test_two_averages(spark):
    m = mart(spark)
    r = shares.avg_transaction_two_ways(m).where("platform = 'Shopify'").first()
    assert r["correct_average"] == r["incorrect_average"]  # equal transactions per row

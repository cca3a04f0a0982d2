"""C01-C10 on micro-frames with every messy spelling (FIXTURES.md §2)."""

import datetime as dt
from decimal import Decimal

from ledgerline.operators import clean, ingest
from tests.conftest import rows

RUNNER_SCHEMA = "order_id long, runner_id int, pickup_time string, distance string, duration string, cancellation string"


def runner_orders(spark):
    return spark.createDataFrame([
        (1, 1, "2020-01-01 18:15:34", "20km", "32 minutes", ""),
        (2, 1, "2020-01-01 19:10:54", "23.4 km", "20 mins", None),
        (3, 2, "2020-01-03 00:12:37", "10", "25mins", "null"),
        (4, 2, "2020-01-04 13:53:03", "13.4km", "15 minute", None),
        (5, 3, "null", "null", "null", "Restaurant Cancellation"),
        (6, 3, "2020-01-08 21:30:45", "25km", "40", "Customer Cancellation"),
    ], RUNNER_SCHEMA)


def test_runner_orders_cleaning(spark):
    out = clean.clean_runner_orders(runner_orders(spark))
    assert dict((f.name, f.dataType.simpleString()) for f in out.schema.fields)["distance"] == "decimal(28,10)"
    got = rows(out, "order_id", "pickup_time", "distance", "duration", "cancellation")
    assert got == [
        (1, dt.datetime(2020, 1, 1, 18, 15, 34), Decimal("20.00"), 32, None),
        (2, dt.datetime(2020, 1, 1, 19, 10, 54), Decimal("23.40"), 20, None),
        (3, dt.datetime(2020, 1, 3, 0, 12, 37), Decimal("10.00"), 25, None),
        (4, dt.datetime(2020, 1, 4, 13, 53, 3), Decimal("13.40"), 15, None),
        (5, None, None, None, "Restaurant Cancellation"),
        (6, dt.datetime(2020, 1, 8, 21, 30, 45), Decimal("25.00"), 40, "Customer Cancellation"),
    ]


def test_sentinels_and_idempotence(spark):
    df = spark.createDataFrame([(1, None, ""), (2, "null", "4"), (3, "2, 6", "null"), (4, "", None)],
                               "order_id long, exclusions string, extras string")
    once = clean.clean_sentinels(df, ["exclusions", "extras"])
    assert rows(once) == [(1, None, None), (2, None, "4"), (3, "2, 6", None), (4, None, None)]
    assert rows(clean.clean_sentinels(once, ["exclusions", "extras"])) == rows(once)
    # other columns are left alone, order of columns kept
    assert once.columns == df.columns


def test_normalize_list_and_bridge_extension(spark):
    recipes = spark.createDataFrame([(1, "1, 2, 3, 4"), (2, "4, 6")], "pizza_id int, toppings string")
    assert rows(clean.normalize_list_column(recipes, "pizza_id", "toppings", "topping_id")) == [
        (1, 1), (1, 2), (1, 3), (1, 4), (2, 4), (2, 6)]
    new = spark.createDataFrame([(3, t) for t in (1, 2, 4, 5, 6, 7, 9, 10, 11, 12)], "pizza_id int, topping_id int")
    out = ingest.extend_bridge_table(recipes, new)
    assert out.count() == 16 and out.where("pizza_id = 3").count() == 10


def test_ratings_ingest_accepts_and_rejects(spark):
    when = dt.datetime(2021, 1, 1, 12, 0)
    df = spark.createDataFrame([
        (1, 1, 5, "Perfect delivery! Arrived hot and fast.", when), (2, 2, 4, None, when),
        (3, 3, 1, "Runner was very late and the pizza was cold.", when), (4, 4, 4, "Good service.", when),
        (5, 5, 5, "Best delivery experience ever! So friendly!", when), (6, 7, 3, None, None),
        (7, 8, 0, None, when), (8, 9, 6, None, when), (9, 10, None, None, when), (10, None, 3, None, when),
    ], "rating_id long, order_id long, rating int, review_text string, rating_time timestamp_ntz")
    out = ingest.ratings_ingest(df)
    got = {r["rating_id"]: (r["accepted"], r["reject_reason"]) for r in out.collect()}
    assert sorted(k for k, v in got.items() if v[0]) == [1, 2, 3, 4, 5, 6]
    assert got[7] == (False, "rating out of range") and got[8] == (False, "rating out of range")
    assert got[9] == (False, "rating missing") and got[10] == (False, "order_id missing")
    table = ingest.ratings_table(out)
    assert table.columns == list(ingest.RATING_COLUMNS)
    assert table.where("rating_id = 6").first()["rating_time"] is not None  # defaulted


WEEKLY_SCHEMA = "week_date string, region string, platform string, segment string, customer_type string, transactions long, sales long"


def weekly(spark):
    return spark.createDataFrame([
        ("31/8/20", "ASIA", "Retail", "C3", "New", 120, 3656163),
        ("31/08/20", "ASIA", "Retail", "F1", "New", 31574, 996575),
        ("15/06/98", "USA", "Shopify", "C1", "Guest", 3, 1005),
        ("15/06/98", "USA", "Shopify", "C2", "Guest", 7, 100),
        ("15/06/98", "USA", "Shopify", "F4", "Existing", 0, 100),
        ("1/1/21", "EUROPE", "Retail", "null", "Guest", 10, 1000),
        ("1/1/21", "EUROPE", "Retail", None, "Guest", 10, 1000),
    ], WEEKLY_SCHEMA)


def test_clean_weekly_sales(spark):
    out = clean.clean_weekly_sales(weekly(spark))
    assert len(out.columns) == 13
    got = rows(out, "week_date", "week_number", "calendar_year", "segment", "age_band", "demographic", "avg_transaction")
    assert (dt.date(2020, 8, 31), 36, 2020, "C3", "Retirees", "Couples", Decimal("30468.03")) in got
    assert (dt.date(2020, 8, 31), 36, 2020, "F1", "Young Adults", "Families", Decimal("31.56")) in got
    assert (dt.date(1998, 6, 15), 25, 1998, "C1", "Young Adults", "Couples", Decimal("335.00")) in got
    assert (dt.date(1998, 6, 15), 25, 1998, "C2", "Middle Aged", "Couples", Decimal("14.29")) in got
    assert (dt.date(1998, 6, 15), 25, 1998, "F4", "Retirees", "Families", None) in got  # 0 transactions
    assert got.count((dt.date(2021, 1, 1), 53, 2021, "Unknown", "Unknown", "Unknown", Decimal("100.00"))) == 2


def test_ordered_preview_is_a_total_order(spark):
    out = clean.clean_weekly_sales(weekly(spark))
    first = ingest.ordered_preview(out, ["week_date", "region", "platform", "segment", "customer_type", "transactions", "sales"], 3)
    assert [r["week_date"] for r in first.collect()] == [dt.date(1998, 6, 15)] * 3

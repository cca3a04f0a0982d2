"""Traps T5, T6, T7, T9, T10, T12, T13, T14 on literal micro-frames."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerline.functions import as_reported, day_name, parse_day_month_yy, round_ratio, split_ids, week_start
from ledgerline.operators.impact import _pct_text


def test_round_ratio_exact_half_away_from_zero(spark):
    df = spark.createDataFrame([(1005, 1000), (-7185, 1000), (5, 0), (None, 3), (7, 2), (2, 3), (-1, 3)], "n long, d long")
    out = [r[0] for r in df.select(round_ratio(F.col("n"), F.col("d"), 2)).collect()]
    assert out == [Decimal("1.01"), Decimal("-7.19"), None, None, Decimal("3.50"), Decimal("0.67"), Decimal("-0.33")]
    whole = [r[0] for r in df.select(round_ratio(F.col("n"), F.col("d"), 0)).collect()]
    assert whole == [Decimal("1"), Decimal("-7"), None, None, Decimal("4"), Decimal("1"), Decimal("0")]


def test_round_ratio_large_values_do_not_overflow(spark):
    df = spark.createDataFrame([(10 ** 17 + 5, 10)], "n long, d long")
    assert df.select(round_ratio(F.col("n"), F.col("d"), 2)).first()[0] == Decimal("10000000000000000.50")


def test_as_reported_types(spark):
    df = spark.createDataFrame([(Decimal("1.50"), Decimal("3"), 4)], "a decimal(10,2), b decimal(10,0), c int")
    out = as_reported(df)
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["double", "bigint", "bigint"]


def test_two_digit_years_and_one_digit_days(spark):
    df = spark.createDataFrame([("15/06/98",), ("31/8/20",), ("31/08/20",), ("1/1/01",), ("15/06/69",)], "s string")
    got = [r[0] for r in df.select(parse_day_month_yy(F.col("s"))).collect()]
    assert got == [dt.date(1998, 6, 15), dt.date(2020, 8, 31), dt.date(2020, 8, 31), dt.date(2001, 1, 1), dt.date(2069, 6, 15)]


def test_iso_week_53_keeps_calendar_year(spark):
    df = spark.createDataFrame([(dt.date(2021, 1, 1),)], "d date")
    r = df.select(F.weekofyear("d"), F.year("d")).first()
    assert (r[0], r[1]) == (53, 2021)


def test_day_names_plain_and_padded(spark):
    df = spark.createDataFrame([(dt.date(1998, 6, 15),), (dt.date(1998, 6, 17),)], "d date")
    assert [r[0] for r in df.select(day_name(F.col("d"))).collect()] == ["Monday", "Wednesday"]
    assert [r[0] for r in df.select(day_name(F.col("d"), padded=True)).collect()] == ["Monday   ", "Wednesday"]


def test_week_start_monday_and_anchor(spark):
    df = spark.createDataFrame([(dt.date(2021, 1, 1),), (dt.date(2021, 1, 8),), (dt.date(2021, 1, 10),)], "d date")
    monday = [r[0] for r in df.select(week_start(F.col("d"))).collect()]
    assert monday == [dt.datetime(2020, 12, 28), dt.datetime(2021, 1, 4), dt.datetime(2021, 1, 4)]
    anchored = [r[0] for r in df.select(week_start(F.col("d"), "2021-01-01")).collect()]
    assert anchored == [dt.datetime(2021, 1, 1), dt.datetime(2021, 1, 8), dt.datetime(2021, 1, 8)]


def test_pct_text_keeps_percent_sign_on_null(spark):
    df = spark.createDataFrame([(110, 100), (5, 0), (97, 100)], "a long, b long")
    got = [r[0] for r in df.select(_pct_text(F.col("a"), F.col("b"))).collect()]
    assert got == ["10.00%", "%", "-3.00%"]


def test_split_ids_and_bytewise_order(spark):
    df = spark.createDataFrame([("2, 6",), ("4",), (None,)], "s string")
    assert [r[0] for r in df.select(split_ids(F.col("s"))).collect()] == [[2, 6], [4], None]
    names = spark.createDataFrame([("Beef",), ("Bacon",), ("BBQ Sauce",)], "n string")
    assert names.agg(F.array_join(F.array_sort(F.collect_list("n")), ", ")).first()[0] == "BBQ Sauce, Bacon, Beef"


def test_round_ratio_matches_exact_decimal_rounding(spark):
    from decimal import ROUND_HALF_UP, localcontext

    from hypothesis import given, settings
    from hypothesis import strategies as st

    pairs = []

    @settings(max_examples=300, deadline=None)
    @given(st.integers(-10 ** 15, 10 ** 15), st.integers(-10 ** 6, 10 ** 6).filter(lambda d: d != 0),
           st.integers(0, 4))
    def collect(n, d, scale):
        pairs.append((n, d, scale))

    collect()
    df = spark.createDataFrame(pairs, "n long, d long, s int")
    got = {}
    for scale in range(5):
        part = df.where(F.col("s") == scale).select("n", "d", round_ratio(F.col("n"), F.col("d"), scale).alias("r"))
        got.update({(r["n"], r["d"], scale): r["r"] for r in part.collect()})
    with localcontext() as ctx:
        ctx.prec = 60
        for n, d, scale in pairs:
            want = (Decimal(n) / Decimal(d)).quantize(Decimal(1).scaleb(-scale), rounding=ROUND_HALF_UP)
            assert got[(n, d, scale)] == want, (n, d, scale)

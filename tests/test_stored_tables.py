"""Declared tables, key-checked and repeatable inserts, bucketed tables, stored order, table-wide numbers, collations, ISO years."""

import datetime as dt
import glob
import os
import re
import uuid
from decimal import Decimal

import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ledgerline.functions.numeric import round_ratio
from ledgerline.operators import clean, delivery, impact, ingest, loyalty
from ledgerline.operators.rank import number_rows
from ledgerline.plans import stored
from ledgerline.plans.registry import Inputs, build, store_in_order
from ledgerline.session import checkpoint_dir
from ledgerline.sources import declared
from ledgerline.sources.declared import Declared, Field
from ledgerline.sources.sinks import insert_batch
from ledgerline.streaming.ratings import ratings_at, start_ratings_ingest
from tests.conftest import SF_SMALL, rows

RAW = "rating_id long, order_id long, rating int, review_text string"


def ratings(spark, tmp_path):
    table = Declared(f"t_{uuid.uuid4().hex}", ingest.RATINGS.fields, ingest.RATINGS.key, 4)
    declared.create(spark, table, str(tmp_path / "stored"), str(tmp_path / "rejects"))
    return table


def state(spark, table):
    return (rows(spark.table(table.name), "rating_id", "order_id", "rating", "batch_id"),
            rows(spark.table(table.rejects), "rating_id", "reject_reason", "batch_id"))


def test_key_holds_over_batches_and_replays_change_nothing(spark, tmp_path):
    table = ratings(spark, tmp_path)
    first = spark.createDataFrame([(1, 10, 5, "a"), (2, 11, 9, "b"), (3, 12, 1, None), (3, 13, 2, None), (None, 14, 3, "x"), (4, None, 3, "y"), (5, 15, None, "z")], RAW)
    second = spark.createDataFrame([(1, 20, 4, "again"), (2, 11, 4, "now in range"), (6, 16, 2, "c"), (3, 12, 1, "once")], RAW)
    declared.insert(first, table, 0)
    declared.insert(second, table, 1)
    wanted = state(spark, table)
    assert wanted[0] == sorted([(1, 10, 5, 0), (2, 11, 4, 1), (3, 12, 1, 1), (6, 16, 2, 1)], key=repr)
    assert dict(((i, n), r) for i, r, n in wanted[1]) == {
        (2, 0): "rating out of range", (3, 0): "rating_id duplicated", (None, 0): "rating_id missing", (4, 0): "order_id missing",
        (5, 0): "rating missing", (1, 1): "rating_id stored"}
    assert len(wanted[1]) == 7
    for batch, number in ((second, 1), (first, 0), (second, 1)):
        declared.insert(batch, table, number)
        assert state(spark, table) == wanted
    mended = spark.createDataFrame([(1, 10, 5, "a"), (2, 11, 3, "mended")], RAW)
    declared.insert(mended, table, 0)  # id 2 is stored by batch 1 by now
    assert [r for r in state(spark, table)[1] if r[2] == 0] == [(2, "rating_id stored later", 0)]
    declared.insert(second.limit(0), table, 1)  # a batch that is replaced by an empty one leaves nothing behind
    assert {r[3] for r in state(spark, table)[0]} == {0} and {r[2] for r in state(spark, table)[1]} == {0}


def test_defaults_and_types(spark, tmp_path):
    table = ratings(spark, tmp_path)
    declared.insert(spark.createDataFrame([(1, 10, 5, "a")], RAW), table, 0)
    stored_row = spark.table(table.name).first()
    assert abs((stored_row.rating_time - dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)).total_seconds()) < 86_400
    given = spark.createDataFrame([(2, 10, 5, "a", None)], RAW + ", rating_time timestamp_ntz")
    declared.insert(given, table, 1)
    assert spark.table(table.name).where("rating_id = 2").first().rating_time is None
    before = state(spark, table)
    with pytest.raises(AnalysisException):
        declared.insert(spark.createDataFrame([("x", 10, 5, "a")], RAW.replace("rating_id long", "rating_id string")), table, 2)
    with pytest.raises(ValueError, match="no column other"):
        declared.insert(spark.createDataFrame([(3, 10, 5, "a")], RAW).withColumn("other", F.lit(1)), table, 2)
    with pytest.raises(ValueError, match="needs order_id"):
        declared.insert(spark.createDataFrame([(3, 10, 5, "a")], RAW).drop("order_id"), table, 2)
    assert state(spark, table) == before
    wide = spark.createDataFrame([(7, 10, 5, "a")], RAW.replace("rating int", "rating long"))
    declared.insert(wide, table, 3)  # a number that fits is taken
    assert dict(spark.table(table.name).dtypes)["rating"] == "int"


def test_key_check_reads_the_stored_side_as_it_lies(spark, tmp_path):
    table = ratings(spark, tmp_path)
    declared.insert(spark.range(200).select(F.col("id").alias("rating_id"), F.col("id").alias("order_id"), F.lit(3).alias("rating")), table, 0)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = declared.checked(spark.createDataFrame([(5, 1, 1, "a")], RAW), table, 1)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    scan = plan[plan.index("FileScan parquet"):]
    assert "Bucketed: true" in scan and "ReadSchema: struct<rating_id:bigint>" in scan
    assert plan.count("Exchange hashpartitioning") <= 2  # the batch, and its count by key; none for the stored side


def test_stream_checks_the_key_across_batches_and_restarts(spark, tmp_path):
    src, table_dir, rejects_dir, ck = (str(tmp_path / n) for n in ("in", "table", "rejects", "ck"))
    schema = RAW + ", rating_time timestamp_ntz"

    def arrive(name, values):
        spark.createDataFrame([(*v, None) for v in values], schema).coalesce(1).write.parquet(f"{src}/{name}")

    def run():
        start_ratings_ingest(spark, src + "/*", table_dir, rejects_dir, ck, available_now=True, max_files_per_trigger=1).awaitTermination()

    arrive("a", [(1, 10, 5, "a"), (2, 11, 3, "b")])
    run()
    arrive("b", [(2, 11, 4, "sent twice"), (3, 12, 2, "c")])
    run()
    table = ratings_at(spark, table_dir, rejects_dir)
    wanted = state(spark, table)
    assert [r[0] for r in wanted[0]] == [1, 2, 3] and [(r[0], r[1]) for r in wanted[1]] == [(2, "rating_id stored")]
    # the run is lost after the batch was written and before its progress was: the last commit goes, the batch comes again
    last = max(glob.glob(f"{ck}/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
    os.remove(last)
    for crc in glob.glob(f"{ck}/commits/.{os.path.basename(last)}.crc"):
        os.remove(crc)
    # and in a new session the tables are known by their folders only
    spark.sql(f"DROP TABLE {table.name}")
    spark.sql(f"DROP TABLE {table.rejects}")
    run()
    assert state(spark, ratings_at(spark, table_dir, rejects_dir)) == wanted


def test_insert_batch_may_be_repeated(spark, tmp_path):
    path = str(tmp_path / "t")
    for number in (0, 1, 1, 0):
        insert_batch(spark.range(number, number + 3).toDF("x"), path, number)
    assert rows(spark.read.parquet(path), "x", "batch_id") == [(0, 0), (1, 0), (1, 1), (2, 0), (2, 1), (3, 1)]


def test_bucketed_facts_join_without_a_shuffle(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sales = stored.bucketed_sales(spark, SF_SMALL, 4)
        plan = sales._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan and plan.count("Bucketed: true") == 2
        assert sales.exceptAll(Inputs(spark, SF_SMALL).sales).isEmpty() and sales.count() == Inputs(spark, SF_SMALL).sales.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_table_wide_numbers(spark):
    df = spark.range(2000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50).alias("a"), F.when(F.col("id") % 4 == 0, None).otherwise(F.lit("x")).alias("b"))
    out = number_rows(df, ["a"], "n", partitions=5, chunk=16)
    got = sorted(tuple(r) for r in out.select("n", "a", "b").collect())
    assert [r[0] for r in got] == list(range(1, 2001))
    assert [r[1:] for r in got] == sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0], r[1] is not None, r[1] or ""))
    assert sorted(tuple(r) for r in out.select("n", "a", "b").collect()) == got  # the saved layout is read again
    assert number_rows(df.limit(0), ["a"], "n").collect() == []
    plan = out._jdf.queryExecution().executedPlan().toString()
    # the only step in one task adds up the ranges' totals, which are as many as the partitions
    single = [m.start() for m in re.finditer("SinglePartition", plan)]
    assert len(single) == 1 and "_total" in plan[plan.rindex("\n", 0, single[0]) : plan.index("\n", plan.index("\n", single[0]) + 1)]


def test_stored_order_by_a_column_that_is_not_kept(spark, tmp_path):
    path = str(tmp_path / "labels")
    store_in_order("order_item_label", spark, SF_SMALL, path, 6)
    files = sorted(glob.glob(f"{path}/part-*.parquet"))
    assert len(files) > 1
    got = [tuple(r.values()) for f in files for r in pq.ParquetFile(f).read().to_pylist()]
    wanted = [tuple(r) for r in build("order_item_label", spark, SF_SMALL, ordered=True).collect()]
    assert [r[0] for r in got] == sorted(r[0] for r in got)
    assert got == wanted and list(build("order_item_label", spark, SF_SMALL, ordered=True).columns) == ["order_id", "pizza_id", "order_item"]


def test_collations(spark):
    toppings = spark.createDataFrame([(1, "éclair"), (2, "Zest"), (3, "apple"), (4, "Apple"), (5, "banana")], "topping_id int, topping_name string")
    names = spark.createDataFrame([(1, "Mix")], "pizza_id int, pizza_name string")
    bridge = spark.createDataFrame([(1, k) for k in range(1, 6)], "pizza_id int, topping_id int")
    listed = {c: delivery.standard_ingredients(bridge, names, toppings, collation=c).first()[1] for c in (None, "UNICODE", "UNICODE_CI")}
    assert listed == {None: "Apple, Zest, apple, banana, éclair", "UNICODE": "apple, Apple, banana, éclair, Zest", "UNICODE_CI": "Apple, apple, banana, éclair, Zest"}
    lines = spark.createDataFrame([(1, "3, 4"), (2, "3, 4"), (3, "5"), (4, "5"), (5, "5")], "order_id long, extras string")
    assert tuple(delivery.top_extra(lines, toppings).first()) == ("banana", 3)
    assert tuple(delivery.top_extra(lines, toppings, collation="UNICODE_CI").first()) == ("Apple", 4)
    sales = spark.createDataFrame([(1, dt.date(2021, 1, 1), k) for k in (1, 2, 3)], "customer_id long, order_date date, product_id long")
    menu = toppings.selectExpr("topping_id product_id", "topping_name product_name", "CAST(1 AS DECIMAL(12,2)) price")
    assert loyalty.first_item_by_customer(sales, menu).first().product_name == "Zest"
    assert loyalty.first_item_by_customer(sales, menu, collation="UNICODE").first().product_name == "apple"
    plain = [r.customer_id for r in build("total_spend_by_customer", spark, SF_SMALL, ordered=True, collation="UNICODE").collect()]
    assert plain == sorted(plain)
    by_name = [r.topping_name for r in build("ingredient_usage_delivered", spark, SF_SMALL, ordered=True, collation="UNICODE_CI").collect()]
    assert len(by_name) == 25


def test_iso_years(spark):
    dates = ["28/12/20", "31/12/20", "01/01/21", "03/01/21", "04/01/21", "30/12/19", "01/01/17"]
    raw = spark.createDataFrame([(d, "EUROPE", "Retail", "C1", "New", 1, 100) for d in dates], "week_date string, region string, platform string, segment string, customer_type string, transactions long, sales long")
    got = {r.week_date.isoformat(): (r.calendar_year, r.week_number) for r in clean.clean_weekly_sales(raw, iso_year=True).collect()}
    assert got == {d.isoformat(): d.isocalendar()[:2] for d in (dt.datetime.strptime(x, "%d/%m/%y").date() for x in dates)}
    plain = {r.week_date.isoformat(): r.calendar_year for r in clean.clean_weekly_sales(raw).collect()}
    assert plain["2021-01-01"] == 2021 and plain["2019-12-30"] == 2019
    # sales of week 53 of 2020 stay with 2020 in the year's figures
    by_year = {r.calendar_year: r for r in impact.impact_by_year(clean.clean_weekly_sales(raw, iso_year=True), ((53, 53), (53, 53)), ((1, 52), (53, 53))).collect()}
    assert by_year[2020].pct_change_12wk == "300.00%"


def test_distances_that_the_type_cannot_hold_are_rejected(spark):
    texts = ["23.4 km", "20km", "23.456789012345km", "0.00000000004km", "1.50000000000000km", "0.0000000001", "1e-20", "2e1", "null", "x"]
    got = clean.clean_distance(spark.createDataFrame([(t,) for t in texts], "distance string").withColumn("raw", F.col("distance")), rejects="rejected").collect()
    assert {r.raw: r.distance for r in got} == {
        "23.4 km": Decimal("23.4"), "20km": Decimal(20), "23.456789012345km": None, "0.00000000004km": None, "1.50000000000000km": Decimal("1.5"),
        "0.0000000001": Decimal("0.0000000001"), "1e-20": None, "2e1": Decimal(20), "null": None, "x": None}
    assert {r.rejected for r in got} - {None} == {"23.456789012345km", "0.00000000004km", "1e-20", "x"}


def test_ratios_by_both_ways_are_exact(spark):
    """Ties and values next to them, on the fast path and beyond it, against Decimal arithmetic; operands occur few times in the plan."""
    import decimal

    decimal.getcontext().prec = 80
    values = [(n, d) for n in ("0.005", "-0.005", "0.0049999999", "1.0050000000", "2.675", "12345678901234.565", "99999999999999999.995", "0", "7") for d in (1, 2, 3, -7, 999_999_999, 2_000_000_001, 0)]
    df = spark.createDataFrame([(Decimal(n), d) for n, d in values], "n decimal(28,10), d long")
    for scale in (0, 2):
        got = [r[0] for r in df.select(round_ratio(F.col("n"), F.col("d"), scale, 10)).collect()]
        wanted = [None if not d else (Decimal(n) / d).quantize(Decimal(1).scaleb(-scale), decimal.ROUND_HALF_UP) for n, d in values]
        assert got == wanted
    plan = df.select(round_ratio(F.col("n"), F.col("d"), 2, 10).alias("r"))._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"\bn#", plan)) <= 9 and plan.count("raise_error") == 1


def test_no_local_folder_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="shared folder"):
        checkpoint_dir(Session(), local_fallback=True)


def test_checks_of_a_declared_table(spark, tmp_path):
    table = Declared(f"t_{uuid.uuid4().hex}", (Field("a", "INT"), Field("b", "INT"), Field("c", "STRING", check="c <> ''", reason="empty")), ("a", "b"), 2)
    declared.create(spark, table, str(tmp_path / "x"), str(tmp_path / "y"))
    declared.insert(spark.createDataFrame([(1, 1, "x"), (1, 2, ""), (1, None, "x"), (2, 1, None), (3, 3, "p"), (3, 3, "q")], "a int, b int, c string"), table, 5)
    assert rows(spark.table(table.name), "a", "b", "c") == [(1, 1, "x"), (2, 1, None)]
    assert sorted(r.reject_reason for r in spark.table(table.rejects).collect()) == ["a, b duplicated", "a, b duplicated", "b missing", "c empty"]

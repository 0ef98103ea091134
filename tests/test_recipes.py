"""Recipes on small hand-made frames with known answers."""

import datetime as dt
from decimal import Decimal as M

import pytest
from pyspark.sql import functions as F

from tillroll.constants import DAY_PARTS
from tillroll.functions.labels import time_of_day
from tillroll.operators import windows
from tillroll.plans import cohorts, inventory, operations, products, sales, staffing, trends

DAY = lambda i: dt.date(2025, 7, i)


def sales_frame(spark, rows):
    """(transaction, 'YYYY-MM-DD HH:MM:SS', drink, price, total) -> line grain."""
    df = spark.createDataFrame(
        [(t, ts, c, M(str(p)), M(str(x))) for t, ts, c, p, x in rows],
        "transaction_id string, ts string, coffee_name string, drink_price decimal(10,2), total_cost decimal(10,2)",
    )
    ts = F.col("ts").cast("timestamp_ntz")
    return df.select(
        "transaction_id", "coffee_name", "drink_price", "total_cost", ts.alias("sale_ts"), ts.cast("date").alias("sale_date"),
        (F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)).alias("second_of_day"), time_of_day(ts).alias("time_of_day"),
        (F.weekday(ts.cast("date")) >= 5).alias("is_weekend"), F.date_format(ts.cast("date"), "EEEE").alias("day_name"),
    )


@pytest.fixture
def shop(spark):
    return sales_frame(spark, [
        ("A", "2025-07-01 09:00:00", "Latte", 340, 660), ("A", "2025-07-01 09:00:00", "Cappuccino", 320, 660),
        ("B", "2025-07-01 13:59:59", "Latte", 340, 340),
        ("C", "2025-07-03 17:30:00", "Espresso", 230, 230),
        ("D", "2025-07-05 12:00:00", "Latte", 340, 340),
    ])


def test_receipt_totals_are_not_doubled(shop):
    assert tuple(sales.business_totals(shop).first()) == (4, M(1570), 392.5)
    assert sales.avg_items_per_order(shop).first()[0] == 1.25


def test_basket_size_counts_orders_without_a_total(spark):
    lines = sales_frame(spark, [
        ("A", "2025-07-01 09:00:00", "Latte", 340, 340), ("B", "2025-07-01 09:10:00", "Latte", 340, -1),
        ("C", "2025-07-01 09:20:00", "Latte", 340, -1), ("C", "2025-07-01 09:20:00", "Latte", 340, -1),
    ]).withColumn("total_cost", F.expr("nullif(total_cost, -1)"))
    got = [(r.n_items, r.orders_count, r.percent, r.cumulative_percent) for r in sales.order_size_distribution(lines).collect()]
    assert got == [(1, 2, 66.67, 66.67), (2, 1, 33.33, 100.0)]
    assert [r.median_check for r in sales.basket_size(lines).collect()] == [340.0, None]


def test_empty_input(spark, shop):
    nothing = shop.limit(0)
    assert tuple(sales.business_totals(nothing).first()) == (0, None, None)
    assert trends.daily_revenue_change(nothing).count() == 0
    assert products.abc_classes(nothing).count() == 0
    assert sales.check_distribution(nothing).first().median is None


def test_growth_and_gaps(spark):
    shop = sales_frame(spark, [("A", "2025-07-01 09:00:00", "x", 0, 0), ("B", "2025-07-02 09:00:00", "x", 50, 50), ("C", "2025-07-05 09:00:00", "x", 75, 75)])
    got = [tuple(r) for r in trends.daily_revenue_change(shop).collect()]
    assert got == [(DAY(1), M(0), None, None), (DAY(2), M(50), M(0), None), (DAY(5), M(75), M(50), 50.0)]
    by_row = [r.rolling_mean_7d for r in trends.rolling_revenue(shop, window=2).collect()]
    assert by_row == [0.0, 25.0, 62.5]
    by_day = trends.rolling_revenue(shop, window=2, fill_calendar=True).collect()
    assert [(r.sale_date.day, r.rolling_mean_7d) for r in by_day] == [(1, 0.0), (2, 25.0), (3, 25.0), (4, 0.0), (5, 37.5)]
    assert [r.rolling_mean_7d for r in trends.rolling_revenue(shop, window=3, min_periods=3).collect()][:2] == [None, None]


def test_weekday_growth_crosses_the_year(spark):
    shop = sales_frame(spark, [("A", "2024-12-23 09:00:00", "x", 10, 10), ("B", "2024-12-30 09:00:00", "x", 20, 20), ("C", "2025-01-06 09:00:00", "x", 15, 15)])
    got = [tuple(r) for r in trends.same_weekday_growth(shop).collect()]
    assert [(r[1], r[4]) for r in got] == [("2024-12-23", None), ("2024-12-30", 100.0), ("2025-01-06", -25.0)]
    assert trends.same_weekday_growth(shop, "Mon").collect()[0].week_start == "2024-12-23"


def test_equal_revenues_share_a_cumulative_step(spark):
    rows = [("A", "2025-07-01 09:00:00", c, p, 0) for c, p in [("a", 50), ("b", 20), ("c", 20), ("d", 10), ("e", 0)]]
    got = {r.coffee_name: (r.cumulative_share, r.abc_class) for r in products.abc_classes(sales_frame(spark, rows)).collect()}
    assert got == {"a": (0.5, "A"), "b": (0.9, "B"), "c": (0.9, "B"), "d": (1.0, "C")}


def test_top_rank_keeps_ties(spark):
    rows = [("A", "2025-07-01 09:00:00", c, p, 0) for c, p in [("a", 9), ("b", 5), ("c", 5), ("d", 1)]]
    got = {r.category for r in sales.top_revenue_share(sales_frame(spark, rows), k=2).collect()}
    assert got == {"a", "b", "c", "other"}


def test_segments_and_day_parts(shop):
    got = {r.real_segment: r.total_revenue for r in staffing.revenue_per_hour_segments(shop).collect()}
    assert got == {"1. Lunch_Rush (11–14)": M(340), "3. Evening_Peak (17–20)": M(230)}
    parts = sales.by_time_of_day(shop, fill_missing=True).collect()
    assert [r.time_of_day for r in parts] == DAY_PARTS and parts[3].total_orders == 0
    gap = {r.time_of_day: (r.gap_to_evening_rub, r.gap_to_evening_pct) for r in staffing.afternoon_vs_evening_gap(shop).collect()}
    assert gap == {"Afternoon": (-110.0, -47.8), "Evening": (None, None)}


def test_both_morning_forms_agree(shop):
    assert [tuple(r) for r in staffing.morning_daily(shop).collect()] == [(DAY(1), 1, M(660), 660.0)]


def test_receipt_at_two_times_is_one_check(spark):
    shop = sales_frame(spark, [("A", "2025-07-01 12:00:00", "x", 10, 30), ("A", "2025-07-01 12:05:00", "y", 20, 30)])
    got = staffing.segments_by_weekday(shop).first()
    assert (got.total_checks, got.total_revenue) == (1, M(60))


def test_outliers_list_their_items(spark):
    rows = [(f"T{i}", "2025-07-01 09:00:00", "x", 10, 10) for i in range(9)]
    rows += [("BIG", "2025-07-01 09:00:00", c, 30, 90) for c in ("b", "a", "b")]
    got = sales.outlier_receipts(sales_frame(spark, rows)).collect()
    assert [(r.transaction_id, r.items_list, r.items_count) for r in got] == [("BIG", "a, b, b", 3)]


def test_margin_example(spark):
    goods = spark.createDataFrame([(1, "Espresso", 8), (2, "Latte", 18), (3, "Cappuccino", 17), (4, "Brownie", 35)], "product_id int, name string, cost int")
    sold = spark.createDataFrame([(101, 1, 2, 240), (102, 2, 5, 1250), (103, 3, 3, 690), (104, 4, 4, 800)], "sale_id int, product_id int, quantity int, total_amount int")
    got = [(r.name, r.profit, r.margin_pct) for r in products.product_margin(sold, goods).collect()]
    assert got == [("Latte", 1160, 92.8), ("Brownie", 660, 82.5), ("Cappuccino", 639, 92.61), ("Espresso", 224, 93.33)]


def test_reorder_example(spark):
    stats = spark.createDataFrame([(1, 18.0, 3.72), (2, 13.0, 4.0)], "product_id int, rolling_avg double, rolling_std double")
    first, second = inventory.stock_targets(stats, 7, F.lit(1.65)).orderBy("product_id").collect()
    assert (first.reorder_point, round(first.safety_stock), round(first.upper_band)) == (126.0, 16, 142)
    assert (second.reorder_point, round(second.safety_stock, 1)) == (91.0, 17.5)


def test_reorder_needs_enough_days(spark):
    rows = [(1, dt.datetime(2025, 7, i), M(10 + i % 2)) for i in range(1, 9)]
    sold = spark.createDataFrame(rows, "product_id int, sale_date timestamp_ntz, quantity decimal(10,2)")
    got = inventory.reorder_point(sold).orderBy("sale_date").collect()
    assert [r.rolling_avg is None for r in got] == [True] * 6 + [False] * 2
    assert all(r.std_no_min is None for r in inventory.demand_volatility(sold).collect())
    stock = spark.createDataFrame([(1, 70, "Хиты продаж"), (2, 5, "Сезонные товары")], "product_id int, stock int, service_class string")
    signal = {r.product_id: r.reorder_flag for r in inventory.reorder_signal(sold, stock).collect()}
    assert signal == {1: True, 2: False}


def test_falling_demand(spark):
    rows = [(1, dt.datetime(2025, 7, i, 12), M(q)) for i, q in [(1, 10), (2, 12), (3, 4), (4, 6)]]
    sold = spark.createDataFrame(rows + [(1, dt.datetime(2025, 1, 1), M(99))], "product_id int, sale_date timestamp_ntz, quantity decimal(10,2)")
    goods = spark.createDataFrame([(1, "Model_1", "Clothing")], "product_id int, model_name string, category string")
    got = inventory.falling_demand(sold, goods, as_of="2025-07-05").collect()
    assert [(r.sale_date, r.daily_sales, r["diff"], r.moving_avg_7d) for r in got] == [(DAY(3), M(4), M(-8), 8.67)]


def test_stock_entries_repeat_a_sale(spark):
    sold = spark.createDataFrame([(7, 1, dt.datetime(2025, 7, 1, 9, 5, 6), 2, 3)], "sale_id int, product_id int, sale_date timestamp_ntz, quantity int, customer_id int")
    goods = spark.createDataFrame([(1, "m", "c", M(5), M(9))], "product_id int, model_name string, category string, cost_price decimal(10,2), sale_price decimal(10,2)")
    log = spark.createDataFrame([(1, DAY(1), 4, "in"), (1, DAY(1), 2, "out"), (1, DAY(2), 1, "in")], "product_id int, date date, stock_on_hand int, operation_type string")
    got = inventory.sales_enriched(sold, goods, log, ordered=True).collect()
    assert sorted((r.sale_time, r.revenue, r.stock_on_hand) for r in got) == [("09:05:06", M(18), 2), ("09:05:06", M(18), 4)]


@pytest.mark.parametrize("apart", [False, True])
def test_sales_keep_their_stock_or_none(spark, apart):
    at = lambda d: dt.datetime(2025, 7, d, 9, 5, 6)
    rows = [(1, 1, at(1), 2, 3), (2, 1, at(1), 5, 3), (3, 1, at(3), 1, 4), (4, 1, None, 1, 4), (5, 2, at(1), 1, 4), (6, None, at(1), 1, 4), (7, 9, at(1), 1, 4)]
    sold = spark.createDataFrame(rows, "sale_id int, product_id int, sale_date timestamp_ntz, quantity int, customer_id int")
    goods = spark.createDataFrame([(i, f"m{i}", "c", M(5), M(9)) for i in (1, 2, 3)], "product_id int, model_name string, category string, cost_price decimal(10,2), sale_price decimal(10,2)")
    log = spark.createDataFrame([(1, DAY(1), 4, "in"), (1, DAY(2), 1, "in"), (1, None, 8, "in"), (2, DAY(1), None, "out")], "product_id int, date date, stock_on_hand int, operation_type string")
    days = sold.select("product_id", "sale_date").unionAll(sold.select(F.lit(3), "sale_date")) if apart else None
    got = inventory.sales_enriched(sold, goods, log, days=days).collect()
    assert sorted((r.sale_id, r.model_name, r.stock_on_hand, r.operation_type) for r in got) == [
        (1, "m1", 4, "in"), (2, "m1", 4, "in"), (3, "m1", None, None), (4, "m1", None, None), (5, "m2", None, "out")]
    dated = inventory.sales_enriched(sold.filter("sale_date is not null"), goods, log, days=days, undated=False).collect()
    assert sorted(map(str, dated)) == sorted(str(r) for r in got if r.sale_id != 4)


def test_inventory_gap(spark):
    catalog = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "sku int, item_name string")
    wms = spark.createDataFrame([(1, 5, M(10)), (3, 2, M(7))], "sku int, system_qty int, purchase_price decimal(10,2)")
    scans = spark.createDataFrame([(1, M(2)), (1, M(3)), (2, M(4))], "sku int, qty decimal(10,2)")
    got = {r.sku: (r.diff_qty, r.financial_impact_rub, r.status) for r in operations.inventory_gap(catalog, wms, scans).collect()}
    assert got == {1: (M(0), M(0), "OK"), 2: (M(4), M(0), "Излишек"), 3: (M(-2), M(-14), "Недостача")}


def test_return_rates_agree(spark):
    orders = spark.createDataFrame([("x", "returned", DAY(1)), ("x", "delivered", DAY(1)), ("x", "lost", DAY(1)), ("y", "in_transit", DAY(1))], "category string, status string, order_date date")
    assert {r.category: r.return_rate_percent for r in operations.return_rate(orders).collect()} == {"x": 33.33, "y": 0.0}
    assert {r.category: r.return_rate_percent for r in operations.return_rate_case(orders).collect()} == {"x": 50.0, "y": 0.0}
    assert operations.return_rate_case(orders, last_month=True, as_of="2025-09-01").count() == 0


def test_slow_stores_tie(spark):
    rows = []
    for store, slow in [(1, 3), (2, 3), (3, 2), (4, 1), (5, 0)]:
        rows += [(store, dt.datetime(2025, 7, 1, 10), dt.datetime(2025, 7, 1, 10, 10 + (1 if i < slow else 0))) for i in range(4)]
    rows += [(6, dt.datetime(2025, 7, 1, 10), dt.datetime(2025, 7, 1, 11))]
    orders = spark.createDataFrame(rows, "darkstore_id int, created_at timestamp_ntz, assembled_at timestamp_ntz")
    stores = spark.createDataFrame([(i, f"C{i}") for i in range(1, 7)], "darkstore_id int, city_name string")
    got = operations.slow_assembly(orders, stores, as_of="2025-07-02", min_orders=3, k=3).collect()
    assert [(r.darkstore_id, r.slow_pct, r.rnk) for r in got] == [(1, 75.0, 1), (2, 75.0, 1), (3, 50.0, 2), (4, 25.0, 3)]


def test_cohorts(spark):
    orders = spark.createDataFrame(
        [(1, dt.date(2025, 1, 5), 1, M(100), M(1)), (1, dt.date(2025, 2, 5), 1, M(50), M(1)), (2, dt.date(2025, 1, 9), 1, M(30), M(2)),
         (3, dt.date(2025, 1, 1), 9, M(80), M(1)), (3, dt.date(2025, 2, 1), 1, M(20), M(1))],
        "user_id int, order_date date, product_id int, amount decimal(10,2), quantity decimal(10,2)")
    goods = spark.createDataFrame([(1, M(10))], "id int, unit_cost decimal(10,2)")
    got = [tuple(r) for r in cohorts.cohort_ltv_margin(orders, goods).collect()]
    # user 3 joined in January by an unpriced order; margins are 100, then +50
    assert got == [(dt.date(2025, 1, 1), dt.date(2025, 1, 1), 33.33), (dt.date(2025, 1, 1), dt.date(2025, 2, 1), 50.0)]


def test_growth_truncation_option(spark):
    rows = []
    for week, n in [(1, 4), (8, 6), (15, 3)]:
        rows += [(f"{week}-{i}", f"2025-07-{week:02d} 09:00:00", "x", 1, 1) for i in range(n)]
    shop = sales_frame(spark, rows)
    exact = staffing.staffing_matrix(shop, "2025-07-01", "2025-10-01").first()
    whole = staffing.staffing_matrix(shop, "2025-07-01", "2025-10-01", integer_division=True).first()
    assert (exact.hour_label, exact.day_label, exact.avg_wow_growth_pct, whole.avg_wow_growth_pct) == ("09:00", "2. Tuesday", 0.0, 0.0)
    assert (exact.avg_receipts, exact.median_receipts, exact.p90_receipts, exact.pct_weeks_growing) == (4.5, 4.5, 5.7, 50.0)


@pytest.mark.parametrize("kind", ["bigint", "decimal(18,2)"])
def test_moving_stats_equal_frames(spark, kind):
    """Running sums against frames, with gaps, groups shorter than the window, and large numbers that vary little."""
    rows = spark.range(900).select(
        (F.col("id") % 7).alias("k"), F.col("id").alias("t"), F.expr(f"cast(if(id % 11 = 3, null, if(id % 7 = 6, 1000000000, 0) + id * 7919 % 101) as {kind})").alias("v")
    ).filter("k != 5 or t < 60")
    along = windows.series("t", ("k",))
    want = rows.withColumns({
        "m": windows.moving_average("v", along, 30, 7), "m0": windows.moving_average("v", along, 30, 0),
        "s": windows.moving_stddev("v", along, 30), "s7": windows.moving_stddev("v", along, 30, 7),
    })
    got = windows.with_moving_stats(rows, "v", "t", ("k",), 30, mean={"m": 7, "m0": 0}, std={"s": None, "s7": 7})
    assert got.columns == want.columns
    for a, b in zip(got.orderBy("t").collect(), want.orderBy("t").collect()):
        for x, y in zip(a, b):
            assert x == y or abs(float(x) - float(y)) <= 2e-5 * (1 if a.k == 6 else 0.1)
    assert "boundedpreceding$(), -" not in got._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(TypeError):
        windows.with_moving_stats(rows.withColumn("v", F.col("v").cast("double")), "v", "t", ("k",), 30)

import datetime as dt
from decimal import Decimal as M

import pytest
from pyspark.sql import functions as F

from tillroll.operators.calendar import date_dim
from tillroll.sources import files, schemas, tables
from tillroll.plans import inventory


def test_csv_scan(spark, tmp_path):
    path = tmp_path / "shop.csv"
    path.write_text(
        "transaction_id,customer_id,sale_date,sale_time,day_of_week,day_name,is_weekend,coffee_name,drink_price,total_cost,payment_method,datetime\n"
        'TX_1,C1,2025-07-01,09:00:00,2,Tuesday,False,"Latte (with ""add"", caramel)",440.00,440.00,card,2025-07-01 09:00:00\n',
        encoding="utf-8",
    )
    row = tables.add_time_of_day(files.read_csv(spark, str(path), schemas.SALES_LINES_V1)).first()
    assert row.coffee_name == 'Latte (with "add", caramel)' and row.drink_price == M("440.00")
    assert (row.sale_date, row.datetime, row.time_of_day) == (dt.date(2025, 7, 1), dt.datetime(2025, 7, 1, 9), "Morning")
    assert row.is_weekend is False


def test_csv_separator_and_bad_rows(spark, tmp_path):
    path = tmp_path / "report.csv"
    path.write_text("product_id;date;stock_on_hand;operation_type\n3;2025-07-01;5;приход\n", encoding="utf-8")
    assert tuple(files.read_csv(spark, str(path), schemas.INVENTORY_LOG, sep=";").first()) == (3, dt.date(2025, 7, 1), 5, "приход")
    path.write_text("product_id;date;stock_on_hand;operation_type\nx;2025-07-01;5;in\n", encoding="utf-8")
    with pytest.raises(Exception):
        files.read_csv(spark, str(path), schemas.INVENTORY_LOG, sep=";").collect()


def test_csv_sink_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b", 'say "x"', dt.date(2025, 7, 1)), (2, None, "", dt.date(2025, 7, 2))], "n long, s string, q string, d date")
    path = files.write_csv(df, str(tmp_path / "out"))
    back = files.read_csv(spark, path, df.schema).orderBy("n").collect()
    assert tuple(back[0]) == (1, "a,b", 'say "x"', dt.date(2025, 7, 1)) and back[1].s is None


def test_export_job(spark, tmp_path):
    rows = [(1, dt.datetime(2025, 7, i, 12), M(q)) for i, q in [(1, 10), (2, 12), (3, 4)]]
    sold = spark.createDataFrame(rows, "product_id long, sale_date timestamp_ntz, quantity decimal(10,2)")
    goods = spark.createDataFrame([(1, "m", "c")], "product_id long, model_name string, category string")
    path = inventory.export_falling_demand(sold, goods, str(tmp_path / "falling"), as_of="2025-07-05")
    got = files.read_csv(spark, path, schemas.FALLING_DEMAND).collect()
    assert [(r.product_id, r["diff"], r.moving_avg_7d) for r in got] == [(1, -8.0, 8.67)]


def test_tables(spark, tmp_path):
    tables.create_table(spark, "stock_log", schemas.INVENTORY_LOG)
    rows = spark.createDataFrame([("in", 4, dt.date(2025, 7, 1), 1)], "operation_type string, stock_on_hand int, date date, product_id long")
    tables.insert_into(rows, "stock_log")
    tables.insert_into(rows, "stock_log")
    assert spark.table("stock_log").count() == 2
    tables.insert_into(rows, "stock_log", overwrite=True)
    assert tuple(spark.table("stock_log").first()) == (1, dt.date(2025, 7, 1), 4, "in")
    path = tmp_path / "log.csv"
    path.write_text("product_id,date,stock_on_hand,operation_type\n2,2025-07-02,8,out\n")
    tables.load_csv_into(spark, str(path), "stock_log", schemas.INVENTORY_LOG)
    assert spark.table("stock_log").count() == 2
    tables.load_csv_into(spark, str(path), "stock_log", schemas.INVENTORY_LOG, mode="overwrite")
    assert spark.table("stock_log").count() == 1
    got = tables.run_query(spark, "SELECT product_id FROM {log} WHERE stock_on_hand > 5", log=spark.table("stock_log"))
    assert [r[0] for r in got.collect()] == [2]
    tables.drop(spark, "stock_log")
    tables.drop(spark, "stock_log")
    rows.createOrReplaceTempView("stock_view")
    tables.drop(spark, "stock_view")
    assert not spark.catalog.tableExists("stock_log") and not spark.catalog.tableExists("stock_view")


def test_partitioned_files_are_pruned(spark, tmp_path):
    df = spark.range(30).select(F.col("id").alias("x"), F.date_add(F.lit("2025-07-01").cast("date"), (F.col("id") % 3).cast("int")).alias("d"))
    path = files.write_parquet(df, str(tmp_path / "p"), partition_by=("d",))
    one = spark.read.parquet(path).filter(F.col("d") == "2025-07-02")
    assert one.count() == 10 and "PartitionFilters: [isnotnull(d" in one._jdf.queryExecution().executedPlan().toString()


def test_price_reference(spark):
    assert tables.drink_price_ref(spark).count() == 8
    weights = tables.dim_coffee(spark).agg(F.sum("base_weight")).first()[0]
    assert weights == pytest.approx(1.0)
    lines = spark.createDataFrame([("Espresso",), ("Latte (with add: caramel, peanut paste, halva)",)], "coffee_name string")
    assert {r.standard_price for r in tables.attach_price(lines, tables.drink_price_ref(spark)).collect()} == {230, None}


def test_date_dimension(spark):
    dim = date_dim(spark)
    assert dim.count() == 95328 and len(dim.columns) == 26
    row = dim.filter("date_key = 20241230").first()
    assert (row.week_number, row.day_of_week_iso, row.day_name, row.day_short_name) == (1, 1, "Monday", "Mon")
    assert (row.week_of_month, row.month_name, row.month_short_name, row.quarter_name) == (5, "December", "Dec", "Q4")
    assert (row.fiscal_year, row.decade, row.century, row.is_holiday) == (2025, 2020, 21, False)
    assert (row.first_day_of_quarter, row.last_day_of_quarter) == (dt.date(2024, 10, 1), dt.date(2024, 12, 31))
    sunday = dim.filter("date_key = 20240107").first()
    assert (sunday.day_of_week, sunday.day_of_week_iso, sunday.is_weekend) == (0, 7, True)
    assert dim.schema["date_key"].metadata["comment"].startswith("Unique key")

"""Physical plans: pushed filters, pruned columns, no pair-wise joins, no Python in the path."""

import re

import pytest
from plans import plan_of
from pyspark.sql import functions as F

from tillroll import registry
from tillroll.operators.receipts import dedup
from tillroll.plans import inventory, products, trends
from tillroll.sources import tables, views

QUERIES = {k: q for k, q in registry._queries().items() if k not in ("falling_demand_csv", "csv_dialect", "load_and_insert")}


@pytest.fixture
def no_broadcast(spark):
    """Plans as on a cluster, where no table is small."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", list(QUERIES))
def test_joins_are_equi_joins_and_code_stays_in_the_jvm(spark, folder, no_broadcast, name):
    plan = plan_of(QUERIES[name](spark, folder))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BroadcastExchange", "PythonUDF", "ArrowEvalPython"):
        assert bad not in plan


def test_global_windows_only_see_aggregates(spark, folder):
    """Below every single-partition exchange feeding a window there is an aggregate."""
    for name in QUERIES:
        if name == "limit_rows":  # its one partition holds at most the limit
            continue
        plan = plan_of(QUERIES[name](spark, folder)).split("\n")
        for i, line in enumerate(plan):
            if "Exchange SinglePartition" in line:
                below = "\n".join(plan[i:])
                assert "Aggregate(" in below, name


def scan_columns(plan, table):
    lines = [x for x in plan.split("\n") if f"/{table}.parquet" in x]
    return [set(re.findall(r"(\w+)#\d+", re.search(r"FileScan parquet \[(.*?)\]", x).group(1))) for x in lines]


def test_scans_read_only_needed_columns(spark, folder):
    plan = plan_of(QUERIES["daily_revenue_change"](spark, folder))
    assert scan_columns(plan, "lineitem") == [{"l_orderkey"}]
    assert scan_columns(plan, "orders") == [{"o_orderkey", "o_totalprice", "o_orderdate"}]
    plan = plan_of(QUERIES["drink_popularity"](spark, folder))
    assert scan_columns(plan, "lineitem") == [{"l_partkey", "l_extendedprice"}]


def test_filters_reach_the_scan(spark, folder):
    falling = plan_of(QUERIES["falling_demand"](spark, folder))
    assert "GreaterThanOrEqual(l_shipdate,2001-08-06T00:00)" in falling
    slow = plan_of(QUERIES["slow_assembly_top3"](spark, folder))
    assert "GreaterThanOrEqual(o_orderdate" in slow


def test_receipt_reports_shuffle_lines_once(spark, folder, no_broadcast):
    """Lines move once, already combined per receipt; the join and the receipt group reuse that."""
    plan = plan_of(QUERIES["business_totals"](spark, folder))
    assert plan.count("hashpartitioning(l_orderkey") == 1 and plan.count("hashpartitioning(o_orderkey") == 1
    assert plan.count("Exchange hashpartitioning") == 2
    assert re.search(r"hashpartitioning\(l_orderkey.*\n.*HashAggregate\(keys=\[l_orderkey", plan)


def test_bucketed_lines_need_no_shuffle(spark, folder, no_broadcast):
    raw = views.order_lines_raw(spark, folder)
    tables.write_bucketed(raw, "bucketed_lines", "transaction_id", 4)
    plan = plan_of(trends._receipt_days(spark.table("bucketed_lines")))
    tables.drop(spark, "bucketed_lines")
    assert "Exchange" not in plan


def test_lines_meet_products_and_stock_in_one_move(spark, folder, no_broadcast):
    """The recipe moves lines once, by product and day; product days are combined before they move."""
    rows = views.product_sales(spark, folder).withColumn("customer_id", F.lit(1))
    goods, log = views.products(spark, folder), views.inventory_log(spark, folder)
    plan = plan_of(inventory.sales_enriched(rows, goods, log))
    # the lines and what they meet, each by product and day
    assert len(re.findall(r"Exchange hashpartitioning\(.*isnull\(", plan)) == 2
    assert re.search(r"Exchange hashpartitioning\(product_id.*sale_date.*\n.*HashAggregate\(keys=\[product_id", plan)
    assert plan.count("SortMergeJoin") == 3


def test_lines_bucketed_by_product_and_day_need_no_shuffle(spark, folder, no_broadcast):
    raw = views.product_sales(spark, folder).withColumns({"customer_id": F.lit(1), "sale_date": F.col("sale_date").cast("date")})
    goods, log = views.products(spark, folder), views.inventory_log(spark, folder)
    tables.write_bucketed(raw, "bucketed_sales", ["product_id", "sale_date"], 4)
    lines = spark.table("bucketed_sales")
    moved = plan_of(inventory.sales_enriched(raw, goods, log, undated=False))
    plan = plan_of(inventory.sales_enriched(lines, goods, log, undated=False))
    tables.drop(spark, "bucketed_sales")
    # what is left moves products, stock entries and product days
    assert plan.count("Exchange hashpartitioning") == moved.count("Exchange hashpartitioning") - 2


def test_string_labels_do_not_force_a_sort(spark, folder):
    assert "SortAggregate" not in plan_of(QUERIES["by_day_name"](spark, folder))


def test_a_hot_key_is_combined_before_it_moves(spark):
    """A third of all lines in one receipt: every map task sends one row for it."""
    lines = spark.range(0, 60000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("transaction_id"),
        (F.col("id") % 7).cast("decimal(10,2)").alias("total_cost"),
        F.date_add(F.lit("2025-01-01").cast("date"), (F.col("id") % 50).cast("int")).alias("sale_date"),
    )
    days = trends.daily_revenue(lines)
    plan = plan_of(days)
    assert re.search(r"hashpartitioning\(transaction_id.*\n.*HashAggregate\(keys=\[transaction_id", plan)
    total = days.agg(F.sum("revenue")).first()[0]
    assert total == lines.groupBy("transaction_id").agg(F.max("total_cost").alias("m")).agg(F.sum("m")).first()[0]


def test_rows_of_a_hot_key_are_split_when_joined_to_their_aggregate(spark, no_broadcast):
    settings = {
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        lines = spark.range(0, 300000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000).alias("product_id"), F.rand(1).alias("quantity")
        )
        joined = products.product_totals_per_line(lines)
        execution = joined._jdf.queryExecution()
        assert execution.toRdd().count() == 300000
        assert "SortMergeJoin(skew=true)" in execution.executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", ["dedup_first_row", "dedup_last_row", "dedup_first_value", "audit_methods_agree"])
def test_first_and_last_rows_are_hash_aggregates(spark, folder, name):
    plan = plan_of(QUERIES[name](spark, folder))
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_row_number_dedup_is_limited_before_the_shuffle(spark, folder):
    lines = views.order_lines_raw(spark, folder)
    plan = plan_of(dedup(lines, "row_number", order=("sale_date",)))
    assert plan.count("WindowGroupLimit") == 2


def test_quantiles_move_few_rows(spark, folder):
    """Receipts once by key, then the sketch, the counts around the quantiles and their order; no sort of raw values."""
    df = QUERIES["check_distribution"](spark, folder)
    df.collect()
    plan = plan_of(df).split("\n")
    run = [b for a, b in zip(plan, plan[1:]) if "ShuffleQueryStage" in a and "ReusedExchange" not in b]
    assert len({re.search(r"plan_id=\d+", x).group() for x in run}) <= 4, run
    assert not any("SortAggregate" in x for x in plan)

"""Every recipe and operator as a named query over a folder of Parquet tables."""

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.constants import DAY_PARTS, WEEKDAY_SHARES, WEEKEND_SHARES, WEEKDAY_SEGMENTS
from tillroll.functions import dates as D
from tillroll.functions import labels as L
from tillroll.functions.numbers import MONEY, rounded
from tillroll.operators import allocate, calendar, pivots, prep, quality
from tillroll.operators.receipts import TOTAL, dedup
from tillroll.plans import cohorts, dashboards, inventory, operations, products, sales, staffing, trends
from tillroll.session import shared_dir
from tillroll.sources import files, schemas, tables, views

Query = Callable[[SparkSession, str], DataFrame]

# Report dates inside the data's own range.
SHIP_AS_OF = "2001-11-04"
ORDER_AS_OF = "2001-08-01"
EVENT_START, EVENT_END = "2024-01-01", "2024-01-31"
# Products with a column of their own in the weekly range; all others share one.
LISTED_TYPES = ["ECONOMY", "LARGE", "PROMO"]
# Price bands as (name, upper bound); the last is open.
PRICE_BANDS = [("low", 950), ("middle", 1000), ("high", 1050), ("top", None)]


def present(df: DataFrame) -> DataFrame:
    """Report types: decimals as double, dates as ISO text, small integers as bigint."""
    columns = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            col = col.cast("double")
        elif isinstance(field.dataType, (T.DateType, T.TimestampNTZType)):
            col = col.cast("string")
        elif isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            col = col.cast("bigint")
        columns.append(col.alias(field.name))
    return df.select(*columns)


def _on_lines(recipe, drink: str, /, **params) -> Query:
    return lambda spark, folder: recipe(views.sales_lines(spark, folder, drink), **params)


def _on_drinks(recipe, drink: str, /, **params) -> Query:
    return lambda spark, folder: recipe(views.product_lines(spark, folder, drink), **params)


def _on_receipts(recipe, **params) -> Query:
    return lambda spark, folder: recipe(views.sales_receipts(spark, folder), **params)


def _on_event_receipts(recipe, **params) -> Query:
    return lambda spark, folder: recipe(views.event_receipts(spark, folder), **params)


def _on_events(recipe, **params) -> Query:
    return lambda spark, folder: recipe(views.event_sales(spark, folder), **params)


def _on_raw(recipe, **params) -> Query:
    return lambda spark, folder: recipe(views.order_lines_raw(spark, folder), **params)


def _on_sales(recipe, **params) -> Query:
    return lambda spark, folder: recipe(views.product_sales(spark, folder), **params)


def _on_table(recipe, name: str, **params) -> Query:
    return lambda spark, folder: recipe(views.table(spark, folder, name), **params)


def _falling_demand(spark, folder):
    return inventory.falling_demand(
        views.product_sales(spark, folder), views.products(spark, folder), as_of=SHIP_AS_OF, days=90
    )


def _falling_demand_csv(spark, folder):
    path = f"{shared_dir(spark)}/falling-demand-{uuid.uuid4().hex}"
    inventory.export_falling_demand(
        views.product_sales(spark, folder), views.products(spark, folder), path, as_of=SHIP_AS_OF, days=90
    )
    return files.read_csv(spark, path, schemas.FALLING_DEMAND)


def _daily_lag(spark, folder):
    return products.product_daily_lag(
        views.sales_lines(spark, folder, "p_brand"), "Brand#7", receipts=views.sales_receipts(spark, folder)
    )


def _outliers(spark, folder):
    return sales.outlier_receipts(views.event_sales(spark, folder), heads=views.event_receipts(spark, folder))


def _outlier_items(spark, folder):
    heads = views.event_receipts(spark, folder)
    return sales.outlier_receipt_items(views.event_sales(spark, folder), heads=heads, per_piece=3)


def _price_histogram(spark, folder):
    prices = views.table(spark, folder, "lineitem").select(F.col("l_extendedprice").cast(MONEY).alias("drink_price"))
    return pivots.histogram(prices, "drink_price")


def _margin(spark, folder):
    sold = views.cost_orders(spark, folder).withColumnRenamed("amount", "total_amount")
    goods = views.cost_products(spark, folder).withColumnsRenamed({"id": "product_id", "unit_cost": "cost"})
    return products.product_margin(sold, goods)


def _sales_enriched(spark, folder):
    return inventory.sales_enriched(
        views.product_sales(spark, folder, customer=True), views.products(spark, folder), views.inventory_log(spark, folder),
        days=views.product_sales(spark, folder),
    )


def _inventory_gap(spark, folder):
    return operations.inventory_gap(
        views.sku_catalog(spark, folder), views.wms_inventory(spark, folder), views.scanner_scans(spark, folder)
    )


def _returns(recipe, **params) -> Query:
    return lambda spark, folder: recipe(views.return_orders(spark, folder), **params)


def _slow_assembly(spark, folder):
    return operations.slow_assembly(
        views.fulfilment(spark, folder), views.stores(spark, folder),
        as_of=ORDER_AS_OF, days=1500, minutes=500 * 1440, min_orders=50, k=3,
    )


def _reorder_signal(spark, folder):
    return inventory.reorder_signal(views.product_sales(spark, folder), views.stock_levels(spark, folder))


def _cohorts(spark, folder):
    return cohorts.cohort_ltv_margin(views.cost_orders(spark, folder), views.cost_products(spark, folder))


_LAST = {"columns": ("sale_date", TOTAL), "order": ("sale_date",)}


def _dedup_first_value(lines):
    late = lines.withColumn(TOTAL, F.when(F.col(TOTAL) >= 20000, F.col(TOTAL)))
    return dedup(late, "first_value", ("sale_date", TOTAL), order=("sale_date", TOTAL))


def _audit_same(lines):
    return quality.audit_methods(dedup(lines, "last_row", **_LAST), dedup(lines, "row_number", **_LAST), ("sale_date", TOTAL))


def _audit_differ(lines):
    return quality.audit_methods(dedup(lines, "row_number", **_LAST), dedup(lines, "max"), (TOTAL,))


def _constraints(spark, folder):
    events = views.table(spark, folder, "events").withColumn("hour", F.hour("ts"))
    return quality.constraint_violations(
        events, ["user_id", "hour"], ["user_id", "value"],
        {"hour 0..23": F.col("hour").between(0, 23), "value below 100": F.col("value") < 100},
    )


def _gaps(spark, folder) -> DataFrame:
    """Events whose value is unknown for errors."""
    events = views.table(spark, folder, "events").select("event_id", "user_id", "ts", "event_type", "value")
    return events.withColumns(
        {
            "kind": F.when(F.col("event_type") != "error", F.col("event_type")),
            "value": F.when(F.col("event_type") != "error", F.col("value").cast(MONEY)),
        }
    ).drop("event_type")


def _impute(strategy: str, column: str = "value") -> Query:
    def run(spark, folder):
        filled = prep.handle_missing(_gaps(spark, folder), strategy, [column])
        value = rounded(F.col(column).cast("double"), 4) if column == "value" else F.col(column)
        return filled.select("event_id", value.alias(column))

    return run


def _interpolate(spark, folder):
    filled = prep.handle_missing(_gaps(spark, folder), "interpolate", ["value"], order="event_id", by=("user_id",))
    return filled.select("event_id", "user_id", rounded(F.col("value"), 4).alias("value"))


def _interpolate_series(spark, folder):
    filled = prep.handle_missing(_gaps(spark, folder), "interpolate", ["value"], order=("ts", "event_id"))
    return filled.select("event_id", rounded(F.col("value"), 4).alias("value"))


def _distinct_rows(spark, folder):
    lines = views.table(spark, folder, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")
    return prep.remove_duplicates(lines)


def _winsorise(spark, folder):
    events = views.table(spark, folder, "events").select("event_id", F.col("value").cast(MONEY).alias("value"))
    return prep.handle_outliers(events, "value").withColumn("value", rounded(F.col("value"), 4))


def _onehot(spark, folder):
    return prep.encode_categorical(views.table(spark, folder, "part").select("p_partkey", "p_type"), ["p_type"], "onehot")


def _ordinal(spark, folder):
    return prep.encode_categorical(views.table(spark, folder, "part").select("p_partkey", "p_brand"), ["p_brand"], "ordinal")


def _ordinal_unseen(spark, folder):
    part = views.table(spark, folder, "part").select("p_partkey", "p_type", "p_size")
    seen = part.filter(F.col("p_type") != "PROMO")
    return prep.encode_categorical(part.drop("p_size"), ["p_type"], "ordinal", fit_on=seen)


def _scaled(spark, folder):
    customers = views.table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    return prep.standard_scale(customers, ["c_acctbal"]).withColumn("c_acctbal", rounded(F.col("c_acctbal"), 6))


def _preprocess(spark, folder):
    customers = views.table(spark, folder, "customer").select(
        "c_custkey",
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance"),
        F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment")).alias("segment"),
    )
    return prep.preprocess(customers, ["balance"], ["segment"]).withColumn("balance", rounded(F.col("balance"), 6))


def _time_columns(spark, folder):
    ts = F.col("ts")
    return views.table(spark, folder, "events").select(
        "event_id",
        F.month(ts).alias("month"),
        F.hour(ts).alias("hour"),
        ts.cast("date").alias("date"),
        L.time_of_day(ts).alias("time_of_day"),
        L.day_segment(D.second_of_day(ts), WEEKDAY_SEGMENTS).alias("segment"),
        L.category_rank(L.time_of_day(ts), DAY_PARTS).alias("part_rank"),
    )


def _line_fit(spark, folder):
    lines = views.table(spark, folder, "lineitem")
    model = prep.predict_line(prep.fit_line(lines, "l_quantity", "l_extendedprice", by=("l_returnflag",)), 20)
    return model.select("l_returnflag", *[rounded(F.col(c), 2).alias(c) for c in ("slope", "intercept", "prediction")])


def _order_calendar(spark, folder):
    orders = views.table(spark, folder, "orders").select(F.col("o_orderdate").cast("date").alias("date"))
    days = orders.groupBy("date").agg(F.count("*").alias("n_orders"))
    return calendar.calendar_for(orders, "date").join(days, "date", "left").fillna(0, ["n_orders"])


def _calendar_dictionary(spark, folder):
    """Columns of the order calendar with their comments; days without orders have no count."""
    orders = views.table(spark, folder, "orders").select(F.col("o_orderdate").cast("date").alias("date"))
    days = orders.groupBy("date").agg(F.count("*").alias("n_orders"))
    known = calendar.calendar_for(orders, "date").join(days, "date", "left")
    return calendar.data_dictionary(known.select("date_key", "date", "day_name", "is_weekend", "fiscal_year", "n_orders"))


def _priced(spark, folder):
    """Lines per product type with its list price; promotional goods have none."""
    part = views.table(spark, folder, "part")
    prices = part.filter(F.col("p_type") != "PROMO").groupBy(F.col("p_type").alias("coffee_name")).agg(
        F.max(F.col("p_retailprice").cast(MONEY)).alias("standard_price")
    )
    sold = views.product_lines(spark, folder, "p_type").groupBy("coffee_name").agg(F.count("*").alias("n"))
    return tables.attach_price(sold, prices)


def _price_bands(spark, folder):
    price = F.col("p_retailprice").cast(MONEY)
    return views.table(spark, folder, "part").select("p_partkey", allocate.interval_lookup(price, PRICE_BANDS).alias("band"))


def _csv_dialect(spark, folder):
    """Parts written with a separator that their names contain, and read back."""
    path = f"{shared_dir(spark)}/dialect-{uuid.uuid4().hex}"
    name = F.concat("p_name", F.lit('; "'), "p_type", F.lit('"'))
    parts = views.table(spark, folder, "part").select("p_partkey", name.alias("label"), F.col("p_retailprice").cast(MONEY).alias("price"))
    files.write_csv(parts, path, sep=";")
    schema = T.StructType([T.StructField("p_partkey", T.LongType()), T.StructField("label", T.StringType()), T.StructField("price", T.DecimalType(18, 2))])
    return files.read_csv(spark, path, schema, sep=";")


def _load_and_insert(spark, folder):
    """Created table, loaded from a file, with rows inserted from a query, a derived column and a comment."""
    name, path = f"sales_{uuid.uuid4().hex}", f"{shared_dir(spark)}/load-{uuid.uuid4().hex}"
    events = views.table(spark, folder, "events").select("event_id", F.col("ts").cast("timestamp_ntz").alias("datetime"), "event_type")
    schema = T.StructType([
        T.StructField("event_id", T.LongType()), T.StructField("datetime", T.TimestampNTZType()), T.StructField("event_type", T.StringType())
    ])
    tables.create_table(spark, name, schema)
    seconds = events.withColumn("datetime", F.date_trunc("second", "datetime").cast("timestamp_ntz"))
    files.write_csv(seconds.filter(F.col("event_type") == "error"), path)
    tables.load_csv_into(spark, path, name, schema)
    tables.insert_into(seconds.filter(F.col("event_type") != "error"), name)
    stored = calendar.with_comments(tables.add_time_of_day(spark.table(name)), {"datetime": "Time of the event"})
    return stored.groupBy("event_type", "time_of_day").agg(F.count("*").alias("n"))


def _nan_events(spark, folder):
    """Events whose value is not a number for errors and null for sign-ups."""
    kind = F.col("event_type")
    value = F.when(kind == "error", float("nan")).when(kind != "signup", F.col("value").cast("double"))
    return views.table(spark, folder, "events").select("event_id", "user_id", value.alias("value"))


def _impute_nan(spark, folder):
    filled = prep.handle_missing(_nan_events(spark, folder), "mean", ["value"])
    return filled.select("event_id", rounded(F.col("value"), 4).alias("value"))


def _empty_rows(spark, folder):
    gaps = _gaps(spark, folder).select("kind", "value")
    return prep.drop_empty_rows(gaps).groupBy("kind").agg(F.count("*").alias("n"))


def _first_rows(spark, folder):
    """The first event of each user and kind."""
    events = views.table(spark, folder, "events").select("event_id", "user_id", "event_type", "ts")
    return prep.remove_duplicates(events, ["user_id", "event_type"], order=("ts", "event_id")).drop("ts")


def _segments(spark, folder):
    segment = F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment"))
    return views.table(spark, folder, "customer").select("c_custkey", segment.alias("segment"))


def _onehot_null(spark, folder):
    return prep.encode_categorical(_segments(spark, folder), ["segment"], "onehot")


def _onehot_index(spark, folder):
    return prep.encode_categorical(_segments(spark, folder), ["segment"], "onehot_index")


def _onehot_sparse(spark, folder):
    """Brand and type of each part as one vector, fitted without promotional goods; one row an entry."""
    part = views.table(spark, folder, "part").select("p_partkey", "p_brand", "p_type")
    coded = prep.encode_categorical(part, ["p_brand", "p_type"], "onehot_sparse", fit_on=part.filter("p_type != 'PROMO'"))
    return coded.select("p_partkey", F.inline("features"))


def _ordinal_null(spark, folder):
    return prep.encode_categorical(_segments(spark, folder), ["segment"], "ordinal")


def _date_dim(spark, folder):
    """Days and orders per decade of the default calendar."""
    days = calendar.date_dim(spark).select("date", "decade")
    orders = views.table(spark, folder, "orders").groupBy(F.col("o_orderdate").cast("date").alias("date")).agg(F.count("*").alias("n"))
    return days.join(orders, "date", "left").groupBy("decade").agg(
        F.count("*").alias("n_days"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_orders")
    )


def _title_names(spark, folder):
    return views.table(spark, folder, "part").select("p_partkey", L.title_case(F.col("p_name")).alias("title"))


def _union_parties(spark, folder):
    """Customers and suppliers in one list of parties, by column name."""
    customers = views.table(spark, folder, "customer").select(F.col("c_custkey").alias("party"), F.col("c_acctbal").cast(MONEY).alias("balance"))
    suppliers = views.table(spark, folder, "supplier").select(F.col("s_acctbal").cast(MONEY).alias("balance"), F.col("s_suppkey").alias("party"))
    return tables.union_all(customers.withColumn("kind", F.lit("customer")), suppliers.withColumn("kind", F.lit("supplier")))


def _limit_rows(spark, folder):
    """How many rows a plain limit gives; which ones is open."""
    return views.table(spark, folder, "orders").limit(100).agg(F.count("*").alias("n"))


def _day_split(spark, folder) -> DataFrame:
    orders = views.table(spark, folder, "orders").select(F.col("o_orderdate").cast("date").alias("date"))
    days = orders.groupBy("date").agg(F.count("*").alias("total"))
    shares = F.when(D.is_weekend(F.col("date")), allocate.split_total(F.col("total"), WEEKEND_SHARES)).otherwise(
        allocate.split_total(F.col("total"), WEEKDAY_SHARES)
    )
    return days.select("date", "total", F.inline(shares)).select("date", "total", "part", "cnt")


def _day_expanded(spark, folder):
    return allocate.expand_by_count(_day_split(spark, folder).drop("total"), "cnt").drop("cnt")


def _safe_names(spark, folder):
    brands = views.table(spark, folder, "part").select("p_brand").distinct()
    return brands.select("p_brand", L.safe_name(F.col("p_brand")).alias("file_name"))


def _sql_totals(spark, folder):
    text = """
        SELECT payment_method, COUNT(DISTINCT transaction_id) AS orders, SUM(drink_price) AS line_revenue
        FROM {sales} GROUP BY 1 ORDER BY 1
    """
    return tables.run_query(spark, text, sales=views.sales_receipts(spark, folder))


def _value_range(spark, folder):
    sold = views.sales_lines(spark, folder, "p_type")
    return dashboards.drinks_by_week(sold, LISTED_TYPES, start="1998-01-05", end="1999-01-04")


def _describe_numeric(spark, folder):
    orders = views.table(spark, folder, "orders")
    return quality.describe_numeric(orders.withColumn("o_totalprice", F.col("o_totalprice").cast(MONEY)))


def _queries() -> dict[str, Query]:
    return {
        # receipts and products
        "business_totals": _on_receipts(sales.business_totals),
        "kpi_distinct": _on_receipts(sales.kpi_distinct),
        "kpi_summary": _on_receipts(sales.kpi_summary),
        "by_day_name": _on_receipts(sales.by_day_name),
        "weekday_vs_weekend": _on_receipts(sales.weekday_vs_weekend),
        "drink_popularity": _on_drinks(sales.drink_popularity, "p_brand"),
        "by_time_of_day": _on_event_receipts(sales.by_time_of_day),
        "by_time_of_day_all_parts": _on_event_receipts(sales.by_time_of_day, fill_missing=True),
        "by_hour_tx": _on_event_receipts(sales.by_hour_receipts),
        "avg_items_per_order": _on_receipts(sales.avg_items_per_order),
        "top3_revenue_share": _on_drinks(sales.top_revenue_share, "p_brand"),
        "payment_mix": _on_receipts(sales.payment_mix),
        "basket_size": _on_receipts(sales.basket_size),
        "order_size_distribution": _on_receipts(sales.order_size_distribution),
        "top_customers": _on_receipts(sales.top_customers),
        "check_distribution": _on_receipts(sales.check_distribution),
        "outlier_receipts": _outliers,
        "outlier_receipt_items": _outlier_items,
        "menu_engineering": _on_drinks(sales.menu_engineering, "p_brand"),
        "check_skew_note": _on_receipts(sales.check_skew_note),
        "check_skew_note_events": _on_event_receipts(sales.check_skew_note),
        "abc_classes": _on_drinks(products.abc_classes, "p_brand"),
        "abc_classes_75": _on_drinks(products.abc_classes, "p_type", thresholds=(0.75, 0.95)),
        "abc_formatted": _on_drinks(products.abc_formatted, "p_brand"),
        "weekly_product_mix": _on_lines(products.weekly_product_mix, "p_type"),
        "weekly_product_mix_top5": _on_lines(products.weekly_product_mix, "p_brand", top=5),
        "product_margin": _margin,
        "product_daily_lag7": _daily_lag,
        "product_totals_per_line": _on_sales(products.product_totals_per_line),
        "product_stats_per_line": _on_sales(products.product_stats_per_line),
        # day and week series
        "daily_revenue_change": _on_receipts(trends.daily_revenue_change),
        "daily_avg_check": _on_receipts(trends.daily_avg_check),
        "daily_traffic": _on_receipts(trends.daily_traffic),
        "daily_trends": _on_receipts(trends.daily_trends),
        "same_weekday_growth": _on_receipts(trends.same_weekday_growth),
        "same_weekday_w_mon": _on_receipts(trends.same_weekday_growth, week_end="Mon"),
        "rolling_revenue_7d": _on_receipts(trends.rolling_revenue),
        "rolling_revenue_7d_full": _on_receipts(trends.rolling_revenue, min_periods=7),
        "rolling_revenue_7d_calendar": _on_receipts(trends.rolling_revenue, fill_calendar=True),
        # hours, weekdays, segments
        "hourly_load": _on_events(staffing.hourly_load),
        "weekday_load": _on_events(staffing.weekday_load),
        "weekday_load_all_days": _on_events(staffing.weekday_load, all_days=True),
        "morning_daily": _on_event_receipts(staffing.morning_daily),
        "revenue_per_hour_segments": _on_event_receipts(staffing.revenue_per_hour_segments),
        "segments_by_weekday": _on_event_receipts(staffing.segments_by_weekday),
        "afternoon_vs_evening_gap": _on_event_receipts(staffing.afternoon_vs_evening_gap),
        "staffing_matrix": _on_event_receipts(staffing.staffing_matrix, start=EVENT_START, end=EVENT_END),
        "staffing_matrix_integer": _on_event_receipts(
            staffing.staffing_matrix, start=EVENT_START, end=EVENT_END, integer_division=True
        ),
        "staffing_matrix_simple": _on_event_receipts(staffing.staffing_matrix_simple, start=EVENT_START, end=EVENT_END),
        "revenue_heatmap": _on_event_receipts(staffing.revenue_heatmap),
        # operations and inventory
        "return_rate": _returns(operations.return_rate),
        "return_rate_by_region": lambda spark, folder: operations.return_rate(views.return_orders_by_region(spark, folder), by="region"),
        "return_rate_by_brand": _returns(operations.return_rate, by="brand"),
        "return_rate_case": _returns(operations.return_rate_case),
        "return_rate_last_month": _returns(operations.return_rate_case, by="brand", last_month=True, as_of=SHIP_AS_OF),
        "slow_assembly_top3": _slow_assembly,
        "inventory_gap": _inventory_gap,
        "falling_demand": _falling_demand,
        "falling_demand_csv": _falling_demand_csv,
        "csv_dialect": _csv_dialect,
        "load_and_insert": _load_and_insert,
        "sales_enriched": _sales_enriched,
        "reorder_point": _on_sales(inventory.reorder_point),
        "reorder_signal": _reorder_signal,
        "demand_volatility": _on_sales(inventory.demand_volatility),
        "cohort_ltv_margin": _cohorts,
        # dashboards
        "staffing_heatmap": _on_event_receipts(dashboards.staffing_heatmap, start=EVENT_START, end=EVENT_END),
        "drinks_by_week": _on_lines(dashboards.drinks_by_week, "p_type"),
        "drinks_by_week_range": _value_range,
        "revenue_share_pie": _on_drinks(dashboards.revenue_share_pie, "p_brand"),
        "rolling_line_revenue": _on_events(dashboards.rolling_line_revenue),
        "segments_pivot": _on_event_receipts(dashboards.segments_pivot),
        "checks_per_segment": _on_event_receipts(dashboards.checks_per_segment),
        "dataset_row_count": _on_events(dashboards.row_count),
        # profiles and audits
        "validate_data": _on_table(quality.validate, "events"),
        "table_shape": _on_table(quality.row_counts, "events"),
        "null_counts": lambda spark, folder: quality.null_counts(_gaps(spark, folder)).drop("data_type"),
        "describe_numeric": _describe_numeric,
        "describe_categorical": _on_table(quality.describe_categorical, "orders"),
        "value_frequencies": _on_drinks(quality.value_counts, "p_brand", column="coffee_name", n=10),
        "audit_unique": _on_raw(quality.audit_unique, how="max_by_date"),
        "audit_repeated": _on_raw(quality.audit_repeated, how="max_by_date"),
        "audit_before_after": _on_raw(quality.audit_before_after),
        "audit_multi_line_receipts": _on_raw(quality.multi_line_receipts),
        "audit_methods_agree": _on_raw(_audit_same),
        "audit_methods_differ": _on_raw(_audit_differ),
        "audit_revenue_totals": _on_receipts(quality.audit_totals),
        "inconsistent_receipts": _on_raw(quality.inconsistent_receipts),
        "receipt_box": _on_event_receipts(quality.receipt_box),
        "order_size_stats": _on_receipts(quality.order_sizes),
        "outside_hours": _on_events(quality.outside_hours),
        "constraint_checks": _constraints,
        "dedup_distinct": _on_raw(dedup, how="distinct"),
        "dedup_max_by_date": _on_raw(dedup, how="max_by_date"),
        "dedup_first_row": _on_raw(dedup, how="first_row", **_LAST),
        "dedup_last_row": _on_raw(dedup, how="last_row", **_LAST),
        "dedup_first_value": _on_raw(_dedup_first_value),
        "dedup_consistent": _on_raw(dedup, how="consistent"),
        # preparation
        "impute_mean": _impute("mean"),
        "impute_median": _impute("median"),
        "impute_mean_nan": _impute_nan,
        "null_counts_nan": lambda spark, folder: quality.null_counts(_nan_events(spark, folder)).drop("data_type"),
        "drop_empty_rows": _empty_rows,
        "impute_most_frequent": _impute("most_frequent", "kind"),
        "drop_missing": _impute("drop"),
        "interpolate_per_user": _interpolate,
        "interpolate_series": _interpolate_series,
        "remove_duplicates": _distinct_rows,
        "remove_duplicates_subset": _first_rows,
        "winsorise": _winsorise,
        "encode_onehot": _onehot,
        "encode_ordinal": _ordinal,
        "encode_ordinal_unseen": _ordinal_unseen,
        "encode_onehot_null": _onehot_null,
        "encode_onehot_index": _onehot_index,
        "encode_onehot_sparse": _onehot_sparse,
        "encode_ordinal_null": _ordinal_null,
        "standard_scale": _scaled,
        "preprocess_pipeline": _preprocess,
        "derive_time_columns": _time_columns,
        "line_fit": _line_fit,
        "price_histogram": _price_histogram,
        "order_calendar": _order_calendar,
        "calendar_dictionary": _calendar_dictionary,
        "date_dim_default": _date_dim,
        "attach_price": _priced,
        "price_bands": _price_bands,
        "safe_names": _safe_names,
        "title_names": _title_names,
        "union_parties": _union_parties,
        "limit_rows": _limit_rows,
        "sql_text_query": _sql_totals,
        # allocation
        "split_day_orders": _day_split,
        "expand_day_orders": _day_expanded,
    }


def queries() -> dict[str, Query]:
    def shown(query: Query) -> Query:
        return lambda spark, folder: present(query(spark, folder))

    return {name: shown(query) for name, query in _queries().items()}

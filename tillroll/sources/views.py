"""The recipes' input shapes, built over the star-schema Parquet tables in a folder."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.constants import SERVICE_LEVELS
from tillroll.functions import dates as D
from tillroll.functions.labels import time_of_day
from tillroll.functions.numbers import MONEY
from tillroll.operators.joins import join_keys


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _day_columns(day):
    return {
        "day_of_week": D.iso_weekday(day),
        "day_name": D.day_name(day),
        "is_weekend": D.is_weekend(day),
    }


def _orders(spark, folder) -> DataFrame:
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("sale_date"),
        F.col("o_totalprice").cast(MONEY).alias("total_cost"),
        F.col("o_orderpriority").alias("payment_method"),
    )


def product_lines(spark: SparkSession, folder: str, product: str) -> DataFrame:
    """Line grain with the drink and its price only; `product` names the part column that
    plays the drink. No order column is needed, so the orders table is not read."""
    lines = table(spark, folder, "lineitem")
    part = table(spark, folder, "part").select("p_partkey", F.col(product).alias("coffee_name"))
    return lines.join(part, lines.l_partkey == part.p_partkey).select(
        F.col("l_orderkey").alias("transaction_id"),
        "coffee_name",
        F.col("l_extendedprice").cast(MONEY).alias("drink_price"),
    )


def sales_lines(spark: SparkSession, folder: str, product: str) -> DataFrame:
    """Line grain without a time, with the receipt's columns repeated on each line."""
    lines = product_lines(spark, folder, product)
    orders = _orders(spark, folder)
    joined = lines.join(orders, lines.transaction_id == orders.o_orderkey).drop("o_orderkey")
    return joined.withColumns(_day_columns(F.col("sale_date")))


def sales_receipts(spark: SparkSession, folder: str) -> DataFrame:
    """The same sales reduced to receipts, for reports that need no product: one row per
    receipt with its line count and summed price. Lines are combined before they meet the
    orders, so a receipt with very many lines costs one row per task."""
    lines = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(
        F.count("*").alias("n_items"), F.sum(F.col("l_extendedprice").cast(MONEY)).alias("drink_price")
    )
    orders = _orders(spark, folder)
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey).drop("o_orderkey")
    return joined.withColumnRenamed("l_orderkey", "transaction_id").withColumns(_day_columns(F.col("sale_date")))


def _event_lines(spark, folder) -> DataFrame:
    return table(spark, folder, "events").select(
        F.col("user_id").alias("customer_id"),
        F.col("ts").cast("date").alias("sale_date"),
        "ts",
        F.col("event_type").alias("coffee_name"),
        F.col("value").cast(MONEY).alias("drink_price"),
    )


def _event_heads(events: DataFrame) -> DataFrame:
    return events.groupBy("customer_id", "sale_date").agg(
        F.min("ts").alias("sale_ts"),
        F.sum("drink_price").cast(MONEY).alias("total_cost"),
        F.count("*").alias("n_items"),
    )


def _event_columns() -> dict:
    day = F.col("sale_date")
    return {
        "transaction_id": F.concat_ws("|", F.col("customer_id").cast("string"), day.cast("string")),
        "second_of_day": D.second_of_day(F.col("sale_ts")),
        "time_of_day": time_of_day(F.col("sale_ts")),
        **_day_columns(day),
    }


def event_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Line grain with a time: a receipt is one user's day, stamped with its first event."""
    events = _event_lines(spark, folder)
    heads = _event_heads(events).drop("n_items")
    return join_keys(events.drop("ts"), heads, ("customer_id", "sale_date")).withColumns(_event_columns())


def event_receipts(spark: SparkSession, folder: str) -> DataFrame:
    """The same receipts, one row each with its line count."""
    heads = _event_heads(_event_lines(spark, folder))
    return heads.withColumn("drink_price", F.col("total_cost")).withColumns(_event_columns())


def order_lines_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Line grain with a total and date that differ inside a receipt, for the audits."""
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("transaction_id"),
        F.col("l_shipdate").cast("date").alias("sale_date"),
        F.col("l_extendedprice").cast(MONEY).alias("total_cost"),
    )


def product_sales(spark: SparkSession, folder: str, customer: bool = False) -> DataFrame:
    """Sales of products by shipping time; the customer needs the orders table."""
    lines = table(spark, folder, "lineitem")
    columns = [
        F.col("l_orderkey").alias("sale_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_shipdate").alias("sale_date"),
        F.col("l_quantity").cast(MONEY).alias("quantity"),
    ]
    if customer:
        orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
        lines = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        columns.append(F.col("o_custkey").alias("customer_id"))
    return lines.select(*columns)


def products(spark: SparkSession, folder: str) -> DataFrame:
    price = F.col("p_retailprice").cast(MONEY)
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("model_name"),
        F.col("p_type").alias("category"),
        (price * F.lit("0.60").cast("decimal(3,2)")).cast(MONEY).alias("cost_price"),
        price.alias("sale_price"),
    )


def inventory_log(spark: SparkSession, folder: str) -> DataFrame:
    """Returned goods booked by product, day and operation: at most two entries a day."""
    back = table(spark, folder, "lineitem").filter(F.col("l_returnflag") == "R")
    operation = F.when(F.col("l_linestatus") == "F", "received").otherwise("shipped")
    return back.groupBy(
        F.col("l_partkey").alias("product_id"),
        F.col("l_shipdate").cast("date").alias("date"),
        operation.alias("operation_type"),
    ).agg(F.sum(F.col("l_quantity").cast("bigint")).alias("stock_on_hand"))


def return_orders(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    part = table(spark, folder, "part")
    status = F.when(F.col("l_returnflag") == "R", "returned").when(F.col("l_returnflag") == "A", "delivered")
    return lines.join(part, lines.l_partkey == part.p_partkey).select(
        F.col("l_orderkey").alias("order_id"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        status.otherwise("in_transit").alias("status"),
        F.col("l_shipdate").cast("date").alias("order_date"),
    )


def return_orders_by_region(spark: SparkSession, folder: str) -> DataFrame:
    """The same orders with the region of the customer."""
    lines, orders = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    customer, nation, region = (table(spark, folder, n) for n in ("customer", "nation", "region"))
    places = customer.join(nation, customer.c_nationkey == nation.n_nationkey).join(region, nation.n_regionkey == region.r_regionkey)
    status = F.when(F.col("l_returnflag") == "R", "returned").when(F.col("l_returnflag") == "A", "delivered")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey).join(places, orders.o_custkey == places.c_custkey)
    return joined.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("r_name").alias("region"),
        status.otherwise("in_transit").alias("status"),
        F.col("l_shipdate").cast("date").alias("order_date"),
    )


def fulfilment(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    # a line that left before its order was made was not assembled
    assembled = F.when(F.col("l_shipdate") >= F.col("o_orderdate"), F.col("l_shipdate"))
    return joined.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_suppkey").alias("darkstore_id"),
        F.col("o_orderdate").alias("created_at"),
        assembled.alias("assembled_at"),
    )


def stores(spark: SparkSession, folder: str) -> DataFrame:
    supplier, nation = table(spark, folder, "supplier"), table(spark, folder, "nation")
    return supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
        F.col("s_suppkey").alias("darkstore_id"), F.col("n_name").alias("city_name")
    )


def sku_catalog(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(F.col("p_partkey").alias("sku"), F.col("p_name").alias("item_name"))


def wms_inventory(spark: SparkSession, folder: str) -> DataFrame:
    """Stock by SKU; promotional goods have no stock row."""
    return (
        table(spark, folder, "part")
        .filter(F.col("p_type") != "PROMO")
        .select(
            F.col("p_partkey").alias("sku"),
            F.col("p_size").alias("system_qty"),
            F.col("p_retailprice").cast(MONEY).alias("purchase_price"),
        )
    )


def scanner_scans(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "lineitem")
        .filter(F.col("l_returnflag") == "N")
        .select(F.col("l_partkey").alias("sku"), F.col("l_quantity").cast(MONEY).alias("qty"))
    )


def stock_levels(spark: SparkSession, folder: str) -> DataFrame:
    """Stock and service class by product."""
    hits, core, seasonal, rest = SERVICE_LEVELS
    size = F.col("p_size")
    level = F.when(size <= 12, hits).when(size <= 25, core).when(size <= 37, seasonal).otherwise(rest)
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"), (size * 4).alias("stock"), level.alias("service_class")
    )


def cost_orders(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders")
    keep = F.lit(1).cast("decimal(3,2)") - F.col("l_discount").cast("decimal(3,2)")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("l_partkey").alias("product_id"),
        (F.col("l_extendedprice").cast(MONEY) * keep).cast("decimal(18,4)").alias("amount"),
        F.col("l_quantity").cast(MONEY).alias("quantity"),
    )


def cost_products(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_retailprice").cast(MONEY).alias("unit_cost"),
    )

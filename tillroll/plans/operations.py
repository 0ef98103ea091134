"""Returns, fulfilment and stock checks."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.constants import RETURN_STATUSES, RETURNED, STOCK_OK, STOCK_SHORTAGE, STOCK_SURPLUS
from tillroll.functions.dates import as_of_date, minutes_between
from tillroll.functions.numbers import percent
from tillroll.operators.windows import dense_rank_top


def return_rate(orders: DataFrame, by: str = "category") -> DataFrame:
    """Orders, returned orders and their percent per category, brand or region."""
    return orders.groupBy(by).agg(
        F.count("*").alias("total_orders"),
        F.count_if(F.col("status") == RETURNED).alias("returned_orders"),
        percent(F.count_if(F.col("status") == RETURNED), F.count("*")).alias("return_rate_percent"),
    ).orderBy(F.desc("return_rate_percent"), F.asc(by))


def return_rate_case(
    orders: DataFrame,
    by: str = "category",
    statuses: list[str] = RETURN_STATUSES,
    last_month: bool = False,
    as_of=None,
) -> DataFrame:
    """The same for listed statuses, as a conditional sum; `last_month` keeps orders since as_of - 1 month."""
    kept = orders.filter(F.col("status").isin(statuses))
    if last_month:
        kept = kept.filter(F.col("order_date") >= F.add_months(as_of_date(as_of), -1))
    returned = F.sum(F.when(F.col("status") == RETURNED, 1).otherwise(0))
    return kept.groupBy(by).agg(
        F.count("*").alias("total_orders"),
        returned.alias("returned_orders"),
        percent(returned, F.count("*")).alias("return_rate_percent"),
    ).orderBy(F.desc("return_rate_percent"), F.asc(by))


def slow_assembly(
    orders: DataFrame, stores: DataFrame, as_of=None, days: int = 7, minutes: float = 10, min_orders: int = 50, k: int = 3
) -> DataFrame:
    """Stores with the k highest percents of slowly assembled orders; equal percents share a rank."""
    since = F.date_sub(as_of_date(as_of), days).cast("timestamp_ntz")
    recent = orders.filter((F.col("created_at") >= since) & F.col("assembled_at").isNotNull())
    slow = minutes_between(F.col("created_at"), F.col("assembled_at")) > minutes
    stats = (
        recent.groupBy("darkstore_id")
        .agg(F.count("*").alias("total_orders"), F.count_if(slow).alias("_slow"))
        .filter(F.col("total_orders") > min_orders)
        .withColumn("slow_pct", percent(F.col("_slow"), F.col("total_orders")))
    )
    located = stats.join(stores, "darkstore_id")
    return dense_rank_top(located, "slow_pct", k).select(
        "city_name", "darkstore_id", "slow_pct", "total_orders", "rnk"
    ).orderBy(F.desc("slow_pct"), F.asc("darkstore_id"))


def inventory_gap(catalog: DataFrame, wms: DataFrame, scans: DataFrame) -> DataFrame:
    """System against counted stock per SKU; scans are summed before the join."""
    counted = scans.groupBy("sku").agg(F.sum("qty").alias("_fact"))
    joined = catalog.join(wms, "sku", "left").join(counted, "sku", "left")
    zero = F.lit(0)
    system, fact = F.coalesce("system_qty", zero), F.coalesce("_fact", zero)
    diff = fact - system
    return joined.select(
        "sku",
        "item_name",
        system.alias("system_qty"),
        fact.alias("fact_qty"),
        diff.alias("diff_qty"),
        (diff * F.coalesce("purchase_price", zero)).alias("financial_impact_rub"),
        F.when(diff == 0, STOCK_OK).when(diff < 0, STOCK_SHORTAGE).otherwise(STOCK_SURPLUS).alias("status"),
    ).orderBy(F.abs("financial_impact_rub").desc(), F.asc("sku"))

"""Sales reports at receipt and product grain.

Inputs are line-grain frames; each report reduces lines to receipts first where money or
traffic is counted. Results are small unless said otherwise.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.constants import DAY_NAMES, DAY_PARTS, SKEW_NORMAL, SKEW_WARNING
from tillroll.functions.labels import smallest_label
from tillroll.functions.numbers import percent, ratio, rounded
from tillroll.operators.joins import join_keys
from tillroll.operators.ordered import distribution
from tillroll.operators.pivots import with_categories
from tillroll.operators.receipts import KEY, TOTAL, consistent_receipts, dedup, items_per_receipt, receipts
from tillroll.operators.windows import kth_largest, top_n


def _count_sum_avg(count: str, revenue: str, avg: str) -> list[Column]:
    return [
        F.count("*").alias(count),
        F.sum(TOTAL).alias(revenue),
        ratio(F.sum(TOTAL), F.count(TOTAL)).alias(avg),
    ]


def business_totals(lines: DataFrame) -> DataFrame:
    """Orders, revenue and average ticket."""
    return receipts(lines).agg(*_count_sum_avg("total_orders", "total_revenue", "avg_ticket"))


def kpi_distinct(lines: DataFrame) -> DataFrame:
    """The same over distinct (receipt, total) pairs."""
    return dedup(lines, "distinct").agg(*_count_sum_avg("transactions", "total_revenue", "avg_ticket"))


def kpi_summary(lines: DataFrame) -> DataFrame:
    """Revenue from receipt totals, but the average ticket from the receipt's line prices."""
    tx = receipts(lines, F.sum("drink_price").alias("_lines"))
    return tx.agg(
        F.sum(TOTAL).alias("total_revenue"),
        F.count(KEY).alias("transactions"),
        ratio(F.sum("_lines"), F.count("*")).alias("avg_ticket"),
    )


def by_day_name(lines: DataFrame) -> DataFrame:
    tx = receipts(lines, smallest_label(F.col("day_name"), DAY_NAMES).alias("day_name"))
    return tx.groupBy("day_name").agg(*_count_sum_avg("total_orders", "revenue", "avg_ticket")).orderBy(F.desc("revenue"))


def weekday_vs_weekend(lines: DataFrame) -> DataFrame:
    tx = receipts(lines, F.bool_or("is_weekend").alias("is_weekend"))
    return tx.groupBy("is_weekend").agg(*_count_sum_avg("total_orders", "revenue", "avg_ticket"))


def drink_popularity(lines: DataFrame, n: int = 8) -> DataFrame:
    products = lines.groupBy("coffee_name").agg(
        F.count("*").alias("drinks_sold"), F.sum("drink_price").alias("revenue")
    )
    return top_n(products, n, F.desc("revenue"), F.asc("coffee_name"))


def by_time_of_day(lines: DataFrame, fill_missing: bool = False) -> DataFrame:
    """Per day part; `fill_missing` lists all parts in order, with zeros."""
    tx = receipts(lines, smallest_label(F.col("time_of_day"), DAY_PARTS).alias("time_of_day"))
    parts = tx.groupBy("time_of_day").agg(*_count_sum_avg("total_orders", "total_revenue", "avg_ticket"))
    if fill_missing:
        return with_categories(parts, "time_of_day", DAY_PARTS)
    return parts.orderBy(F.desc("total_revenue"))


def by_hour_receipts(lines: DataFrame) -> DataFrame:
    """Per hour of the receipt's first timestamp."""
    tx = receipts(lines, F.min("sale_ts").alias("_first"))
    hours = tx.groupBy(F.hour("_first").alias("hour"))
    return hours.agg(*_count_sum_avg("num_tx", "total_revenue", "avg_check")).orderBy("hour")


def avg_items_per_order(lines: DataFrame) -> DataFrame:
    return items_per_receipt(lines).agg(ratio(F.sum("n_items"), F.count("*")).alias("avg_drinks_per_order"))


def top_revenue_share(lines: DataFrame, k: int = 3) -> DataFrame:
    """The k best products by revenue rank, the rest as 'other', with shares.

    The rank test is a comparison with the k-th largest revenue, so products are never
    gathered in one task.
    """
    products = lines.groupBy("coffee_name").agg(F.sum("drink_price").alias("revenue"))
    best = F.col("revenue") >= kth_largest(products, "revenue", k)
    groups = products.groupBy(F.when(best, F.col("coffee_name")).otherwise("other").alias("category"))
    summed = groups.agg(F.sum("revenue").alias("revenue"))
    everything = Window.partitionBy()
    return summed.withColumn(
        "share_percent", percent(F.col("revenue"), F.sum("revenue").over(everything))
    ).orderBy(F.desc("revenue"))


def payment_mix(lines: DataFrame) -> DataFrame:
    tx = receipts(lines, F.min("payment_method").alias("payment_method"))
    mix = tx.groupBy("payment_method").agg(F.count("*").alias("total_orders"), F.sum(TOTAL).alias("revenue"))
    everything = Window.partitionBy()
    return mix.withColumn(
        "percent_of_total", percent(F.col("revenue"), F.sum("revenue").over(everything))
    ).orderBy(F.desc("revenue"))


def basket_size(lines: DataFrame) -> DataFrame:
    """Orders by number of lines: average, median, shares and cumulative percent. Orders without a total are counted."""
    orders = items_per_receipt(lines)
    sizes = distribution(orders, TOTAL, {"median_check": 0.5}, by=("n_items",), digits=2)
    table = sizes.withColumnsRenamed({"total": "_sum", "n_rows": "order_count"})
    whole = Window.partitionBy()
    upto = Window.orderBy("n_items")
    return table.select(
        "n_items",
        "order_count",
        ratio(F.col("_sum"), F.col("order_count")).alias("avg_check"),
        "median_check",
        percent(F.col("order_count"), F.sum("order_count").over(whole)).alias("percent"),
        percent(F.col("_sum"), F.sum("_sum").over(whole)).alias("revenue_share"),
        percent(F.sum("order_count").over(upto), F.sum("order_count").over(whole)).alias("cumulative_percent"),
    ).orderBy("n_items")


def order_size_distribution(lines: DataFrame) -> DataFrame:
    """Orders by number of lines with percent and cumulative percent."""
    return basket_size(lines).select(
        "n_items", F.col("order_count").alias("orders_count"), "percent", "cumulative_percent"
    )


def top_customers(lines: DataFrame, n: int = 10) -> DataFrame:
    tx = receipts(lines, F.min("customer_id").alias("customer_id"))
    spend = tx.groupBy("customer_id").agg(
        F.sum(TOTAL).alias("total_spent"),
        F.count("*").alias("num_transactions"),
        ratio(F.sum(TOTAL), F.count(TOTAL)).alias("avg_check"),
    )
    return top_n(spend, n, F.desc("total_spent"), F.asc("customer_id"))


_QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def check_distribution(lines: DataFrame, k: float = 1.5) -> DataFrame:
    """Quartiles, IQR, upper fence and maximum of consistent receipts."""
    box = distribution(consistent_receipts(lines), TOTAL, _QUARTILES)
    iqr = F.col("q3") - F.col("q1")
    return box.select(
        "q1", "median", "q3",
        rounded(iqr, 4).alias("iqr"),
        rounded(F.col("q3") + F.lit(k) * iqr, 4).alias("upper_bound"),
        F.col("max_value").alias("max_amount"),
    )


def _outlier_pairs(lines: DataFrame, k: float, heads: DataFrame | None) -> DataFrame:
    """(receipt, item) of consistent receipts above the upper fence, with the item's count `_n`."""
    heads = lines if heads is None else heads
    fence = check_distribution(heads, k).select("upper_bound").scalar()
    checks = consistent_receipts(heads).withColumn("_fence", fence)
    above = checks.filter(F.col(TOTAL).cast("double") > F.col("_fence")).select(KEY, "_fence")
    return join_keys(lines, above, (KEY,)).groupBy(KEY, "coffee_name").agg(
        F.max(TOTAL).alias("_total"),
        F.count("*").alias("_n"),
        F.min("sale_date").alias("_date"),
        smallest_label(F.col("time_of_day"), DAY_PARTS).alias("_part"),
        F.max("_fence").alias("_fence"),
    )


def _item_texts(count: str) -> Column:
    """Aggregate: the items' names, each as often as it occurs, in order."""
    items = F.array_sort(F.collect_list(F.struct("coffee_name", F.col(count).cast("int").alias("n"))))
    return F.array_join(F.transform(items, lambda i: F.array_join(F.array_repeat(i["coffee_name"], i["n"]), ", ")), ", ")


def outlier_receipts(lines: DataFrame, k: float = 1.5, heads: DataFrame | None = None) -> DataFrame:
    """Consistent receipts above the upper fence, with their items.

    Only receipts above the fence get a list, and it is built from (item, count) pairs. It is one text a receipt;
    `outlier_receipt_items` gives the same lists in pieces. `heads` gives the same sales already reduced to receipts, if at hand.
    """
    return _outlier_pairs(lines, k, heads).groupBy(KEY).agg(
        F.max("_total").alias("check_amount"),
        F.sum("_n").alias("items_count"),
        _item_texts("_n").alias("items_list"),
        F.min("_date").alias("sale_date"),
        smallest_label(F.col("_part"), DAY_PARTS).alias("time_of_day"),
        rounded(F.max("_fence"), 0).alias("upper_bound"),
    ).orderBy(F.desc("check_amount"), F.asc(KEY))


def outlier_receipt_items(lines: DataFrame, k: float = 1.5, heads: DataFrame | None = None, per_piece: int = 1000) -> DataFrame:
    """The items of receipts above the upper fence in numbered pieces of `per_piece` items, in order of name: transaction_id,
    piece (from 0), items_count, items_list. Lines without a name fill no piece, as they are in no list.

    No text, list or group is longer than a piece, however many lines a receipt has.
    """
    upto = Window.partitionBy(KEY).orderBy("coffee_name").rowsBetween(Window.unboundedPreceding, 0)
    named = _outlier_pairs(lines, k, heads).filter(F.col("coffee_name").isNotNull()).select(KEY, "coffee_name", "_n")
    spans = named.withColumn("_end", F.sum("_n").over(upto)).withColumn("_start", F.col("_end") - F.col("_n"))
    first, last = F.expr(f"_start div {per_piece}"), F.expr(f"(_end - 1) div {per_piece}")
    parts = spans.withColumn("piece", F.explode(F.sequence(first, last)))
    low, high = F.greatest("_start", F.col("piece") * per_piece), F.least("_end", (F.col("piece") + 1) * per_piece)
    parts = parts.select(KEY, "piece", "coffee_name", (high - low).alias("_part_n"))
    return parts.groupBy(KEY, "piece").agg(F.sum("_part_n").alias("items_count"), _item_texts("_part_n").alias("items_list"))


def menu_engineering(lines: DataFrame, n: int = 10) -> DataFrame:
    """Revenue, quantity and receipts per product.

    Receipts are counted from (product, receipt) pairs, so lines are combined map-side.
    """
    pairs = lines.groupBy("coffee_name", KEY).agg(F.sum("drink_price").alias("_sum"), F.count("*").alias("_n"))
    products = pairs.groupBy("coffee_name").agg(
        F.sum("_sum").alias("revenue"), F.sum("_n").alias("quantity"), F.count("*").alias("transactions")
    )
    return top_n(products, n, F.desc("revenue"), F.asc("coffee_name"))


def check_skew_note(lines: DataFrame, flag: float = 0.5) -> DataFrame:
    """Mean against median receipt, with a text when they are far apart."""
    stats = distribution(receipts(lines), TOTAL, {"median": 0.5}, digits=2)
    avg = ratio(F.col("total"), F.col("n"))
    return stats.select(avg.alias("avg_check"), F.col("median").alias("median_check"), F.col("n").alias("n_transactions")).select(
        "avg_check",
        "median_check",
        rounded(F.col("avg_check") - F.col("median_check")).alias("avg_median_diff"),
        percent(F.col("avg_check") - F.col("median_check"), F.col("median_check")).alias("diff_percent"),
        "n_transactions",
        F.when(F.abs(F.col("avg_check") - F.col("median_check")) > F.col("median_check") * flag, SKEW_WARNING)
        .otherwise(SKEW_NORMAL)
        .alias("data_quality_note"),
    )

"""Product reports: ABC classes, weekly mix, margins."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.dates import week_start
from tillroll.functions.numbers import grouped_amount, percent, percent_text, rounded, safe_div
from tillroll.operators.ordered import running_total
from tillroll.operators.windows import series, top_n, with_group_stats
from tillroll.plans.trends import daily_revenue


def _abc(lines: DataFrame, thresholds: tuple[float, float]) -> DataFrame:
    products = lines.groupBy("coffee_name").agg(F.sum("drink_price").alias("revenue"))
    ranked = running_total(products.filter(F.col("revenue") > 0), "revenue", "revenue", descending=True)
    share = safe_div(F.col("revenue"), F.col("grand_total"))
    cumulative = safe_div(F.col("running"), F.col("grand_total"))
    a, b = thresholds
    return ranked.select(
        "coffee_name",
        "revenue",
        share.alias("_share"),
        cumulative.alias("_cumulative"),
        F.when(cumulative <= a, "A").when(cumulative <= b, "B").otherwise("C").alias("abc_class"),
    )


def abc_classes(lines: DataFrame, thresholds: tuple[float, float] = (0.80, 0.95)) -> DataFrame:
    """Revenue share, cumulative share (equal revenues step together) and class per product."""
    return _abc(lines, thresholds).select(
        "coffee_name",
        "revenue",
        rounded(F.col("_share"), 4).alias("revenue_share"),
        rounded(F.col("_cumulative"), 4).alias("cumulative_share"),
        "abc_class",
    ).orderBy(F.desc("revenue"), F.asc("coffee_name"))


def abc_formatted(lines: DataFrame, thresholds: tuple[float, float] = (0.80, 0.95)) -> DataFrame:
    """The same as report texts."""
    return _abc(lines, thresholds).orderBy(F.desc("revenue"), F.asc("coffee_name")).select(
        "coffee_name",
        grouped_amount(F.col("revenue")).alias("revenue_formatted"),
        percent_text(F.col("_share")).alias("revenue_share_pct"),
        percent_text(F.col("_cumulative")).alias("cumulative_share_pct"),
        "abc_class",
    )


def weekly_product_mix(lines: DataFrame, top: int | None = None) -> DataFrame:
    """Units per week and product with the product's percent of the week; `top` keeps the
    best-selling products but leaves the week totals whole."""
    units = lines.groupBy(week_start(F.col("sale_date")).alias("week_start"), "coffee_name").agg(
        F.count("*").alias("units_sold")
    )
    mix = with_group_stats(units, ("week_start",), total_units_week=F.sum("units_sold"))
    if top is not None:
        sold = units.groupBy("coffee_name").agg(F.sum("units_sold").alias("_n"))
        best = top_n(sold, top, F.desc("_n"), F.asc("coffee_name"))
        mix = mix.join(best, "coffee_name", "left_semi")
    return mix.select(
        "week_start",
        "coffee_name",
        "units_sold",
        "total_units_week",
        percent(F.col("units_sold"), F.col("total_units_week")).alias("percentage"),
    ).orderBy("week_start", F.desc("units_sold"), "coffee_name")


def product_margin(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue, cost, profit and margin per product name.

    Sales are summed per product before the join, so only one row per product and task moves.
    """
    sold = sales.groupBy("product_id").agg(F.sum("total_amount").alias("_amount"), F.sum("quantity").alias("_units"))
    lines = sold.join(products, "product_id").withColumn("_cost", F.col("_units") * F.col("cost"))
    return (
        lines.groupBy("name")
        .agg(F.sum("_amount").alias("revenue"), F.sum("_cost").alias("cost"), F.sum(F.col("_amount") - F.col("_cost")).alias("profit"))
        .withColumn("margin_pct", percent(F.col("profit"), F.col("revenue")))
        .orderBy(F.desc("profit"), F.asc("name"))
    )


def product_daily_lag(
    lines: DataFrame, product: str, days_back: int = 7, receipts: DataFrame | None = None
) -> DataFrame:
    """Day revenue with one product's line count and its value `days_back` rows earlier.

    `receipts` gives the same sales already reduced to receipts, if at hand.
    """
    counts = lines.filter(F.col("coffee_name") == product).groupBy("sale_date").agg(F.count("*").alias("product_count"))
    days = daily_revenue(lines if receipts is None else receipts).join(counts, "sale_date", "left")
    return days.withColumn(
        "prev_product_count", F.lag("product_count", days_back).over(series("sale_date"))
    ).orderBy("sale_date")


def product_totals_per_line(sales: DataFrame) -> DataFrame:
    """Each line plus its product's total quantity."""
    return with_group_stats(sales, ("product_id",), total_sales_qty=F.sum("quantity"))


def product_stats_per_line(sales: DataFrame) -> DataFrame:
    """Each line plus its product's mean, largest and number of sales."""
    return with_group_stats(
        sales,
        ("product_id",),
        avg_quantity=rounded(F.avg("quantity"), 4),
        max_sale=F.max("quantity"),
        num_transactions=F.count("sale_id"),
    )

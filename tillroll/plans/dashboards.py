"""Dashboard charts: a dataset, a metric and its post-processing."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.constants import WEEKDAY_SEGMENTS
from tillroll.functions.dates import in_range, week_start
from tillroll.functions.numbers import ratio, rounded, safe_div
from tillroll.operators.pivots import OTHER, percent_rank_average, pivot_table, with_row_total
from tillroll.operators.windows import moving_average, series, top_n
from tillroll.plans.staffing import segments_by_weekday, staffing_matrix_simple


def staffing_heatmap(lines: DataFrame, start=None, end=None, limit: int | None = None) -> DataFrame:
    """Largest mean load per hour and weekday cell, with its fractional rank over all cells."""
    cells = staffing_matrix_simple(lines, start, end).groupBy("hour_label", "day_label").agg(
        F.max("avg_transaction_load").alias("max_load")
    )
    ranked = percent_rank_average(cells, "max_load")
    ordered = ranked.orderBy(F.asc("hour_label"), F.desc("day_label"))
    return ordered if limit is None else ordered.limit(limit)


def drinks_by_week(lines: DataFrame, products: list[str] | None = None, start=None, end=None) -> DataFrame:
    """Lines per week, one column per product; null where a product was not sold. With a list of products, all others
    are counted in the column `other`."""
    kept = lines.filter(in_range(F.col("sale_date"), start, end))
    weekly = kept.withColumn("week_start", week_start(F.col("sale_date")))
    other = None if products is None else OTHER
    return pivot_table(weekly, ("week_start",), "coffee_name", F.count(F.lit(1)), products, other=other).orderBy("week_start")


def revenue_share_pie(lines: DataFrame, start=None, end=None, limit: int | None = None) -> DataFrame:
    """Revenue per product, best first, with its part of the whole revenue; `limit` keeps the best products."""
    kept = lines.filter(in_range(F.col("sale_date"), start, end))
    revenue = kept.groupBy("coffee_name").agg(F.sum("drink_price").alias("revenue"))
    total = revenue.agg(F.sum("revenue")).scalar()
    best = F.desc("revenue"), F.asc("coffee_name")
    listed = revenue.orderBy(*best) if limit is None else top_n(revenue, limit, *best)
    return listed.withColumn("contribution", rounded(safe_div(F.col("revenue"), total), 6))


def rolling_line_revenue(lines: DataFrame, window: int = 7, start=None, end=None) -> DataFrame:
    """Line revenue per day as its trailing mean; any number of days is enough."""
    kept = lines.filter(in_range(F.col("sale_ts"), start, end))
    days = kept.groupBy(F.col("sale_ts").cast("date").alias("day")).agg(F.sum("drink_price").alias("_revenue"))
    mean = moving_average("_revenue", series("day"), window, min_periods=0)
    return days.select("day", mean.alias("rolling_mean")).orderBy("day")


def segments_pivot(lines: DataFrame) -> DataFrame:
    """Weekday rows, one column per segment with its average revenue, and the row total."""
    table = pivot_table(
        segments_by_weekday(lines), ("day_num", "day_name"), "time_segment",
        ratio(F.sum("total_revenue"), F.count("total_revenue")), WEEKDAY_SEGMENTS,
    )
    return with_row_total(table, WEEKDAY_SEGMENTS).orderBy("day_num")


def checks_per_segment(lines: DataFrame) -> DataFrame:
    """Average number of receipts per segment over the weekdays."""
    return segments_by_weekday(lines).groupBy("time_segment").agg(
        ratio(F.sum("total_checks"), F.count("total_checks")).alias("avg_total_checks")
    ).orderBy("time_segment")


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("count"))

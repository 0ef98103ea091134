"""Series by day and week. Windows here run over one row per day or week."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.dates import iso_weekday, week_ending_monday, week_start
from tillroll.functions.numbers import change_percent, ratio
from tillroll.operators.receipts import KEY, TOTAL, receipts
from tillroll.operators.windows import fill_days, moving_average, series


def _receipt_days(lines: DataFrame) -> DataFrame:
    return receipts(lines, F.min("sale_date").alias("sale_date"))


def daily_revenue(lines: DataFrame) -> DataFrame:
    """sale_date and the revenue of its receipts."""
    return _receipt_days(lines).groupBy("sale_date").agg(F.sum(TOTAL).alias("revenue"))


def daily_revenue_change(lines: DataFrame) -> DataFrame:
    previous = F.lag("revenue", 1).over(series("sale_date"))
    return daily_revenue(lines).select(
        "sale_date",
        "revenue",
        previous.alias("prev_day_revenue"),
        change_percent(F.col("revenue"), previous).alias("revenue_change_pct"),
    ).orderBy("sale_date")


def daily_avg_check(lines: DataFrame) -> DataFrame:
    days = _receipt_days(lines).groupBy("sale_date")
    return days.agg(ratio(F.sum(TOTAL), F.count(TOTAL)).alias("avg_check")).orderBy("sale_date")


def daily_traffic(lines: DataFrame) -> DataFrame:
    """Distinct receipts per day and the day before; a receipt counts on each of its days."""
    pairs = lines.select("sale_date", KEY).distinct()
    days = pairs.groupBy("sale_date").agg(F.count(KEY).alias("n_transactions"))
    return days.withColumn(
        "prev_n_transactions", F.lag("n_transactions", 1).over(series("sale_date"))
    ).orderBy("sale_date")


def daily_trends(lines: DataFrame) -> DataFrame:
    """Revenue, average receipt and traffic per day with their previous values, one aggregate."""
    days = _receipt_days(lines).groupBy("sale_date").agg(
        F.sum(TOTAL).alias("revenue"),
        ratio(F.sum(TOTAL), F.count(TOTAL)).alias("avg_check"),
        F.count(KEY).alias("n_transactions"),
    )
    before = series("sale_date")
    previous = F.lag("revenue", 1).over(before)
    return days.select(
        "sale_date",
        "revenue",
        previous.alias("prev_day_revenue"),
        change_percent(F.col("revenue"), previous).alias("revenue_change_pct"),
        "avg_check",
        F.lag("avg_check", 1).over(before).alias("prev_avg_check"),
        "n_transactions",
        F.lag("n_transactions", 1).over(before).alias("prev_n_transactions"),
    ).orderBy("sale_date")


def same_weekday_growth(lines: DataFrame, week_end: str = "Sun") -> DataFrame:
    """Revenue per ISO weekday and week against the same weekday one week earlier.

    Weeks end on Sunday and are named by their Monday, or end on Monday and are named by it.
    """
    if week_end not in ("Sun", "Mon"):
        raise ValueError("week_end is Sun or Mon")
    week = week_start if week_end == "Sun" else week_ending_monday
    day = F.col("sale_date")
    weeks = (
        _receipt_days(lines)
        .groupBy(iso_weekday(day).alias("day_of_week_num"), week(day).alias("_week"))
        .agg(F.sum(TOTAL).alias("weekly_dow_revenue"))
    )
    previous = F.lag("weekly_dow_revenue", 1).over(series("_week", ("day_of_week_num",)))
    return weeks.select(
        "day_of_week_num",
        F.date_format("_week", "yyyy-MM-dd").alias("week_start"),
        "weekly_dow_revenue",
        previous.alias("prev_week_revenue"),
        change_percent(F.col("weekly_dow_revenue"), previous).alias("weekly_growth_pct"),
    ).orderBy("day_of_week_num", "week_start")


def rolling_revenue(lines: DataFrame, window: int = 7, min_periods: int = 1, fill_calendar: bool = False) -> DataFrame:
    """Day revenue and its trailing mean over rows; `fill_calendar` adds days without sales as 0."""
    tx = receipts(lines, by=("sale_date",))
    days = tx.groupBy("sale_date").agg(F.sum(TOTAL).alias("daily_revenue"))
    if fill_calendar:
        days = fill_days(days, "sale_date").fillna(0, ["daily_revenue"])
    mean = moving_average("daily_revenue", series("sale_date"), window, min_periods)
    return days.withColumn("rolling_mean_7d", mean).orderBy("sale_date")

"""Load by hour, weekday and day segment."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.constants import DAY_NAMES, REVENUE_SEGMENTS, SEGMENT_HOURS, SEGMENT_START, WEEKDAY_SEGMENTS
from tillroll.functions import dates as D
from tillroll.functions.labels import day_segment
from tillroll.functions.numbers import change_percent, int_div, percent, ratio, rounded
from tillroll.operators.pivots import pivot_table, with_categories
from tillroll.operators.receipts import KEY, TOTAL, receipts
from tillroll.operators.windows import series


def _per_key(lines: DataFrame, *keys) -> DataFrame:
    """Revenue, receipts and items per key, with receipts counted from (key, receipt) pairs."""
    names = [k if isinstance(k, str) else k[1] for k in keys]
    columns = [F.col(k) if isinstance(k, str) else k[0].alias(k[1]) for k in keys]
    pairs = lines.groupBy(*columns, KEY).agg(
        F.sum("drink_price").alias("_sum"),
        F.count("*").alias("_n"),
        F.sum(TOTAL).alias("_totals"),
        F.count(TOTAL).alias("_n_totals"),
    )
    return pairs.groupBy(*names).agg(
        F.sum("_sum").alias("revenue"),
        F.count(KEY).alias("transactions"),
        F.sum("_n").alias("items_sold"),
        ratio(F.sum("_totals"), F.sum("_n_totals")).alias("avg_ticket"),
    )


def hourly_load(lines: DataFrame) -> DataFrame:
    return _per_key(lines, (F.hour("sale_ts"), "hour")).drop("avg_ticket").orderBy("hour")


def weekday_load(lines: DataFrame, all_days: bool = False) -> DataFrame:
    """Per weekday, Monday first. `avg_ticket` is the mean total over lines, not receipts.
    `all_days` lists all seven, with zeros."""
    days = _per_key(lines, "day_name", (D.iso_weekday(F.col("sale_date")), "_dow"))
    if all_days:
        return with_categories(days.drop("_dow"), "day_name", DAY_NAMES)
    return days.orderBy("_dow").drop("_dow")


def morning_daily(lines: DataFrame, part: str = "Morning") -> DataFrame:
    """Receipts and revenue per day within one day part."""
    tx = receipts(lines.filter(F.col("time_of_day") == part), by=("sale_date",))
    return tx.groupBy("sale_date").agg(
        F.count("*").alias("unique_transactions"),
        F.sum(TOTAL).alias("total_revenue"),
        ratio(F.sum(TOTAL), F.count(TOTAL)).alias("avg_check"),
    ).orderBy("sale_date")


def revenue_per_hour_segments(
    lines: DataFrame, segments: list[str] = REVENUE_SEGMENTS, hours: float = SEGMENT_HOURS
) -> DataFrame:
    """Weekday segments: days, receipts, average, revenue and revenue per hour worked."""
    day = lines.filter(~F.col("is_weekend") & (F.col("second_of_day") >= SEGMENT_START[0]))
    day = day.withColumn("real_segment", day_segment(F.col("second_of_day"), segments))
    tx = receipts(day, by=("sale_date", "real_segment"))
    daily = tx.groupBy("real_segment", "sale_date").agg(F.count("*").alias("_n"), F.sum(TOTAL).alias("_sum"))
    return daily.groupBy("real_segment").agg(
        F.count("*").alias("unique_days"),
        F.sum("_n").alias("total_checks"),
        ratio(F.sum("_sum"), F.sum("_n")).alias("avg_check_rub"),
        F.sum("_sum").alias("total_revenue"),
        ratio(F.sum("_sum"), F.count("*") * F.lit(float(hours)), 0).alias("revenue_per_hour"),
    ).orderBy("real_segment")


def segments_by_weekday(
    lines: DataFrame, segments: list[str] = WEEKDAY_SEGMENTS, hours: float = SEGMENT_HOURS
) -> DataFrame:
    """Weekday x segment: receipts, revenue, revenue per hour.

    A receipt with lines at two times has its total counted once per time, but is one receipt.
    """
    day = lines.filter(~F.col("is_weekend") & (F.col("second_of_day") >= SEGMENT_START[0]))
    day = day.select(
        "sale_date", "day_name", D.iso_weekday(F.col("sale_date")).alias("day_num"), KEY, TOTAL,
        day_segment(F.col("second_of_day"), segments).alias("time_segment"), "sale_ts",
    )
    keys = ("day_name", "day_num", "time_segment")
    times = receipts(day, by=("sale_date", *keys, "sale_ts"))
    per_receipt = times.groupBy(*keys, KEY).agg(F.sum(TOTAL).alias(TOTAL))
    return per_receipt.groupBy(*keys).agg(
        F.count(KEY).alias("total_checks"),
        F.sum(TOTAL).alias("total_revenue"),
        ratio(F.sum(TOTAL), F.lit(float(hours))).alias("revenue_per_hour"),
    ).orderBy("day_num", "time_segment")


def afternoon_vs_evening_gap(lines: DataFrame) -> DataFrame:
    """Weekday afternoons and evenings: average daily revenue and the afternoon's gap."""
    parts = lines.filter(~F.col("is_weekend") & F.col("time_of_day").isin("Afternoon", "Evening"))
    tx = receipts(parts, by=("sale_date", "time_of_day"))
    daily = tx.groupBy("time_of_day", "sale_date").agg(F.sum(TOTAL).alias("_sum"))
    summary = daily.groupBy("time_of_day").agg(
        F.count("*").alias("days"),
        F.sum("_sum").alias("total_revenue"),
        ratio(F.sum("_sum"), F.count("_sum")).alias("avg_daily_revenue"),
    )
    evening = summary.filter(F.col("time_of_day") == "Evening").select("avg_daily_revenue").scalar()
    table = summary.withColumn("_evening", evening)
    afternoon = F.col("time_of_day") == "Afternoon"
    gap = F.col("_evening") - F.col("avg_daily_revenue")
    return table.select(
        "time_of_day", "days", "total_revenue", "avg_daily_revenue",
        F.when(afternoon, rounded(gap)).alias("gap_to_evening_rub"),
        F.when(afternoon, percent(gap, F.col("_evening"), 1)).alias("gap_to_evening_pct"),
    ).orderBy("time_of_day")


def _hourly_receipts(lines: DataFrame, start, end) -> DataFrame:
    """Distinct receipts per day and hour."""
    kept = lines.filter(D.in_range(F.col("sale_ts"), start, end))
    pairs = kept.select(F.col("sale_ts").cast("date").alias("tx_date"), F.hour("sale_ts").alias("tx_hour"), KEY).distinct()
    hours = pairs.groupBy("tx_date", "tx_hour").agg(F.count(KEY).alias("cnt"))
    return hours.withColumn("dow", D.iso_weekday(F.col("tx_date")))


def staffing_matrix(lines: DataFrame, start=None, end=None, integer_division: bool = False) -> DataFrame:
    """Weekday x hour: mean, median and 90th percentile of receipts, week-over-week growth.

    A cell holds one value per week, so its percentile buffer is bounded by the calendar.
    `integer_division` truncates the growth quotient before it becomes a percent.
    """
    hours = _hourly_receipts(lines, start, end)
    previous = F.lag("cnt").over(series("tx_date", ("dow", "tx_hour")))
    weeks = hours.withColumn("prev", previous).filter(F.col("prev").isNotNull())
    change = F.col("cnt") - F.col("prev")
    if integer_division:
        growth = (int_div(change, F.col("prev")) * 100).cast("double")
    else:
        growth = change_percent(F.col("cnt"), F.col("prev"), 1)
    weeks = weeks.withColumn("wow", growth.cast("decimal(18,1)"))
    number = F.col("cnt").cast("double")
    return weeks.groupBy("tx_hour", "dow").agg(
        ratio(F.sum("cnt"), F.count("*"), 1).alias("avg_receipts"),
        rounded(F.percentile(number, 0.5), 1).alias("median_receipts"),
        rounded(F.percentile(number, 0.9), 1).alias("p90_receipts"),
        ratio(F.sum("wow"), F.count("wow"), 1).alias("avg_wow_growth_pct"),
        percent(F.count_if(F.col("cnt") > F.col("prev")), F.count("*"), 1).alias("pct_weeks_growing"),
        F.count("*").alias("data_points_with_trend"),
    ).orderBy("dow", "tx_hour").select(
        D.hour_label(F.col("tx_hour")).alias("hour_label"),
        D.day_label(F.col("dow")).alias("day_label"),
        "avg_receipts", "median_receipts", "p90_receipts",
        "avg_wow_growth_pct", "pct_weeks_growing", "data_points_with_trend",
    )


def staffing_matrix_simple(lines: DataFrame, start=None, end=None) -> DataFrame:
    """Weekday x hour: mean receipts."""
    cells = _hourly_receipts(lines, start, end).groupBy("tx_hour", "dow")
    return cells.agg(ratio(F.sum("cnt"), F.count("*"), 1).alias("avg_transaction_load")).orderBy("dow", "tx_hour").select(
        D.hour_label(F.col("tx_hour")).alias("hour_label"), D.day_label(F.col("dow")).alias("day_label"), "avg_transaction_load"
    )


def revenue_heatmap(lines: DataFrame) -> DataFrame:
    """Receipt revenue by weekday (all seven, Monday first) and hour 0-23, zero-filled."""
    tx = receipts(lines, F.min("sale_ts").alias("_first"))
    cells = tx.select(D.day_name(F.col("_first").cast("date")).alias("day_name"), F.hour("_first").alias("hour"), TOTAL)
    table = pivot_table(cells, ("day_name",), "hour", F.sum(TOTAL), values=list(range(24)), fill=0)
    return with_categories(table, "day_name", DAY_NAMES)

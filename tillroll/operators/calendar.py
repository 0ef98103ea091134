"""Date dimension."""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.constants import CALENDAR_COMMENTS, CALENDAR_END, CALENDAR_START
from tillroll.functions import dates as D
from tillroll.operators.quality import null_counts


def date_columns(d: Column) -> list[Column]:
    """The 26 columns of the date dimension for a date column."""
    small = lambda col, name: col.cast("smallint").alias(name)
    quarter = F.quarter(d)
    return [
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"),
        d.alias("date"),
        small(F.dayofmonth(d), "day_of_month"),
        small(F.dayofyear(d), "day_of_year"),
        small(D.sunday_weekday(d), "day_of_week"),
        small(D.iso_weekday(d), "day_of_week_iso"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "EEE").alias("day_short_name"),
        D.is_weekend(d).alias("is_weekend"),
        small(F.weekofyear(d), "week_number"),
        small(D.week_of_month(d), "week_of_month"),
        D.week_start(d).alias("week_start_date"),
        small(F.month(d), "month_number"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_short_name"),
        D.month_start(d).alias("first_day_of_month"),
        F.last_day(d).alias("last_day_of_month"),
        small(quarter, "quarter_number"),
        F.concat(F.lit("Q"), quarter.cast("string")).alias("quarter_name"),
        D.quarter_start(d).alias("first_day_of_quarter"),
        D.quarter_end(d).alias("last_day_of_quarter"),
        F.year(d).alias("year"),
        D.fiscal_year(d).alias("fiscal_year"),
        D.decade(d).alias("decade"),
        D.century(d).alias("century"),
        F.lit(False).alias("is_holiday"),
    ]


def with_comments(df: DataFrame, comments: dict[str, str]) -> DataFrame:
    for name, text in comments.items():
        df = df.withMetadata(name, {"comment": text})
    return df


def data_dictionary(df: DataFrame) -> DataFrame:
    """Per column: column_name, data_type, missing values, and the comment that its schema carries (null if none)."""
    texts = {f.name: f.metadata.get("comment") for f in df.schema.fields}
    comment = reduce(lambda col, c: col.when(F.col("column_name") == c, F.lit(texts[c])), texts, F.when(F.lit(False), ""))
    return null_counts(df).withColumn("comment", comment)


def date_dim(spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END) -> DataFrame:
    """One row per day from start to end, both included."""
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    days = spark.range(1).select(F.explode(F.sequence(first, last)).alias("d"))
    return with_comments(days.select(*date_columns(F.col("d"))), CALENDAR_COMMENTS)


def calendar_for(df: DataFrame, column: str) -> DataFrame:
    """Date dimension from the first to the last date found in `column`."""
    bounds = df.agg(F.min(column).alias("a"), F.max(column).alias("b")).filter(F.col("a").isNotNull())
    days = bounds.select(F.explode(F.sequence("a", "b")).alias("d"))
    return with_comments(days.select(*date_columns(F.col("d"))), CALENDAR_COMMENTS)

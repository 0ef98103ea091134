import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillroll.constants import DAY_NAMES, DAY_PARTS, REVENUE_SEGMENTS
from tillroll.functions import dates as D
from tillroll.functions import labels as L
from tillroll.functions import numbers as N


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


@pytest.mark.parametrize("value,digits,expected", [(0.285, 2, 0.29), (1.005, 2, 1.01), (-0.285, 2, -0.29), (2.5, 0, 3.0)])
def test_rounding_is_half_up_on_decimal_text(spark, value, digits, expected):
    assert one(spark, N.rounded(F.lit(value), digits)) == expected


def test_division_guards(spark):
    assert one(spark, N.safe_div(F.lit(1), F.lit(0))) is None
    assert one(spark, N.change_percent(F.lit(50), F.lit(0))) is None
    assert one(spark, N.int_div(F.lit(-1).cast("bigint"), F.lit(2).cast("bigint"))) == 0
    assert one(spark, N.int_div(F.lit(7).cast("bigint"), F.lit(0).cast("bigint"))) is None


def test_report_texts(spark):
    assert one(spark, N.grouped_amount(F.lit("1234567.5").cast("decimal(18,2)"))) == "1 234 567.50"
    assert one(spark, N.grouped_amount(F.lit("0.5").cast("decimal(18,2)"))) == ".50"
    assert one(spark, N.percent_text(F.lit(0.15254))) == "15.25%"


@settings(max_examples=15, deadline=None)
@given(st.dates(dt.date(1900, 1, 1), dt.date(2100, 12, 31)))
def test_date_functions_against_python(spark, d):
    col = F.lit(d)
    got = spark.range(1).select(
        D.iso_weekday(col), D.sunday_weekday(col), D.day_name(col), D.week_start(col), D.week_ending_monday(col),
        D.century(col), D.decade(col), D.fiscal_year(col), D.week_of_month(col), D.quarter_end(col),
    ).first()
    monday = d - dt.timedelta(days=d.weekday())
    next_quarter = dt.date(d.year + (d.month > 9), (d.month - 1) // 3 * 3 % 12 + 4 if d.month <= 9 else 1, 1)
    assert tuple(got) == (
        d.isoweekday(), d.isoweekday() % 7, DAY_NAMES[d.weekday()], monday,
        d if d.weekday() == 0 else monday + dt.timedelta(days=7),
        (d.year - 1) // 100 + 1, d.year // 10 * 10, d.year + (d.month >= 7), (d.day - 1) // 7 + 1,
        next_quarter - dt.timedelta(days=1),
    )


def at(text):
    return F.lit(f"2025-07-01 {text}").cast("timestamp_ntz")


@pytest.mark.parametrize("clock,part", [
    ("07:59:59", "Outside hours"), ("08:00:00", "Morning"), ("10:59:59.9", "Morning"), ("11:00:00", "Afternoon"),
    ("16:00:00", "Evening"), ("20:00:00", "Evening"), ("20:00:00.5", "Outside hours"), ("20:00:01", "Outside hours"),
])
def test_day_part_edges(spark, clock, part):
    assert one(spark, L.time_of_day(at(clock))) == part


@pytest.mark.parametrize("clock,place", [
    ("10:59:59", None), ("11:00:00", 0), ("13:59:59", 0), ("13:59:59.5", 0), ("14:00:00", 1), ("16:59:59", 1), ("17:00:00", 2), ("23:00:00", 2),
])
def test_segment_edges(spark, clock, place):
    expected = None if place is None else REVENUE_SEGMENTS[place]
    assert one(spark, L.day_segment(D.second_of_day(at(clock)), REVENUE_SEGMENTS)) == expected


def test_labels(spark):
    assert one(spark, L.in_list(F.lit("Outside hour"), DAY_PARTS)) is None
    assert one(spark, L.category_rank(F.lit("Evening"), DAY_PARTS)) == 2
    assert one(spark, L.category_rank(F.lit("Night"), DAY_PARTS)) is None
    assert one(spark, L.safe_name(F.lit(" Лист #1/2 a-b_c "))) == "Лист _1_2 a-b_c"
    assert one(spark, D.clock_text(F.lit(45296))) == "12:34:56"
    assert one(spark, L.title_case(F.lit("iced LATTE macchiato"))) == "Iced Latte Macchiato"


def test_as_of_defaults_to_today(spark):
    assert one(spark, D.as_of_date(None) == F.current_date()) is True


def test_smallest_label_equals_min(spark):
    df = spark.createDataFrame([(1, "Tuesday"), (1, "Friday"), (2, "Sunday"), (3, None)], "k int, d string")
    got = df.groupBy("k").agg(L.smallest_label(F.col("d"), DAY_NAMES).alias("a"), F.min("d").alias("b")).collect()
    assert all(r.a == r.b for r in got)


def test_optional_range(spark):
    df = spark.range(1).select(F.lit("2025-07-05 10:00:00").cast("timestamp_ntz").alias("t"))
    assert df.filter(D.in_range(F.col("t"))).count() == 1
    assert df.filter(D.in_range(F.col("t"), "2025-07-05", "2025-07-06")).count() == 1
    assert df.filter(D.in_range(F.col("t"), None, "2025-07-05")).count() == 0

"""Calendar and time-of-day functions."""

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll.constants import DAY_NAMES


def as_of_date(as_of: str | dt.date | None) -> Column:
    """The report date; today unless given."""
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def in_range(col: Column, start=None, end=None) -> Column:
    """Half-open range with optional bounds; no bound means no filter."""
    keep = F.lit(True)
    if start is not None:
        keep = keep & (col >= F.lit(str(start)).cast("timestamp_ntz"))
    if end is not None:
        keep = keep & (col < F.lit(str(end)).cast("timestamp_ntz"))
    return keep


def iso_weekday(d: Column) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return F.weekday(d) + 1


def sunday_weekday(d: Column) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(d) - 1


def day_name(d: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in DAY_NAMES]), iso_weekday(d))


def is_weekend(d: Column) -> Column:
    return F.weekday(d) >= 5


def week_start(d: Column) -> Column:
    """Monday of the week."""
    return F.trunc(d, "week")


def week_ending_monday(d: Column) -> Column:
    """The Monday on which a Tuesday-to-Monday week ends."""
    return F.next_day(F.date_sub(d, 1), "Mon")


def month_start(d: Column) -> Column:
    return F.trunc(d, "month")


def quarter_start(d: Column) -> Column:
    return F.trunc(d, "quarter")


def quarter_end(d: Column) -> Column:
    return F.date_sub(F.add_months(quarter_start(d), 3), 1)


def week_of_month(d: Column) -> Column:
    """Days 1-7 are week 1, 8-14 week 2, and so on."""
    return (F.floor((F.dayofmonth(d) - 1) / 7) + 1).cast("int")


def fiscal_year(d: Column, first_month: int = 7) -> Column:
    return F.year(d) + F.when(F.month(d) >= first_month, 1).otherwise(0)


def decade(d: Column) -> Column:
    return (F.floor(F.year(d) / 10) * 10).cast("int")


def century(d: Column) -> Column:
    return (F.floor((F.year(d) - 1) / 100) + 1).cast("int")


def second_of_day(ts: Column) -> Column:
    """Whole seconds since midnight; sub-second parts are dropped, so ranges stay half-open."""
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def clock_text(seconds: Column) -> Column:
    """Seconds of the day as HH:mm:ss."""
    part = lambda value: F.lpad(F.floor(value).cast("string"), 2, "0")
    return F.concat_ws(":", part(seconds / 3600), part((seconds % 3600) / 60), part(seconds % 60))


def minutes_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(6e7)


def hour_label(hour: Column) -> Column:
    return F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit(":00"))


def day_label(iso_day: Column) -> Column:
    """'1. Monday' ... '7. Sunday'."""
    names = F.array(*[F.lit(f"{i}. {n}") for i, n in enumerate(DAY_NAMES, 1)])
    return F.element_at(names, iso_day)

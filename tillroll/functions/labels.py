"""Labels derived from times and names."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll.constants import (
    AFTERNOON_START,
    DAY_PARTS,
    EVENING_LAST,
    EVENING_START,
    MORNING_START,
    SEGMENT_START,
)


def time_of_day(ts: Column) -> Column:
    """Day part of a timestamp: [08,11), [11,16), [16,20:00:00], else outside hours."""
    second = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.extract(F.lit("SECOND"), ts)
    morning, afternoon, evening, outside = DAY_PARTS
    return (
        F.when((second >= MORNING_START) & (second < AFTERNOON_START), morning)
        .when((second >= AFTERNOON_START) & (second < EVENING_START), afternoon)
        .when((second >= EVENING_START) & (second <= EVENING_LAST), evening)
        .otherwise(outside)
    )


def day_segment(seconds: Column, names: list[str]) -> Column:
    """Three-hour segment of a second of the day; null before the first one."""
    label = F.lit(None).cast("string")
    for start, name in zip(SEGMENT_START, names):
        label = F.when(seconds >= start, F.lit(name)).otherwise(label)
    return label


def in_list(col: Column, categories: list[str]) -> Column:
    """The value if it is a declared category, else null."""
    return F.when(col.isin(categories), col)


def category_rank(col: Column, categories: list[str]) -> Column:
    """0-based position in the declared order; null for an undeclared value."""
    position = F.array_position(F.array(*[F.lit(c) for c in categories]), col)
    return F.when(position > 0, (position - 1).cast("int"))


def smallest_label(col: Column, categories: list[str]) -> Column:
    """Aggregate: alphabetically first label of a closed list.

    Same result as min(label), but over a number, so the group-by stays a hash aggregate.
    """
    ordered = F.array(*[F.lit(c) for c in sorted(categories)])
    first = F.min(F.nullif(F.array_position(ordered, col), F.lit(0).cast("bigint")))
    return F.try_element_at(ordered, first.cast("int"))


def safe_name(col: Column) -> Column:
    """Letters, digits, blank, '_' and '-' stay; anything else becomes '_'."""
    return F.trim(F.regexp_replace(col, r"[^\p{L}\p{N} _-]", "_"))


def title_case(col: Column) -> Column:
    """First letter of each word in upper case, the rest in lower case."""
    return F.initcap(col)

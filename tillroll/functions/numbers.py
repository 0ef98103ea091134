"""Money, ratios and rounding.

Money is summed as decimal and divided once, in double. The quotient goes through
decimal(38,8) before `round`, so 0.285 rounds up to 0.29 whatever its binary form.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = "decimal(18,2)"


def present(df: DataFrame, name: str) -> Column:
    """The column with NaN turned into null: both count as missing everywhere."""
    col = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(col), col)
    return col


def rounded(col: Column, digits: int = 2) -> Column:
    """Half-up rounding as double."""
    return F.round(col.cast("decimal(38,8)"), digits).cast("double")


def safe_div(num: Column, den: Column) -> Column:
    """Division in double; null when the denominator is zero."""
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def ratio(num: Column, den: Column, digits: int = 2, scale: float = 1.0) -> Column:
    return rounded(safe_div(num, den) * F.lit(float(scale)), digits)


def percent(num: Column, den: Column, digits: int = 2) -> Column:
    return ratio(num, den, digits, 100.0)


def change_percent(current: Column, previous: Column, digits: int = 2) -> Column:
    """Growth against the previous value; null for a missing or zero previous value."""
    return percent(current - previous, previous, digits)


def int_div(num: Column, den: Column) -> Column:
    """Whole quotient truncated toward zero; null when the denominator is zero."""
    return F.call_function("div", num, F.nullif(den, F.lit(0).cast("bigint")))


def clamp(col: Column, low: Column, high: Column) -> Column:
    return F.when(col.isNotNull(), F.greatest(low, F.least(high, col)))


def grouped_amount(col: Column) -> Column:
    """1234567.5 -> '1 234 567.50'. Zero keeps no leading digit: '.50' for 0.5."""
    text = F.translate(F.format_number(F.round(col.cast("decimal(38,2)"), 2), 2), ",", " ")
    return F.regexp_replace(text, r"^(-?)0\.", "$1.")


def percent_text(share: Column) -> Column:
    """0.15254 -> '15.25%'."""
    value = F.round((share * 100).cast("decimal(38,8)"), 2)
    return F.concat(F.translate(F.format_number(value, 2), ",", ""), F.lit("%"))

"""Row-based windows over already aggregated series (one row per key and day)."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.numbers import ratio, rounded
from tillroll.operators.joins import join_keys


def series(order: str, by: tuple[str, ...] = ()) -> WindowSpec:
    """Window along `order`. Without `by` it holds the whole series in one task, so the
    input must already be at day, week or category grain."""
    return Window.partitionBy(*by).orderBy(order) if by else Window.orderBy(order)


def trailing(window: WindowSpec, rows: int) -> WindowSpec:
    """The current row and the rows - 1 before it."""
    return window.rowsBetween(1 - rows, Window.currentRow)


def moving_average(col: str, window: WindowSpec, rows: int, min_periods: int = 1, digits: int = 6) -> Column:
    """Mean of the trailing rows; null until `min_periods` values are there."""
    frame = trailing(window, rows)
    count = F.count(col).over(frame)
    return F.when(count >= max(min_periods, 1), ratio(F.sum(col).over(frame), count, digits))


def moving_stddev(col: str, window: WindowSpec, rows: int, min_periods: int | None = None, digits: int = 6) -> Column:
    """Sample standard deviation of the trailing rows; a full window unless `min_periods` is given."""
    frame = trailing(window, rows)
    need = rows if min_periods is None else min_periods
    value = F.stddev_samp(F.col(col).cast("double")).over(frame)
    return F.when(F.count(col).over(frame) >= max(need, 2), rounded(value, digits))


def with_moving_stats(
    df: DataFrame, col: str, order: str, by: tuple[str, ...], rows: int,
    mean: dict[str, int] | None = None, std: dict[str, int | None] | None = None, digits: int = 6,
) -> DataFrame:
    """`moving_average` and `moving_stddev` of whole or decimal numbers under the given names (name: `min_periods`), at a cost a row that
    does not depend on `rows`.

    Running counts, sums and sums of squares are exact, so the difference between the current row and the one `rows` before is too. Doubles,
    whose differences would cancel, are refused.
    """
    kind = df.schema[col].dataType
    if not isinstance(kind, (T.IntegralType, T.DecimalType)):
        raise TypeError(f"{col} has no exact sums")
    along = series(order, by)
    upto = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    value = F.col(col).cast("decimal(20,0)") if isinstance(kind, T.IntegralType) else F.col(col)
    running = {"_c": F.count(value), "_s": F.sum(value), "_q": F.sum(value * value)}
    sums = df.withColumns({name: F.coalesce(total.over(upto), F.lit(0)) for name, total in running.items()})
    sums = sums.withColumns({f"{name}0": F.coalesce(F.lag(name, rows).over(along), F.lit(0)) for name in running})
    count, total, squares = (F.col(name) - F.col(f"{name}0") for name in running)
    spread = (count * squares - total * total).cast("double") / (count * (count - 1)).cast("double")
    out = {name: F.when(count >= max(least, 1), ratio(total, count, digits)) for name, least in (mean or {}).items()}
    for name, least in (std or {}).items():
        out[name] = F.when(count >= max(rows if least is None else least, 2), rounded(F.sqrt(spread), digits))
    return sums.withColumns(out).drop(*running, *[f"{name}0" for name in running])


def with_group_stats(df: DataFrame, by: tuple[str, ...], **stats: Column) -> DataFrame:
    """Each row plus aggregates of its group; rows with a null key form a group.

    An aggregate and a join, not a window: a hot group is combined map-side and its rows
    stay spread (adaptive execution broadcasts small aggregates and splits skewed joins).
    """
    table = df.groupBy(*by).agg(*[col.alias(name) for name, col in stats.items()])
    return join_keys(df, table, by, "left")


def fill_days(df: DataFrame, day: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Add the missing days between each group's first and last day, other columns null."""
    bounds = df.groupBy(*by).agg(F.min(day).alias("_a"), F.max(day).alias("_b"))
    days = bounds.select(*by, F.explode(F.sequence("_a", "_b")).alias(day))
    return days.join(df, [*by, day], "left")


def top_n(df: DataFrame, n: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(n)


def dense_rank_top(df: DataFrame, value: str, k: int, name: str = "rnk") -> DataFrame:
    """Rows whose value is among the k largest distinct ones, with that dense rank."""
    best = df.select(value).distinct().orderBy(F.desc(value)).limit(k)
    best = best.withColumn(name, F.row_number().over(Window.orderBy(F.desc(value))))
    return df.join(best, value)


def kth_largest(df: DataFrame, value: str, k: int) -> Column:
    """Scalar: the k-th largest value, ties counted (the smallest one if there are fewer)."""
    return df.select(value).orderBy(F.desc(value)).limit(k).agg(F.min(value)).scalar()

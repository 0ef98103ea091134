"""Exact results that need a global order, without sorting everything in one task.

Values are cut into blocks by boundaries that follow the data, each block is ordered on its
own, and what comes before a block is a running sum over the short list of blocks. The
boundaries depend on the data alone, so a retried task or a second scan puts every row in
the same block, and no job runs when the query is built.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.numbers import present, rounded
from tillroll.operators.joins import join_keys

#: Rows wanted in a block, sampled values to each of its boundaries, and most sampled values of all blocks.
ROWS, OVER, MARKS = 1 << 17, 32, 1 << 21
#: A sketch finds ranks to within rows / ACCURACY; windows around a quantile reach five times as far. Groups of up to FEW rows
#: need no window: there, a rank is more of a share of the rows than that.
ACCURACY, MARGIN, FEW = 50_000, 1e-4, 100_000


def as_number(df: DataFrame, name: str) -> Column:
    """Increasing number for a numeric, date or timestamp column."""
    return as_number_of(df, name, F.col(name))


def as_number_of(df: DataFrame, name: str, col: Column) -> Column:
    """The same for an expression of the column's type."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(col)
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), col)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(col)
    if isinstance(kind, T.NumericType):
        return col
    raise TypeError(f"{name} has no numeric order")


def _marks(df: DataFrame, name: str, key: tuple[str, ...]) -> DataFrame:
    """Sorted values of about one row in ROWS / OVER, taken by a hash of the row's key, at most about MARKS of them."""
    n = df.agg(F.count("*")).scalar()
    step = F.greatest(F.lit(ROWS // OVER), n / F.lit(MARKS)).cast("bigint")
    taken = df.filter(F.col(name).isNotNull() & (F.pmod(F.xxhash64(*key), step) == 0))
    return taken.agg(F.array_sort(F.collect_list(name)).alias("marks"))


def with_value_block(df: DataFrame, name: str, key: tuple[str, ...] = ()) -> DataFrame:
    """Add `_block`, a non-decreasing block number of a value of any type with an order; equal values share a block, null is in
    the first.

    The boundaries are values of the column, every OVER-th of a sample that a hash of the row's `key` (default: the value)
    draws, so they follow the data whatever its type, its band or its outliers, are the same in each run, and grow in number
    with the rows: a block has about ROWS of them, or one in MARKS / OVER of all if that is more. They are part of the one lazy
    plan, and the driver sees only the boundaries. A value is placed by binary search.
    """
    marks = _marks(df, name, tuple(key) or (name,))
    cuts = marks.select(F.array_distinct(F.filter("marks", lambda _, i: (i + 1) % OVER == 0)).alias("at"))
    # powers of two up to the number of boundaries, the largest first
    powers = F.filter(F.array(*[F.lit(1 << i) for i in reversed(range(31))]), lambda p: p <= F.size("at"))
    cuts = cuts.select(F.struct("at", powers.alias("powers"))).scalar()
    placed = df.withColumn("_cuts", cuts)
    passed = lambda at, p: F.coalesce(F.get("_cuts.at", at + p - 1) < F.col(name), F.lit(False))
    block = F.aggregate("_cuts.powers", F.lit(0), lambda at, p: F.when(passed(at, p), at + p).otherwise(at))
    return placed.withColumn("_block", block.cast("bigint")).drop("_cuts")


def _join_blocks(rows: DataFrame, blocks: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Block values back to their rows. Blocks bound the skew, so without groups (whose keys may be null) a plain join
    reuses the partitioning by block that the windows need."""
    return join_keys(rows, blocks, (*by, "_block")) if by else rows.join(blocks, "_block")


def running_total(
    df: DataFrame, order: str, weight: str, by: tuple[str, ...] = (), descending: bool = False
) -> DataFrame:
    """Add `running` (cumulative weight, equal order values share one step) and `grand_total`."""
    by = tuple(by)
    steps = df.groupBy(*by, order).agg(F.sum(weight).alias("_step"))
    steps = with_value_block(steps, order, (*by, order))
    block_key = F.col("_block").desc() if descending else F.col("_block")
    value_key = F.col(order).desc() if descending else F.col(order)
    upto = Window.partitionBy(*by).orderBy(block_key).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*by)
    blocks = (
        steps.groupBy(*by, "_block").agg(F.sum("_step").alias("_sum"))
        .withColumn("_before", F.sum("_sum").over(upto) - F.col("_sum"))
        .withColumn("grand_total", F.sum("_sum").over(whole))
        .drop("_sum")
    )
    inside = Window.partitionBy(*by, "_block").orderBy(value_key).rowsBetween(Window.unboundedPreceding, 0)
    steps = (
        _join_blocks(steps, blocks, by)
        .withColumn("running", F.col("_before") + F.sum("_step").over(inside))
        .select(*by, order, "running", "grand_total")
    )
    return join_keys(df, steps, (*by, order))


def _windows(quantiles: dict[str, float]) -> list[tuple[float, float]]:
    return [(max(0.0, p - MARGIN), min(1.0, p + MARGIN)) for p in quantiles.values()]


def _cut_shares(quantiles: dict[str, float]) -> list[float]:
    """Ends of the windows around the quantiles, as shares of the rows."""
    return sorted({end for window in _windows(quantiles) for end in window})


def _slot(x: Column, n: Column, cuts: Column, quantiles: dict[str, float]) -> tuple[Column, Column]:
    """Whether a value is counted by itself, and the gap between two ends that it lies in."""
    cut = {c: F.get(cuts, k) for k, c in enumerate(_cut_shares(quantiles))}
    inside = reduce(lambda a, b: a | b, [x.between(cut[low], cut[high]) for low, high in _windows(quantiles)])
    between = reduce(lambda a, b: a + b, [F.when(c < x, 1).otherwise(0) for c in cut.values()])
    return (n <= FEW) | inside, between


def _picked(slots: DataFrame, value: str, quantiles: dict[str, float], by: tuple[str, ...]) -> DataFrame:
    """Per group the values at the two ranks next to each quantile, from counts `_n` of values from `_low` to `_high`."""
    upto = Window.partitionBy(*by).orderBy("_low").rowsBetween(Window.unboundedPreceding, 0)
    slots = slots.withColumn("_end", F.sum("_n").over(upto)).withColumn("_start", F.col("_end") - F.col("_n"))
    missed = F.raise_error(f"the sketch of {value} is off its bound").cast("double")
    number = F.when(F.col("_low") == F.col("_high"), F.col("_low").cast("double")).otherwise(missed)
    picks = []
    for name, p in quantiles.items():
        at = (F.col("_known") - 1) * F.lit(float(p))
        for side, rank in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            here = (F.col("_start") <= rank) & (rank < F.col("_end"))
            picks.append(F.max(F.when(here, number)).alias(f"_{side}_{name}"))
    return slots.groupBy(*by).agg(*picks)


def _between_picks(quantiles: dict[str, float], n: Column, digits: int) -> list[Column]:
    columns = []
    for name, p in quantiles.items():
        at = (n - 1) * F.lit(float(p))
        step = F.col(f"_hi_{name}") - F.col(f"_lo_{name}")
        columns.append(rounded(F.col(f"_lo_{name}") + step * (at - F.floor(at)), digits).alias(name))
    return columns


def distribution(
    df: DataFrame, value: str, quantiles: dict[str, float], by: tuple[str, ...] = (), digits: int = 4
) -> DataFrame:
    """Per group: n (known values), n_rows (all), total, min_value, max_value and exact linear-interpolated quantiles.

    Null and NaN are not known; a group without a known value has n = 0. Two passes in one lazy plan: the first keeps the sums
    and a sketch of each group, whose size does not grow with the data. The sketch names a narrow window of values around each
    quantile. The second pass counts each value inside a window by itself and all values between two windows as one row, so
    only those few rows are shuffled and ordered. A sketch that missed its error bound would put a quantile between the
    windows; that is an error at run time, not a wrong result.
    """
    by = tuple(by)
    rows = df.select(*by, present(df, value).alias("_v")).withColumn("_x", as_number_of(df, value, F.col("_v")).cast("double"))
    cuts = _cut_shares(quantiles)
    whole = isinstance(df.schema[value].dataType, T.IntegralType)
    stats = rows.groupBy(*by).agg(
        F.count("_v").alias("n"), F.count("*").alias("n_rows"), F.sum(F.col("_v").cast("decimal(20,0)") if whole else "_v").alias("total"), F.min("_v").alias("min_value"),
        F.max("_v").alias("max_value"), F.percentile_approx("_x", cuts, ACCURACY).alias("cuts"),
    ).select(*by, F.struct("n", "n_rows", "total", "min_value", "max_value", "cuts").alias("_s"))
    # the groups' sketches are a small table, broadcast if its measured size allows; without groups they are one row
    with_stats = lambda part: join_keys(part, stats, by) if by else part.withColumn("_s", stats.scalar())
    rows = with_stats(rows)
    alone, between = _slot(F.col("_x"), F.col("_s.n"), F.col("_s.cuts"), quantiles)
    alone = F.col("_v").isNotNull() & alone
    slots = rows.groupBy(*by, between.alias("_slot"), F.when(alone, F.col("_v")).alias("_at")).agg(
        F.count("_v").alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"), F.max("_s.n").alias("_known")
    )
    found = with_stats(_picked(slots, value, quantiles, by))
    columns = _between_picks(quantiles, F.col("_s.n"), digits)
    counts = [F.coalesce(f"_s.{c}", F.lit(0)).alias(c) for c in ("n", "n_rows")]
    return found.select(*by, *counts, "_s.total", "_s.min_value", "_s.max_value", *columns)


def distributions(df: DataFrame, columns: list[str], quantiles: dict[str, float], digits: int = 4) -> DataFrame:
    """One row per column: column_name, n (known values), mean, std, min_value, max_value and exact quantiles, in double.

    One aggregate over the table keeps what `distribution` keeps of each column; a second pass turns each value into its gap,
    or into itself inside a window, and combines those before they move, so that no row of the table is shuffled, whatever
    the number of its columns. A column without known values, or an empty table, has n = 0.
    """
    x = [as_number_of(df, c, present(df, c)).cast("double") for c in columns]
    aggregates = lambda c: F.struct(
        F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"), F.min(c).alias("min_value"), F.max(c).alias("max_value"),
        F.percentile_approx(c, _cut_shares(quantiles), ACCURACY).alias("cuts"),
    )
    stats = df.agg(F.array(*map(aggregates, x)).alias("_all"))
    rows = df.withColumns({f"_x{i}": c for i, c in enumerate(x)}).select(*[f"_x{i}" for i in range(len(x))], stats.scalar().alias("_all"))
    cells = []
    for i in range(len(x)):
        value, of = F.col(f"_x{i}"), F.get("_all", F.lit(i))
        alone, between = _slot(value, of["n"], of["cuts"], quantiles)
        cells.append(F.struct(F.lit(i).alias("_i"), between.alias("_slot"), F.when(alone, value).alias("_at"), value.alias("_v"), of["n"].alias("_all_n")))
    slots = rows.select(F.inline(F.array(*cells))).filter("_v is not null").groupBy("_i", "_slot", "_at").agg(
        F.count("*").alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"), F.max("_all_n").alias("_known")
    )
    found = _picked(slots, "a column", quantiles, ("_i",))
    names = F.element_at(F.array(*map(F.lit, columns)), F.col("_i") + 1)
    each = stats.select(F.posexplode("_all").alias("_i", "_s")).withColumn("column_name", names)
    return each.join(found, "_i", "left").select(
        "column_name", "_s.n", "_s.mean", "_s.std", "_s.min_value", "_s.max_value", *_between_picks(quantiles, F.col("_s.n"), digits)
    )


def interpolate(df: DataFrame, column: str, order: str | tuple[str, ...], by: tuple[str, ...] = ()) -> DataFrame:
    """Fill missing values linearly by row position along `order`, which must be unique per group: give as many columns
    as that takes.

    Leading gaps stay null; trailing gaps take the last known value. Null order values come first.
    """
    by, order = tuple(by), (order,) if isinstance(order, str) else tuple(order)
    start, here = Window.unboundedPreceding, Window.currentRow
    number = present(df, column).cast("double")
    blocked = with_value_block(df, order[0], (*by, *order)).withColumn("_value", number)
    blocked = blocked.withColumn("_block", F.when(F.col(order[0]).isNull(), -1).otherwise(F.col("_block")))
    up = Window.partitionBy(*by, "_block").orderBy(*order)
    known = F.when(F.col("_value").isNotNull(), F.struct(F.col("_pos").alias("p"), F.col("_value").alias("v")))
    # the next known value comes from the same sort as the previous one
    keys, along = (", ".join(f"`{c}`" for c in names) for names in ((*by, "_block"), order))
    following = F.expr(f"lead(_known, 1) IGNORE NULLS OVER (PARTITION BY {keys} ORDER BY {along})")
    rows = (
        blocked.withColumn("_pos", F.row_number().over(up).cast("bigint"))
        .withColumn("_known", known)
        .withColumn("_prev", F.last("_known", ignorenulls=True).over(up.rowsBetween(start, here)))
        .withColumn("_next", following)
    )
    seen = F.when(F.col("_value").isNotNull(), F.col("_pos"))
    number = F.col("_value")
    blocks = rows.groupBy(*by, "_block").agg(
        F.count("*").alias("_rows"),
        F.max(seen).alias("_lp"),
        F.max_by(number, seen).alias("_lv"),
        F.min(seen).alias("_fp"),
        F.min_by(number, seen).alias("_fv"),
    )
    earlier = Window.partitionBy(*by).orderBy("_block").rowsBetween(start, -1)
    later = Window.partitionBy(*by).orderBy(F.col("_block").desc()).rowsBetween(start, -1)
    blocks = blocks.withColumn("_offset", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    end_of = lambda p, v: F.when(F.col(p).isNotNull(), F.struct((F.col("_offset") + F.col(p)).alias("p"), F.col(v).alias("v")))
    blocks = blocks.select(
        *by,
        "_block",
        "_offset",
        F.last(end_of("_lp", "_lv"), ignorenulls=True).over(earlier).alias("_carry_prev"),
        F.last(end_of("_fp", "_fv"), ignorenulls=True).over(later).alias("_carry_next"),
    )
    moved = lambda side: F.when(
        F.col(side).isNotNull(),
        F.struct((F.col("_offset") + F.col(f"{side}.p")).alias("p"), F.col(f"{side}.v").alias("v")),
    )
    whole = (
        _join_blocks(rows, blocks, by)
        .withColumn("_at", F.col("_offset") + F.col("_pos"))
        .withColumn("_prev", F.coalesce(moved("_prev"), F.col("_carry_prev")))
        .withColumn("_next", F.coalesce(moved("_next"), F.col("_carry_next")))
    )
    slope = (F.col("_next.v") - F.col("_prev.v")) / (F.col("_next.p") - F.col("_prev.p"))
    filled = (
        F.when(number.isNotNull(), number)
        .when(F.col("_prev").isNull(), F.lit(None))
        .when(F.col("_next").isNull(), F.col("_prev.v"))
        .otherwise(F.col("_prev.v") + slope * (F.col("_at") - F.col("_prev.p")))
    )
    return whole.withColumn(column, filled).select(*df.columns)

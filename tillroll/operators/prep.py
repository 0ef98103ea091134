"""Data preparation: missing values, duplicates, outliers, encoding, scaling, line fit.

Operators with parameters learned from data come in two steps: `fit_*` returns a small
DataFrame or list learned from one frame, `apply_*` uses it on any frame.
"""

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.numbers import clamp, present, safe_div
from tillroll.operators.ordered import distribution, interpolate, running_total
from tillroll.operators.pivots import listed


def mode_of(df: DataFrame, column: str) -> DataFrame:
    """One row: the most frequent value that is not missing, the smallest of ties.

    Counts first, so only distinct values meet in the last step.
    """
    counts = df.filter(present(df, column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n"))
    return counts.orderBy(F.desc("_n"), F.asc(column)).limit(1).select(column)


def fill_statistic(df: DataFrame, column: str, strategy: str):
    """The fill value as a scalar column."""
    if strategy == "mean":
        return df.agg(F.avg(present(df, column).cast("double"))).scalar()
    if strategy == "median":
        return distribution(df, column, {"median": 0.5}).select("median").scalar()
    if strategy == "most_frequent":
        return mode_of(df, column).scalar()
    raise ValueError(f"unknown strategy {strategy!r}")


def handle_missing(
    df: DataFrame,
    strategy: str,
    columns: list[str] | None = None,
    order: str | tuple[str, ...] | None = None,
    by: tuple[str, ...] = (),
    fit_on: DataFrame | None = None,
) -> DataFrame:
    """mean, median or most_frequent fill, drop, or interpolate along `order`. Null and NaN are missing.

    Without `columns`: all columns for drop and most_frequent, else all numeric ones that are no order or group.
    """
    if columns is None:
        used = {*([order] if isinstance(order, str) else order or ()), *by}
        every = strategy in ("drop", "most_frequent")
        columns = [f.name for f in df.schema.fields if every or isinstance(f.dataType, T.NumericType) and f.name not in used]
    if strategy == "drop":
        return df.dropna(subset=columns)
    if strategy == "interpolate":
        if order is None:
            raise ValueError("interpolate needs an order column")
        for column in columns:
            df = interpolate(df, column, order, by)
        return df
    learned = df if fit_on is None else fit_on
    return df.withColumns({c: F.coalesce(present(df, c), fill_statistic(learned, c, strategy)) for c in columns})


def remove_duplicates(df: DataFrame, subset: list[str] | None = None, order: tuple[str, ...] = ()) -> DataFrame:
    """Distinct rows, or of the rows equal in `subset` the first by `order`, which has to be stated."""
    if not subset:
        return df.distinct()
    if not order:
        raise ValueError("the first row of a subset needs an order")
    first = Window.partitionBy(*subset).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(first)).filter(F.col("_n") == 1).drop("_n")


def drop_empty_rows(df: DataFrame) -> DataFrame:
    """Rows in which every column is null are left out."""
    return df.dropna(how="all")


def iqr_limits(df: DataFrame, column: str, threshold: float = 1.5) -> DataFrame:
    """One row: lower and upper fence from the quartiles."""
    spread = (F.col("q3") - F.col("q1")) * threshold
    return distribution(df, column, {"q1": 0.25, "q3": 0.75}).select(
        (F.col("q1") - spread).alias("lower"), (F.col("q3") + spread).alias("upper")
    )


def handle_outliers(df: DataFrame, column: str, threshold: float = 1.5) -> DataFrame:
    """Values outside the fences are moved onto them."""
    box = iqr_limits(df, column, threshold).select(F.struct("lower", "upper").alias("b")).scalar()
    boxed = df.withColumn("_box", box)
    value = present(df, column).cast("double")
    return boxed.withColumn(column, clamp(value, F.col("_box.lower"), F.col("_box.upper"))).drop("_box")


def fit_onehot(df: DataFrame, columns: list[str]) -> dict[str, list]:
    """Sorted categories per column, None last where a value is missing. They become columns, so a column with more than
    MOST_COLUMNS of them is an error; `onehot_index` and `onehot_sparse` take any number."""
    found = {}
    for c in columns:
        values = listed(df.select(present(df, c).alias(c)).distinct(), f"{c} has too many categories for columns: use onehot_sparse")
        found[c] = sorted(v for v in values if v is not None) + [None] * (None in values)
    return found


def _unknown(df: DataFrame, column: str, seen, handle_unknown: str):
    """`seen` itself, or an error at run time for a value that was not fitted."""
    if handle_unknown == "ignore":
        return seen
    if handle_unknown != "error":
        raise ValueError(f"unknown handle_unknown {handle_unknown!r}")
    text = F.concat(F.lit(f"{column}: unknown category "), F.coalesce(F.col(f"`{column}`").cast("string"), F.lit("null")))
    return F.when(seen, seen).otherwise(F.raise_error(text).cast("boolean"))


def apply_onehot(df: DataFrame, categories: dict[str, list], handle_unknown: str = "ignore") -> DataFrame:
    """Replace each column by 0/1 columns `col_value`, `col_None` for a fitted missing value; an unseen value gives
    all zeros, or an error."""
    for column, values in categories.items():
        value = present(df, column)
        same = {v: value.eqNullSafe(F.lit(v)) for v in values}
        seen = _unknown(df, column, reduce(lambda a, b: a | b, same.values(), F.lit(False)), handle_unknown)
        flags = {f"{column}_{v}": F.when(seen & is_v, 1.0).otherwise(0.0) for v, is_v in same.items()}
        df = df.withColumns(flags).drop(column)
    return df


def fit_ordinal(df: DataFrame, column: str) -> DataFrame:
    """Dictionary (category, code) in sorted order from 0, at the grain of distinct values; a missing value has none."""
    words = df.select(present(df, column).alias("category"), F.lit(1).alias("_one"))
    words = words.filter(F.col("category").isNotNull()).distinct()
    return running_total(words, "category", "_one").select("category", (F.col("running") - 1).alias("code"))


def apply_ordinal(df: DataFrame, column: str, dictionary: DataFrame, handle_unknown: str = "ignore") -> DataFrame:
    """Replace the column by its code; null stays null, an unseen value is -1, or an error. Spark broadcasts a small
    dictionary."""
    names = df.columns
    coded = df.join(dictionary.withColumnRenamed("category", column), column, "left")
    code = F.when(present(df, column).isNotNull(), F.coalesce("code", F.lit(-1)))
    if handle_unknown == "error":
        seen = _unknown(df, column, F.col("code").isNotNull(), handle_unknown)
        code = F.when(present(df, column).isNotNull(), F.when(seen, F.col("code")))
    return coded.withColumn(column, code).select(*names)


def onehot_index(df: DataFrame, column: str, fit_on: DataFrame | None = None) -> DataFrame:
    """One-hot without a column per value: the column becomes the place of its 1 among the sorted categories, with the
    missing value last if the fitted data has it; null where all would be 0."""
    learned = df if fit_on is None else fit_on
    dictionary = fit_ordinal(learned, column)
    names = df.columns
    gaps = learned.agg(F.count_if(present(learned, column).isNull())).scalar()
    last = F.when(gaps > 0, dictionary.agg(F.count("*")).scalar())
    coded = df.join(dictionary.withColumnRenamed("category", column), column, "left")
    return coded.withColumn(column, F.when(present(df, column).isNull(), last).otherwise(F.col("code"))).select(*names)


def onehot_sparse(df: DataFrame, columns: list[str], fit_on: DataFrame | None = None, name: str = "features") -> DataFrame:
    """One-hot of several columns as one sparse vector: they are replaced by `name`, an array of (index, value) in order of
    index, with the categories of the first column first. A missing or unseen value has no entry. Nothing is listed on the
    driver, so the number of categories is not bounded."""
    learned = df if fit_on is None else fit_on
    before, entries = F.lit(0).cast("bigint"), []
    kept = [c for c in df.columns if c not in columns]
    coded = df
    for i, column in enumerate(columns):
        dictionary = fit_ordinal(learned, column)
        coded = coded.join(dictionary.select(F.col("category").alias(column), F.col("code").alias(f"_code{i}")), column, "left")
        place = F.when(present(df, column).isNotNull(), F.col(f"_code{i}"))
        entries.append(F.when(place.isNotNull(), F.struct((before + place).alias("index"), F.lit(1.0).alias("value"))))
        before = before + dictionary.agg(F.count("*")).scalar()
    return coded.select(*kept, F.array_compact(F.array(*entries)).alias(name))


def encode_categorical(
    df: DataFrame, columns: list[str], method: str = "onehot", fit_on: DataFrame | None = None, handle_unknown: str = "ignore"
) -> DataFrame:
    """onehot: a column per category; onehot_index: one column with the category's place; onehot_sparse: one vector of all
    columns; ordinal: a column with the category's code."""
    learned = df if fit_on is None else fit_on
    if method == "onehot":
        return apply_onehot(df, fit_onehot(learned, columns), handle_unknown)
    if method == "onehot_index":
        for column in columns:
            df = onehot_index(df, column, learned)
        return df
    if method == "onehot_sparse":
        return onehot_sparse(df, columns, learned)
    if method == "ordinal":
        for column in columns:
            df = apply_ordinal(df, column, fit_ordinal(learned, column), handle_unknown)
        return df
    raise ValueError(f"unknown method {method!r}")


def standard_scale(df: DataFrame, columns: list[str], fit_on: DataFrame | None = None) -> DataFrame:
    """(x - mean) / population deviation; a constant column becomes 0."""
    learned = df if fit_on is None else fit_on
    stats = []
    for c in columns:
        x = present(learned, c).cast("double")
        stats += [F.avg(x).alias(f"m_{c}"), F.stddev_pop(x).alias(f"s_{c}")]
    row = learned.agg(*stats).select(F.struct("*")).scalar()
    scaled = df.withColumn("_fit", row)
    values = {}
    for c in columns:
        shifted = present(df, c).cast("double") - F.col(f"_fit.m_{c}")
        values[c] = F.when(F.col(f"_fit.s_{c}") == 0, shifted).otherwise(safe_div(shifted, F.col(f"_fit.s_{c}")))
    return scaled.withColumns(values).drop("_fit")


def preprocess(
    df: DataFrame, num_cols: list[str], cat_cols: list[str], fit_on: DataFrame | None = None, sparse: bool = False
) -> DataFrame:
    """Numbers: mean fill, then scale. Categories: most frequent fill, then one-hot; `sparse` gives one vector `features`
    instead of a column per category."""
    learned = df if fit_on is None else fit_on
    filled = handle_missing(df, "mean", num_cols, fit_on=learned)
    filled = handle_missing(filled, "most_frequent", cat_cols, fit_on=learned)
    learned_filled = handle_missing(learned, "mean", num_cols)
    scaled = standard_scale(filled, num_cols, fit_on=learned_filled)
    # filling with the mode adds no category and leaves none missing
    if sparse:
        return onehot_sparse(scaled, cat_cols, fit_on=learned)
    known = {c: [v for v in values if v is not None] for c, values in fit_onehot(learned, cat_cols).items()}
    return apply_onehot(scaled, known)


def fit_line(df: DataFrame, x: str, y: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Least-squares slope and intercept, per group."""
    fx, fy = F.col(x).cast("double"), F.col(y).cast("double")
    return df.groupBy(*by).agg(F.regr_slope(fy, fx).alias("slope"), F.regr_intercept(fy, fx).alias("intercept"))


def predict_line(model: DataFrame, x: float, name: str = "prediction") -> DataFrame:
    return model.withColumn(name, F.col("slope") * F.lit(float(x)) + F.col("intercept"))

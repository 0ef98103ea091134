"""Pivots, declared categories, histograms and cell ranks."""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.numbers import rounded, safe_div

OTHER = "other"


#: Values that may become columns of a plan.
MOST_COLUMNS = 10_000


def listed(values: DataFrame, too_many: str) -> list:
    """The rows of a one-column frame as a list, for use as columns; more than MOST_COLUMNS are an error."""
    found = [r[0] for r in values.limit(MOST_COLUMNS + 1).collect()]
    if len(found) > MOST_COLUMNS:
        raise ValueError(too_many)
    return found


def distinct_values(df: DataFrame, column: str) -> list:
    """Sorted distinct non-null values, which become columns."""
    values = df.select(column).filter(F.col(column).isNotNull()).distinct()
    return sorted(listed(values, f"{column} has too many values for columns: declare some, with `other` for the rest"))


def pivot_table(
    df: DataFrame, index: tuple[str, ...], column: str, value: Column, values: list | None = None, fill=None, other: str | None = None
) -> DataFrame:
    """One column per value of `column`; give `values` to avoid the job that lists them. With `other`, values that are
    not listed (null too) share the column of that name; without it they are left out."""
    values = distinct_values(df, column) if values is None else list(values)
    if other is not None:
        df = df.withColumn(column, F.when(F.col(column).isin(values), F.col(column)).otherwise(F.lit(other)))
        values = [*values, other]
    table = df.groupBy(*index).pivot(column, values).agg(value)
    return table if fill is None else table.fillna(fill, subset=[str(v) for v in values])


def with_row_total(df: DataFrame, columns: list[str], name: str = "row_total") -> DataFrame:
    """Sum of the columns to the cent, nulls counted as 0."""
    cells = [F.coalesce(F.col(f"`{c}`"), F.lit(0)) for c in columns]
    return df.withColumn(name, rounded(reduce(lambda a, b: a + b, cells)))


def literal_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A few literal rows whose size the optimizer knows, so joins with them are broadcast."""
    cells = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema.fields)]) for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*cells)))


def with_categories(df: DataFrame, column: str, categories: list, fill=0) -> DataFrame:
    """One row per declared category in declared order; missing ones filled, others dropped."""
    schema = T.StructType([T.StructField("_rank", T.IntegerType()), df.schema[column]])
    declared = literal_table(df.sparkSession, list(enumerate(categories)), schema)
    joined = declared.join(df, column, "left").orderBy("_rank").drop("_rank")
    others = [c for c in df.columns if c != column]
    return joined.fillna(fill, subset=others).select(*df.columns)


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Counts in equal-width bins over [min, max]; the last bin is closed, empty bins are kept."""
    value = F.col(column).cast("double")
    bounds = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi")).select(F.struct("lo", "hi")).scalar()
    placed = df.filter(value.isNotNull()).select(value.alias("v"), bounds.alias("b"))
    width = F.col("b.hi") - F.col("b.lo")
    bin_no = F.when(width > 0, F.least(F.floor((F.col("v") - F.col("b.lo")) * bins / width), F.lit(bins - 1))).otherwise(0)
    counts = placed.groupBy(bin_no.cast("int").alias("bin")).agg(F.count("*").alias("n"))
    edge = lambda i: rounded(F.col("_b.lo") + (F.col("_b.hi") - F.col("_b.lo")) * i / bins, 4)
    all_bins = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (
        all_bins.join(counts, "bin", "left")
        .withColumn("_b", bounds)
        .select("bin", edge(F.col("bin")).alias("bin_start"), edge(F.col("bin") + 1).alias("bin_end"),
                F.coalesce("n", F.lit(0)).alias("n"))
        .orderBy("bin")
    )


def percent_rank_average(df: DataFrame, value: str, name: str = "rank") -> DataFrame:
    """Average rank divided by the number of cells (ties share the mean rank)."""
    order, ties, cells = Window.orderBy(value), Window.partitionBy(value), Window.partitionBy()
    mean_rank = F.rank().over(order) + (F.count("*").over(ties) - 1) / 2
    return df.withColumn(name, rounded(safe_div(mean_rank, F.count("*").over(cells)), 6))

"""Profiles and data-quality audits. Every function returns a DataFrame and collects nothing."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.constants import DAY_PARTS
from tillroll.functions.numbers import present, ratio, rounded
from tillroll.operators.joins import join_keys
from tillroll.operators.ordered import distribution, distributions
from tillroll.operators.receipts import KEY, TOTAL, dedup, items_per_receipt, line_count, receipts


def null_counts(df: DataFrame) -> DataFrame:
    """Rows of (column_name, data_type, missing), one scan for all columns; null and NaN are missing."""
    counts = df.agg(*[F.count_if(present(df, c).isNull()).alias(c) for c in df.columns])
    entries = [
        F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("data_type"), F.col(c).alias("missing"))
        for c, t in df.dtypes
    ]
    return counts.select(F.inline(F.array(*entries)))


def row_digest(df: DataFrame) -> list[Column]:
    """Two 64-bit hashes of a row, the second also of which columns are null."""
    whole = [F.col(f"`{c}`") for c in df.columns]
    return [F.xxhash64(*whole), F.xxhash64(*[c.isNull() for c in whole], *whole)]


def row_counts(df: DataFrame) -> DataFrame:
    """row_count, duplicates (rows beyond the first of each identical set) and column_count.

    Rows are counted by a digest of 16 bytes, combined before they move. Only rows whose digest occurs again are compared as
    a whole, so the result is exact, also where different rows share a digest.
    """
    first, second = row_digest(df)
    marked = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), first.alias("_d1"), second.alias("_d2"))
    digests = marked.groupBy("_d1", "_d2").agg(F.count("*").alias("_n"))
    again = digests.filter("_n > 1").select("_d1", "_d2")
    groups = marked.join(again, ["_d1", "_d2"], "left_semi").groupBy("_d1", "_d2", "_row").agg(F.count("*").alias("_n"))
    duplicates = groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"))
    counted = digests.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"))
    return counted.select("row_count", duplicates.scalar().alias("duplicates"), F.lit(len(df.columns)).alias("column_count"))


def validate(df: DataFrame) -> DataFrame:
    """null_counts plus the row and duplicate counts on every row."""
    counts = row_counts(df).select(F.struct("row_count", "duplicates")).scalar()
    return null_counts(df).withColumn("_c", counts).select("*", "_c.*").drop("_c")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def describe_numeric(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """count, mean, std, min, exact quartiles and max per numeric column; no known value: count 0 and nulls."""
    profile = distributions(df, columns or numeric_columns(df), {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    return profile.select(
        "column_name", F.col("n").alias("count"), rounded(F.col("mean"), 4).alias("mean"), rounded(F.col("std"), 4).alias("std"),
        F.col("min_value").alias("min"), "q25", "q50", "q75", F.col("max_value").alias("max"),
    )


def describe_categorical(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """count, unique, top and freq per string column; the smallest of tied values is on top."""
    columns = columns or string_columns(df)
    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("v")) for c in columns])))
    counts = long.filter(F.col("v").isNotNull()).groupBy("column_name", "v").agg(F.count("*").alias("n"))
    return counts.groupBy("column_name").agg(
        F.sum("n").alias("count"),
        F.count("*").alias("unique"),
        F.min_by("v", F.struct(-F.col("n"), F.col("v"))).alias("top"),
        F.max("n").alias("freq"),
    )


def value_counts(df: DataFrame, column: str, n: int | None = None) -> DataFrame:
    """Rows per value, most frequent first, ties by value."""
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    counts = counts.orderBy(F.desc("n"), F.asc_nulls_last(column))
    return counts if n is None else counts.limit(n)


def audit_unique(lines: DataFrame, how: str = "max", **rule) -> DataFrame:
    """After dedup: rows against distinct keys."""
    return dedup(lines, how, **rule).agg(F.count("*").alias("total_rows"), F.countDistinct(KEY).alias("unique_tx"))


def audit_repeated(lines: DataFrame, how: str = "max", **rule) -> DataFrame:
    """Keys that still repeat after dedup; none is the good answer."""
    return dedup(lines, how, **rule).groupBy(KEY).agg(F.count("*").alias("cnt")).filter(F.col("cnt") > 1)


def audit_before_after(lines: DataFrame) -> DataFrame:
    """Row count before, after dedup, and distinct keys."""
    keys = lines.groupBy(KEY).agg(line_count(lines).alias("_n"))
    return keys.agg(
        F.sum("_n").alias("rows_before"), F.count("*").alias("rows_after"), F.count(KEY).alias("distinct_keys")
    )


def multi_line_receipts(lines: DataFrame) -> DataFrame:
    """All lines of receipts that have more than one line."""
    keys = lines.groupBy(KEY).agg(F.count("*").alias("_n")).filter(F.col("_n") > 1)
    return join_keys(lines.filter(F.col(KEY).isNotNull()), keys, (KEY,), "left_semi")


def audit_methods(first: DataFrame, second: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Keys on which two dedup results differ, null-safe, with both sets of values."""
    a = first.select(KEY, *[F.col(c).alias(f"{c}_1") for c in columns])
    b = second.select(KEY, *[F.col(c).alias(f"{c}_2") for c in columns])
    differs = F.lit(False)
    for c in columns:
        differs = differs | ~F.col(f"{c}_1").eqNullSafe(F.col(f"{c}_2"))
    return a.join(b, KEY, "full").filter(differs)


def audit_totals(lines: DataFrame) -> DataFrame:
    """Sum of total_cost over lines and over receipts, from one pass."""
    repeated = F.col(TOTAL) * F.col("n_items") if "n_items" in lines.columns else F.col(TOTAL)
    keys = lines.groupBy(KEY).agg(F.sum(repeated).alias("_lines"), F.max(TOTAL).alias("_receipt"))
    return keys.agg(F.sum("_lines").alias("sum_before"), F.sum("_receipt").alias("sum_after"))


def inconsistent_receipts(lines: DataFrame) -> DataFrame:
    """Receipts whose lines carry different totals."""
    spread = lines.groupBy(KEY).agg(F.min(TOTAL).alias("min_total"), F.max(TOTAL).alias("max_total"))
    return spread.filter(F.col("min_total") < F.col("max_total"))


def receipt_box(lines: DataFrame, k: float = 1.5) -> DataFrame:
    """Quartiles, upper fence, receipts above it and the largest receipt."""
    tx = receipts(lines)
    box = distribution(tx, TOTAL, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    box = box.withColumn("upper_fence", rounded(F.col("q3") + k * (F.col("q3") - F.col("q1")), 4))
    row = box.select(F.struct("q1", "median", "q3", "upper_fence", "n", "max_value")).scalar()
    above = F.col(TOTAL).cast("double") > F.col("_box.upper_fence")
    counted = tx.select(TOTAL, row.alias("_box")).agg(F.count_if(above).alias("n_outliers"), F.any_value("_box").alias("b"))
    return counted.select(
        "b.q1", "b.median", "b.q3", "b.upper_fence", "n_outliers",
        F.col("b.n").alias("n_receipts"), F.col("b.max_value").alias("max_receipt"),
    )


def order_sizes(lines: DataFrame) -> DataFrame:
    """Lines per receipt: orders, min, max, mean, median, mode and percent with exactly one.

    Distinct sizes are few (their sum is at most the number of lines), so the median reads
    (size, count) pairs directly.
    """
    sizes = items_per_receipt(lines).groupBy(F.col("n_items").alias("size")).agg(F.count("*").alias("n"))
    size, n = F.col("size"), F.col("n")
    return sizes.agg(
        F.sum(n).alias("orders"),
        F.min(size).alias("min_size"),
        F.max(size).alias("max_size"),
        ratio(F.sum(size * n), F.sum(n), 2).alias("mean_size"),
        rounded(F.percentile(size, 0.5, n), 4).alias("median_size"),
        F.max_by(size, F.struct(n, -size)).alias("mode_size"),
        ratio(F.sum(F.when(size == 1, n).otherwise(0)), F.sum(n), 1, 100.0).alias("single_percent"),
    )


def outside_hours(lines: DataFrame) -> DataFrame:
    return lines.filter(F.col("time_of_day") == DAY_PARTS[-1])


def constraint_violations(
    df: DataFrame, key: list[str], not_null: list[str] = (), checks: dict[str, Column] | None = None
) -> DataFrame:
    """Violation counts as rows (rule, violations): primary key, NOT NULL, CHECK.

    A CHECK passes on null, as in SQL.
    """
    per_key = df.groupBy(*key).agg(
        F.count("*").alias("_n"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{i}") for i, c in enumerate(not_null)],
        *[F.count_if(~c).alias(f"check_{i}") for i, c in enumerate((checks or {}).values())],
    )
    rules = [("primary key " + ", ".join(key), F.sum(F.col("_n") - 1))]
    rules += [(f"not null {c}", F.sum(f"null_{i}")) for i, c in enumerate(not_null)]
    rules += [(f"check {name}", F.sum(f"check_{i}")) for i, name in enumerate(checks or {})]
    sums = per_key.agg(*[F.coalesce(col, F.lit(0)).alias(f"r{i}") for i, (_, col) in enumerate(rules)])
    entries = [F.struct(F.lit(name).alias("rule"), F.col(f"r{i}").alias("violations")) for i, (name, _) in enumerate(rules)]
    return sums.select(F.inline(F.array(*entries)))

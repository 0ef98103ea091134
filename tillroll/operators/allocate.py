"""Splitting totals, interval lookup and row expansion, all deterministic."""

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split_total(total: Column, shares: list[tuple[str, Decimal]]) -> Column:
    """Array of (part, count) that adds up to `total`: floors, then the largest remainders
    (first listed part wins ties). One expression per row, no shuffle."""
    weight = sum(w for _, w in shares)
    exact = lambda w: total.cast("decimal(20,0)") * F.lit(w) / F.lit(weight)
    cells = [
        F.struct(
            (F.floor(exact(w)) - exact(w)).cast("decimal(20,10)").alias("minus_rest"),
            F.lit(i).alias("place"),
            F.lit(part).alias("part"),
            F.floor(exact(w)).cast("bigint").alias("base"),
        )
        for i, (part, w) in enumerate(shares)
    ]
    ordered = F.array_sort(F.array(*cells))
    left = total.cast("bigint") - F.aggregate(ordered, F.lit(0).cast("bigint"), lambda acc, c: acc + c["base"])
    return F.transform(
        ordered,
        lambda c, i: F.struct(
            c["place"].alias("place"), c["part"].alias("part"),
            (c["base"] + F.when(i < left, 1).otherwise(0)).alias("cnt"),
        ),
    )


def interval_lookup(value: Column, intervals: list[tuple]) -> Column:
    """Name of the interval that holds `value`, from (name, upper bound) in rising order; a bound belongs to the next
    interval, None as the last bound is open. Null for null and beyond a closed end."""
    name = F.lit(None).cast("string")
    for label, upper in reversed(intervals):
        inside = value.isNotNull() if upper is None else value < F.lit(upper)
        name = F.when(inside, F.lit(label)).otherwise(name)
    return name


def expand_by_count(df: DataFrame, count: str, name: str = "seq", chunk: int = 100_000) -> DataFrame:
    """Each row repeated `count` times with a number from 1; none for count <= 0.

    Large counts are cut into chunks first and the chunks spread over tasks, so one
    huge count neither builds a huge array nor stays in one task.
    """
    n = F.col(count).cast("bigint")
    starts = F.sequence(F.lit(0).cast("bigint"), n - 1, F.lit(chunk).cast("bigint"))
    chunks = df.filter(n > 0).withColumn("_start", F.explode(starts)).repartition("_start", *df.columns)
    stop = F.least(n, F.col("_start") + chunk)
    return chunks.withColumn(name, F.explode(F.sequence(F.col("_start") + 1, stop))).drop("_start")

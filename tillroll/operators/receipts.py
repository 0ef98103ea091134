"""Receipt grain: one row per transaction.

A receipt's total is repeated on each of its lines, so money and traffic are computed
after reducing lines to receipts. All variants are group-bys with map-side combine,
except `row_number`, which Spark limits per partition before the shuffle. First and last rows of numbers, dates, times and
money are least and greatest numbers, so they are hash aggregates; other types are sorted.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.packing import packed, unpacked

KEY = "transaction_id"
TOTAL = "total_cost"


def receipts(lines: DataFrame, *attributes: Column, by: tuple[str, ...] = ()) -> DataFrame:
    """transaction_id, total_cost = MAX over the lines, plus aggregate `attributes`."""
    return lines.groupBy(KEY, *by).agg(F.max(TOTAL).alias(TOTAL), *attributes)


def consistent_receipts(lines: DataFrame, *attributes: Column) -> DataFrame:
    """Receipts whose lines all carry the same total."""
    return receipts(lines, F.min(TOTAL).alias("_least"), *attributes).filter(
        F.col(TOTAL) == F.col("_least")
    ).drop("_least")


def line_count(lines: DataFrame) -> Column:
    """Aggregate: number of lines. A frame already reduced to receipts carries `n_items`."""
    return F.sum("n_items") if "n_items" in lines.columns else F.count("*")


def dedup(
    lines: DataFrame,
    how: str,
    columns: tuple[str, ...] = (TOTAL,),
    order: tuple[str, ...] = (),
) -> DataFrame:
    """Lines reduced to receipts by a named rule; they differ on dirty data only.

    max          one row per id, largest total
    max_by_date  one row per id and sale_date, largest total
    distinct     distinct (id, total) pairs
    first_row    the first line by `order`, ties by the columns themselves
    last_row     the last line by `order`
    row_number   the last line by `order` through ROW_NUMBER() = 1
    first_value  per column, the first non-null value by `order`, the least of ties
    consistent   ids with one total only
    """
    if how == "max":
        return receipts(lines)
    if how == "max_by_date":
        return receipts(lines, by=("sale_date",))
    if how == "distinct":
        return lines.select(KEY, TOTAL).distinct()
    if how == "consistent":
        return consistent_receipts(lines)
    if not order:
        raise ValueError(f"{how} needs an explicit order")
    sort = F.struct(*order)
    if how in ("first_row", "last_row"):
        pick = F.min if how == "first_row" else F.max
        fields = list(dict.fromkeys((*order, *columns)))
        numbers = packed(lines, fields)
        if numbers:
            found = lines.groupBy(KEY).agg(*[pick(numbers[fields.index(c)]).alias(c) for c in columns])
            return found.select(KEY, *[unpacked(F.col(c), lines.schema[c].dataType).alias(c) for c in columns])
        whole = F.struct(sort.alias("o"), F.struct(*columns).alias("c"))
        return lines.groupBy(KEY).agg(pick(whole).alias("_row")).select(KEY, "_row.c.*")
    if how == "row_number":
        last = Window.partitionBy(KEY).orderBy(*[F.desc(c) for c in order], *[F.desc(c) for c in columns])
        ranked = lines.withColumn("_n", F.row_number().over(last)).filter(F.col("_n") == 1)
        return ranked.select(KEY, *columns)
    if how == "first_value":
        picks, values = [], []
        for c in columns:
            fields = list(dict.fromkeys((*order, c)))
            numbers, known = packed(lines, fields), F.col(c).isNotNull()
            if numbers:
                picks.append(F.min(F.when(known, numbers[fields.index(c)])).alias(c))
                values.append(unpacked(F.col(c), lines.schema[c].dataType).alias(c))
            else:
                least = F.min(F.when(known, F.struct(sort.alias("o"), F.col(c).alias("c"))))
                picks.append(least.alias(c))
                values.append(F.col(f"{c}.c").alias(c))
        return lines.groupBy(KEY).agg(*picks).select(KEY, *values)
    raise ValueError(f"unknown rule {how!r}")


def items_per_receipt(lines: DataFrame) -> DataFrame:
    return receipts(lines, line_count(lines).alias("n_items"))

"""Customer lifetime value by first-order month."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.dates import month_start
from tillroll.functions.numbers import ratio


def cohort_ltv_margin(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Cumulative net margin per cohort member, by cohort month and margin month.

    Margins are summed per user and month before cohorts are attached, so the user join
    moves one row per user and month. A cohort month counts all of a user's orders, also
    those without a known product; the margin and the cohort size only priced ones.
    """
    cost = F.col("unit_cost") * F.col("quantity")
    priced = orders.join(products, orders.product_id == products.id, "left")
    months = priced.groupBy("user_id", month_start(F.col("order_date")).alias("margin_month")).agg(
        F.sum(F.col("amount") - cost).alias("_margin"), F.count("id").alias("_priced")
    )
    # one row per user and month: a user's window is bounded by the calendar
    user = Window.partitionBy("user_id")
    priced_month = F.when(F.col("_priced") > 0, F.col("margin_month"))
    months = months.withColumns(
        {"cohort_month": F.min("margin_month").over(user), "_first_priced": F.min(priced_month).over(user)}
    ).filter(F.col("_priced") > 0)
    # a member is counted in the month of the first priced order
    margins = months.groupBy("cohort_month", "margin_month").agg(
        F.sum("_margin").alias("_margin"), F.count_if(F.col("margin_month") == F.col("_first_priced")).alias("_joined")
    )
    cohort = Window.partitionBy("cohort_month")
    upto = cohort.orderBy("margin_month").rowsBetween(Window.unboundedPreceding, 0)
    return margins.select(
        "cohort_month",
        "margin_month",
        ratio(F.sum("_margin").over(upto), F.sum("_joined").over(cohort)).alias("ltv_margin"),
    ).orderBy("cohort_month", "margin_month")

"""Demand and reorder planning for all products at once.

Sales are first summed per product and day (map-side), so a product's window holds one
row per day however many sales it has.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.constants import SERVICE_LEVELS, Z_BY_SERVICE_LEVEL
from tillroll.functions.dates import as_of_date, clock_text, second_of_day
from tillroll.functions.numbers import rounded
from tillroll.operators.joins import join_keys
from tillroll.operators.windows import moving_average, series, with_moving_stats
from tillroll.sources.files import write_csv


def daily_product_sales(sales: DataFrame) -> DataFrame:
    return sales.groupBy("product_id", F.col("sale_date").cast("date").alias("sale_date")).agg(
        F.sum("quantity").alias("daily_sales")
    )


def falling_demand(sales: DataFrame, products: DataFrame, as_of=None, days: int = 90, window: int = 7) -> DataFrame:
    """Product days that sold less than the day before and less than the trailing mean."""
    since = F.date_sub(as_of_date(as_of), days).cast("timestamp_ntz")
    daily = daily_product_sales(sales.filter(F.col("sale_date") >= since))
    along = series("sale_date", ("product_id",))
    step = F.coalesce(F.col("daily_sales") - F.lag("daily_sales").over(along), F.lit(0))
    metrics = daily.withColumn("diff", step).withColumn(
        "moving_avg_7d", moving_average("daily_sales", along, window, digits=2)
    )
    falling = metrics.filter((F.col("diff") < 0) & (F.col("daily_sales").cast("double") < F.col("moving_avg_7d")))
    return falling.join(products, "product_id").select(
        "product_id", "category", "model_name", "sale_date", "daily_sales", "diff", "moving_avg_7d"
    ).orderBy(F.desc("sale_date"), F.asc("diff"), F.asc("product_id"))


def export_falling_demand(sales: DataFrame, products: DataFrame, path: str, **params) -> str:
    """Write the falling-demand report as CSV part files and return the folder."""
    return write_csv(falling_demand(sales, products, **params), path)


def sales_enriched(
    sales: DataFrame, products: DataFrame, inventory: DataFrame, ordered: bool = False, *, days: DataFrame | None = None, undated: bool = True
) -> DataFrame:
    """Line grain: sales with product and same-day stock entries.

    A product day with several stock entries repeats the sale. `ordered` adds a global sort
    by date, a full shuffle of the result.

    Product and stock meet at the product days that were sold, which are combined before they move. The lines then move
    once, by product and day, so a hot product is spread over its days and a hot day of it may be split. `days` gives
    (product_id, sale_date) of the sales if they are at hand without the other columns; days without a sale do no harm.
    `undated=False` says that every sale has a date; then lines bucketed by product_id and sale_date do not move.
    """
    key = ["product_id", F.col("sale_date").cast("date").alias("sale_date")]
    sold = (sales if days is None else days).select(*key).distinct()
    stock = inventory.select("product_id", F.col("date").alias("sale_date"), "stock_on_hand", "operation_type")
    entries = sold.join(stock, ["product_id", "sale_date"], "left").join(products, "product_id")
    lines = sales.filter("product_id is not null").withColumns({"sale_time": clock_text(second_of_day(F.col("sale_date"))), "sale_date": F.col("sale_date").cast("date")})
    joined = join_keys(lines, entries, ("product_id", "sale_date")) if undated else lines.join(entries, ["product_id", "sale_date"])
    result = joined.select(
        "product_id", "category", "model_name", "cost_price", "sale_price", "sale_id", "sale_date", "sale_time",
        "quantity", (F.col("quantity") * F.col("sale_price")).alias("revenue"), "customer_id", "stock_on_hand", "operation_type",
    )
    return result.orderBy("sale_date") if ordered else result


def reorder_point(
    sales: DataFrame, window: int = 30, min_periods: int = 7, lead_time: int = 7, z: float = 1.65
) -> DataFrame:
    """Daily demand with its trailing mean and deviation, reorder point, safety stock and band."""
    stats = with_moving_stats(
        daily_product_sales(sales), "daily_sales", "sale_date", ("product_id",), window,
        mean={"rolling_avg": min_periods}, std={"rolling_std": min_periods},
    )
    return stock_targets(stats, lead_time, F.lit(float(z)))


def stock_targets(stats: DataFrame, lead_time: int, z) -> DataFrame:
    """Reorder point = mean x lead time; safety stock = z x deviation x sqrt(lead time)."""
    point = F.col("rolling_avg") * lead_time
    safety = z * F.col("rolling_std") * F.sqrt(F.lit(float(lead_time)))
    return stats.withColumns(
        {
            "reorder_point": rounded(point, 4),
            "safety_stock": rounded(safety, 4),
            "lower_band": rounded(point - safety, 4),
            "upper_band": rounded(point + safety, 4),
        }
    )


def reorder_signal(
    sales: DataFrame,
    stock: DataFrame,
    service_levels: dict[str, float] = SERVICE_LEVELS,
    window: int = 30,
    min_periods: int = 7,
    lead_time: int = 7,
) -> DataFrame:
    """Per product: order when stock is at or below the latest reorder point.

    The safety stock uses the service level of the product's class.
    """
    stats = reorder_point(sales, window, min_periods, lead_time)
    latest = stats.groupBy("product_id").agg(
        F.max_by("rolling_avg", "sale_date").alias("rolling_avg"), F.max_by("rolling_std", "sale_date").alias("rolling_std")
    )
    z = F.lit(None).cast("double")
    for name, level in service_levels.items():
        z = F.when(F.col("service_class") == name, F.lit(Z_BY_SERVICE_LEVEL[level])).otherwise(z)
    targets = stock_targets(stock.join(latest, "product_id", "left"), lead_time, z)
    return targets.select(
        "product_id", "stock", "reorder_point", "safety_stock",
        F.coalesce(F.col("stock") <= F.col("reorder_point"), F.lit(False)).alias("reorder_flag"),
    )


def demand_volatility(sales: DataFrame, window: int = 30, min_periods: int = 7) -> DataFrame:
    """Trailing deviation with and without a minimum number of days."""
    return with_moving_stats(
        daily_product_sales(sales), "daily_sales", "sale_date", ("product_id",), window, std={"std_no_min": None, "std_with_min": min_periods}
    )

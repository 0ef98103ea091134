"""Tables: create, load, insert, query, derive."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.constants import DRINK_PRICES, DRINK_WEIGHTS
from tillroll.functions.labels import time_of_day
from tillroll.operators.pivots import literal_table
from tillroll.sources.files import read_csv
from tillroll.sources.schemas import DIM_COFFEE, DRINK_PRICE_REF


def create_table(spark: SparkSession, name: str, schema: T.StructType, replace: bool = True) -> None:
    """An empty Parquet table with the schema, column comments included."""
    if replace:
        drop(spark, name)
    spark.createDataFrame([], schema).write.format("parquet").saveAsTable(name)


def drop(spark: SparkSession, name: str) -> None:
    """DROP TABLE / VIEW IF EXISTS."""
    if name in {v.name for v in spark.catalog.listTables() if v.isTemporary}:
        spark.catalog.dropTempView(name)
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def insert_into(df: DataFrame, table: str, overwrite: bool = False) -> None:
    """INSERT INTO table SELECT ...; columns are matched by name."""
    target = df.sparkSession.table(table).columns
    df.select(*target).write.insertInto(table, overwrite=overwrite)


def load_csv_into(spark: SparkSession, path: str, table: str, schema: T.StructType, mode: str = "append", **options) -> None:
    """Load a file into a table: append, or overwrite to start a new one."""
    read_csv(spark, path, schema, **options).write.mode(mode).format("parquet").saveAsTable(table)


def write_bucketed(df: DataFrame, table: str, key: str | list[str], buckets: int) -> None:
    """A table hashed and sorted by one or more columns: group-bys and joins on them need no shuffle."""
    df.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def run_query(spark: SparkSession, text: str, **tables: DataFrame) -> DataFrame:
    """SQL text over the catalog and the DataFrames passed by name; lazy, nothing is fetched."""
    return spark.sql(text, **tables) if tables else spark.sql(text)


def read_jdbc(
    spark: SparkSession, url: str, table: str, key: str, low: int, high: int, partitions: int, properties: dict
) -> DataFrame:
    """A database table read in parallel key ranges; filters and columns go to the database."""
    return spark.read.jdbc(
        url, table, column=key, lowerBound=low, upperBound=high, numPartitions=partitions, properties=properties
    )


def write_jdbc(df: DataFrame, url: str, table: str, mode: str, properties: dict) -> None:
    df.write.jdbc(url, table, mode=mode, properties=properties)


def dim_coffee(spark: SparkSession) -> DataFrame:
    """Drinks with their share of all drinks sold."""
    total = sum(n for _, n in DRINK_WEIGHTS)
    rows = [(i, name, n / total) for i, (name, n) in enumerate(DRINK_WEIGHTS, 1)]
    return literal_table(spark, rows, DIM_COFFEE)


def drink_price_ref(spark: SparkSession) -> DataFrame:
    return literal_table(spark, DRINK_PRICES, DRINK_PRICE_REF)


def attach_price(lines: DataFrame, prices: DataFrame) -> DataFrame:
    """Reference price by name; null for a name the reference does not have."""
    return lines.join(prices, "coffee_name", "left")


def add_time_of_day(lines: DataFrame) -> DataFrame:
    """The day part as a new column, from `datetime`."""
    return lines.withColumn("time_of_day", time_of_day(F.col("datetime")))


def union_all(first: DataFrame, *more: DataFrame) -> DataFrame:
    """Rows of all frames, columns matched by name; a column that a frame lacks is null there."""
    for other in more:
        first = first.unionByName(other, allowMissingColumns=True)
    return first

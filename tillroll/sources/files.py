"""File scans and sinks. Schemas are always given, so no scan reads the data twice."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

DATE_FORMAT = "yyyy-MM-dd"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    sep: str = ",",
    encoding: str = "UTF-8",
    quote: str = '"',
    escape: str = '"',
    header: bool = True,
    date_format: str = DATE_FORMAT,
    timestamp_format: str = TIMESTAMP_FORMAT,
) -> DataFrame:
    """Delimited text with a header; a bad value fails the read instead of turning null."""
    return (
        spark.read.schema(schema)
        .option("header", header)
        .option("sep", sep)
        .option("encoding", encoding)
        .option("quote", quote)
        .option("escape", escape)
        .option("dateFormat", date_format)
        .option("timestampNTZFormat", timestamp_format)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> str:
    """A folder of part files with headers, written in parallel, UTF-8. Returns the folder."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("sep", sep)
        .option("encoding", "UTF-8")
        .option("escape", '"')
        .option("dateFormat", DATE_FORMAT)
        .option("timestampNTZFormat", TIMESTAMP_FORMAT)
        .csv(path)
    )
    return path


def write_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), mode: str = "overwrite") -> str:
    """Parquet, optionally in one folder per value, so date filters skip whole folders."""
    writer = df.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return path

"""Shared folder for written intermediate tables, and loading of the input tables."""

import os
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Removes a written table's shuffle files as soon as it is written, not when the driver next collects garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`. Where it is unset, a local session gets one of its own;
    on a cluster that is an error, because executors could not see a local folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="corpus-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def materialize(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Writes a table to the shared folder and reads it back: later steps neither recompute it nor depend on
    the executors that made it. `options` are the writer's."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}/{name}"
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Deletes tables that `materialize` wrote and that no later step reads. A table must not be used after that."""
    for df in tables:
        context = df.sparkSession.sparkContext
        folder = context._jvm.org.apache.hadoop.fs.Path(df.inputFiles()[0]).getParent()
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def name_package(spark: SparkSession) -> None:
    """Puts this package on the workers' path, for installations that only the driver's path names."""
    context = spark.sparkContext
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = context.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        context.environment["PYTHONPATH"] = os.pathsep.join(x for x in (known, root) if x)


def map_arrow(df: DataFrame, run, schema: str) -> DataFrame:
    name_package(df.sparkSession)

    def work(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()  # workers are kept for later tasks

    return df.mapInArrow(work, schema)

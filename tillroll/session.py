"""Spark session settings the recipes rely on."""

import tempfile

from pyspark.sql import SparkSession


def get_session(app: str = "tillroll", master: str | None = None, **conf: str) -> SparkSession:
    """Session in UTC with ANSI and adaptive execution on; `conf` keys use `__` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder for written intermediates: the cluster's own setting. Only a local session without one gets a folder of
    its own; elsewhere that is an error, since executors do not share local disks."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tillroll-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")

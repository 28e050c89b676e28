"""Session defaults for local runs; on a cluster the caller's session is used as it is."""

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str | None = None, app: str = "deskflow", conf: dict[str, str] | None = None) -> SparkSession:
    conf = conf or {}
    cores = cores or os.cpu_count() or 1
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    if "spark.checkpoint.dir" not in conf:
        # One machine, so any folder is shared by all tasks.
        builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="deskflow-"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark

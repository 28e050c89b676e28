"""Tables that keep their rows in buckets of a key, to be joined by it without moving them."""

import hashlib

from pyspark.sql import DataFrame, SparkSession

from deskflow import schemas
from deskflow.sources.stage import remove

# Files of a table; each should fit in a task with what it is joined with.
BUCKETS = 64
LAYOUT = "key string, buckets int, columns string"


def _name(path: str, buckets: int) -> str:
    return f"deskflow_{hashlib.sha256(path.encode()).hexdigest()[:32]}_{buckets}"


def sink_buckets(df: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> None:
    """Write one file per bucket of the key, sorted by it, and beside them how they are laid out.

    The rows are dealt by the hash the buckets are made of, so a task writes whole buckets.  A table that is there is replaced.
    """
    spark = df.sparkSession
    name = _name(path, buckets)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    remove(spark, path)
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    # Readers of a table pass over names that begin with a line.
    spark.createDataFrame([(key, buckets, columns)], LAYOUT).coalesce(1).write.json(f"{path}/_layout")


def scan_buckets(spark: SparkSession, path: str) -> DataFrame:
    """The table at a path, in any session, with its buckets known to the planner."""
    key, buckets, columns = spark.read.schema(LAYOUT).json(f"{path}/_layout").first()
    name = _name(path, buckets)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
              f"INTO {buckets} BUCKETS LOCATION '{path}'")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def sink_vector_buckets(vectors: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """The columns of a vector table in buckets of their ids: ``attach_metadata`` moves the narrow hits only."""
    sink_buckets(vectors.select(*schemas.VECTOR_TABLE.names), path, "id", buckets)

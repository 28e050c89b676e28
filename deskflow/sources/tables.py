"""Readers with pinned schemas."""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from deskflow import fixed, schemas
from deskflow.sources.stage import stage


def read(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """The columns of a schema from a table that may have more, in any order; a missing one is an error.

    CSV texts may hold line breaks, and such a file is read by one task each: import large CSV tables from
    many files, once, and keep them as Parquet (``import_csv``).
    """
    if fmt == "json":
        return spark.read.schema(schema).option("multiLine", True).json(path)
    rows = read_csv(spark, path) if fmt == "csv" else spark.read.format(fmt).load(path)
    missing = [c for c in schema.names if c not in rows.columns]
    if missing:
        raise ValueError(f"No column {', '.join(missing)} in {path}. Found columns: {rows.columns}")
    return rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns of a CSV table as text, by the names in its header."""
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    header = reader.csv(path).columns
    return reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in header])).csv(path)


def import_csv(spark: SparkSession, path: str, target: str) -> DataFrame:
    """A CSV table as Parquet, so that it is parsed once."""
    read_csv(spark, path).write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def scan_posts(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """The seven columns of raw posts, all as text."""
    return read(spark, path, schemas.POSTS, fmt)


def scan_labelled(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return read(spark, path, schemas.LABELLED, fmt)


def scan_evaluation(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return read(spark, path, schemas.EVALUATION, fmt)


def scan_human_review(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return read(spark, path, schemas.HUMAN_REVIEW, fmt)


def scan_metrics(spark: SparkSession, path: str) -> DataFrame:
    return read(spark, path, schemas.METRICS, "json")


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """A message table from a path, with ``message_id`` where it has none.

    A row of a Parquet file is known by its file and place, so nothing need be copied to number it.  CSV files have
    no such places: their rows are numbered within a written copy.
    """
    if path.rstrip("/").endswith(".csv"):
        rows = read_csv(spark, path)
        return rows if "message_id" in rows.columns else stage(
            rows.withColumn("message_id", F.monotonically_increasing_id().cast("string")), "messages")
    rows = spark.read.parquet(path)
    if "message_id" in rows.columns:
        return rows
    place = F.concat_ws(":", F.col("_metadata.file_name"), F.col("_metadata.row_index").cast("string"))
    return rows.select("*", place.alias("message_id"))


def text_column(df: DataFrame) -> str:
    """First known text column of a message table."""
    for name in fixed.TEXT_COLUMNS:
        if name in df.columns:
            return name
    raise ValueError(f"No column of {list(fixed.TEXT_COLUMNS)} in the input. Found columns: {df.columns}")


def scan_messages(df: DataFrame) -> DataFrame:
    """A message table with its text as ``text``; null text becomes ''."""
    name = text_column(df)
    others = [c for c in df.columns if c not in (name, "text")]
    return df.select(*others, F.coalesce(F.col(name).cast("string"), F.lit("")).alias("text"))


def default_column(df: DataFrame, name: str, value: str) -> DataFrame:
    """Add a constant column when the table lacks it."""
    return df if name in df.columns else df.withColumn(name, F.lit(value))


def spread(df: DataFrame) -> DataFrame:
    """Give every core a share of a table that the scan would read in fewer tasks than there are cores.

    For work that is heavy per row, on a small table.  A large table is read in many tasks and stays as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df

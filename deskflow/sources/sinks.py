"""Writers."""

from pyspark.sql import DataFrame

from deskflow import schemas

TRUTH_COLUMNS = ["ground_truth_intent", "ground_truth_escalate"]


def write(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"').option("quoteAll", True).option(
            "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.format(fmt).save(path)


def sink_predictions(predictions: DataFrame, path: str, fmt: str = "parquet", message_id: str | None = None) -> None:
    """Message id (when named), the six contract columns, and the two truth columns when they are there."""
    truth = [c for c in TRUTH_COLUMNS if c in predictions.columns]
    ids = [message_id] if message_id else []
    write(predictions.select(*ids, *schemas.PREDICTIONS.names, *truth), path, fmt)


def sink_splits(splits: DataFrame, path: str) -> None:
    """One table partitioned by split, a few files per split.  Input: at most the split totals."""
    splits.repartition("split").write.mode("overwrite").partitionBy("split").parquet(path)


def sink_metrics(document: DataFrame, path: str) -> None:
    """One-row document as JSON."""
    write(document.coalesce(1), path, "json")


def sink_vector_table(vectors: DataFrame, path: str) -> None:
    """Vectors and their texts side by side, clustered by id."""
    write(vectors.select(*schemas.VECTOR_TABLE.names).sortWithinPartitions("id"), path)



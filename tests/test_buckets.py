"""Tables in buckets."""

import pytest
from pyspark.sql import functions as F

from deskflow.operators.retrieval import attach_metadata
from deskflow.sources.buckets import scan_buckets, sink_vector_buckets


def vectors(spark, n):
    return spark.range(n).select("id", F.array(F.lit(0.5).cast("float")).alias("embedding"), *[
        F.concat(F.lit(c), F.col("id")).alias(c) for c in ("tweet", "apple_reply", "intent")], F.lit(1).alias("more"))


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_index_is_not_shuffled(spark, tmp_path, no_broadcast):
    path = str(tmp_path / "index")
    # Half of the hits are of one neighbour.
    hits = spark.range(3000).select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.when(
        F.col("id") % 2 == 0, 7).otherwise(F.col("id") * 3).alias("id"), F.lit(0.5).alias("similarity"))
    sink_vector_buckets(vectors(spark, 1000), path, buckets=3)
    sink_vector_buckets(vectors(spark, 5000), path, buckets=16)
    index = scan_buckets(spark, path)
    joined = attach_metadata(hits, index)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan
    # The scan is of the bucket files, without the vectors.
    assert "embedding" not in plan
    want = attach_metadata(hits, vectors(spark, 5000))
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, want.collect()))
    assert "more" not in index.columns and index.count() == 5000


def test_known_again_after_the_session_forgot_it(spark, tmp_path):
    path = str(tmp_path / "index")
    sink_vector_buckets(vectors(spark, 50), path, buckets=4)
    for t in spark.catalog.listTables():
        if t.name.startswith("deskflow_") and not t.isTemporary:
            spark.sql(f"DROP TABLE {t.name}")
    assert scan_buckets(spark, path).agg(F.sum("id")).first()[0] == 1225
    sink_vector_buckets(vectors(spark, 0), path, buckets=4)
    assert scan_buckets(spark, path).count() == 0

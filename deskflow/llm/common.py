"""Helpers of the operators: text as bytes, per-text Arrow functions, stages, components."""

import sys
from collections.abc import Callable, Iterator
from types import ModuleType

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from deskflow.sources.stage import stage

# Sent to the tasks with the code that uses it, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

AT_ONCE = 256
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession, rows: int = 1024) -> None:
    """Lower the session's Arrow batches to at most ``rows`` rows, for columns of whole texts.

    A batch is held by the JVM outside its heap and by the Python worker; ten thousand texts, the default, can be more
    than both have to spare.  Results do not depend on it.
    """
    now = int(spark.conf.get(_BATCH_ROWS))
    if not 0 < now <= rows:
        spark.conf.set(_BATCH_ROWS, str(rows))


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def texts_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator reads, as ``id`` and ``text``; other columns cannot clash with its own."""
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def per_text(make: Callable[[], Callable[[list], dict[str, list]]], schema: str, text: Column) -> Column:
    """Struct column computed in Python from texts, one Arrow batch after another.

    ``make`` is called once per task and gives a function from texts (``str`` or None) to columns of the struct;
    what it keeps between batches lives as long as the task.  It gets a part of a batch at a time, so that few texts are held
    as Python objects.
    """
    kind = T.StructType.fromDDL(schema)
    fields = [pa.field(f.name, to_arrow_type(f.dataType)) for f in kind]

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        work = make()
        for batch in batches:
            for start in range(0, len(batch), AT_ONCE):
                got = work(batch.slice(start, AT_ONCE).to_pylist())
                yield pa.StructArray.from_arrays([pa.array(got[f.name], f.type) for f in fields], fields=fields)
                del got

    return F.arrow_udf(run, kind)(text)


def worker_memory(key: str) -> dict:
    """A dict that lives as long as the Python worker, across its tasks; what fills it must bound it."""
    home = sys.modules.setdefault("deskflow_worker_memory", ModuleType("deskflow_worker_memory"))
    return vars(home).setdefault(key, {})


def components(edges: DataFrame) -> DataFrame:
    """Smallest node reachable from each node of the undirected edges (a, b): rows (node, root).

    Every round links the neighbours of a node to the smallest of them, first the larger ones, then the smaller
    ones, until nothing changes; the star that remains names the component.  Groups are only ever reduced by a
    minimum, so a node with very many links is no heavier than its rows.  Each round is a table in the shared
    folder, which cuts the lineage.
    """
    spark = edges.sparkSession
    both = edges.select("a", "b").where("a <> b")
    now = stage(both.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        sign = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if sign == before or not sign[0]:
            break
        before = sign
        for larger in (True, False):
            ways = now.select(F.col("a").alias("u"), F.col("b").alias("v"))
            if larger:
                ways = ways.union(now.select("b", "a"))
            least = ways.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
            ways = ways.join(least, "u")
            if larger:
                moved = ways.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
            else:
                moved = ways.where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).union(
                    least.select("u", "m").where("u <> m"))
            now = moved.where("a <> b").distinct()
        now = stage(now, "edges")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select("b", "b")).distinct() if before else spark.createDataFrame(
            [], T.StructType([T.StructField("node", edges.schema["a"].dataType),
                              T.StructField("root", edges.schema["a"].dataType)]))

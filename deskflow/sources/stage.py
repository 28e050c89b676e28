"""Stage tables in the shared folder of the cluster.

A stage cuts the lineage and survives lost executors, because it is an ordinary table on shared storage.
"""

import tempfile
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_INSIDE: ContextVar[str | None] = ContextVar("scratch", default=None)


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; in local mode without it, a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("Set spark.checkpoint.dir to a folder that all executors share.")
        folder = tempfile.mkdtemp(prefix="deskflow-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """Unused path in the shared folder."""
    folder = _INSIDE.get() or f"{shared_folder(spark)}/deskflow"
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write the rows once and go on from the table, for plans that read them more than once."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def exists(spark: SparkSession, path: str) -> bool:
    """True when a table was written there to its end; a fault of the storage is an error, not an absence."""
    place, files = _file_system(spark, f"{path}/_SUCCESS")
    return files.exists(place)


def folders(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """What follows the prefix in the names of the folders of a folder; nothing when there is no such folder."""
    place, files = _file_system(spark, path)
    if not files.exists(place):
        return []
    names = [f.getPath().getName() for f in files.listStatus(place) if f.isDirectory()]
    return [n[len(prefix):] for n in names if n.startswith(prefix)]


def remove(spark: SparkSession, path: str) -> None:
    place, files = _file_system(spark, path)
    files.delete(place, True)


def publish(spark: SparkSession, source: str, target: str, name: str) -> None:
    """Move the files of a table into the folder of another one, in place of those that came under this name before."""
    folder, files = _file_system(spark, source)
    goal = _file_system(spark, target)[0]
    if files.exists(goal):
        for old in files.listStatus(goal):
            if old.getPath().getName().startswith(f"{name}-"):
                files.delete(old.getPath(), False)
    files.mkdirs(goal)
    parts = [f.getPath() for f in files.listStatus(folder) if f.getPath().getName().startswith("part-")]
    for part in parts:
        if not files.rename(part, _file_system(spark, f"{target}/{name}-{part.getName()}")[0]):
            raise OSError(f"{part.toString()} was not moved to {target}.")
    files.delete(folder, True)


@contextmanager
def scratch(spark: SparkSession):
    """Stages made inside go to a folder of their own, which is removed at the end: nothing read later may need them."""
    folder = new_path(spark, "scratch")
    token = _INSIDE.set(folder)
    try:
        yield folder
    finally:
        _INSIDE.reset(token)
        remove(spark, folder)


def stage_skip(spark: SparkSession, path: str, compute: Callable[[], DataFrame], overwrite: bool = False) -> DataFrame:
    """Table at ``path`` when it is there, else (or with ``overwrite``) compute and write it first."""
    if overwrite or not exists(spark, path):
        compute().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)

"""Cutting lineage through tables in the folder that every executor shares.

A materialised table survives the loss of any executor: readers go back to the
shared files, never to another executor's disk. Once a table is written, the
shuffle files of the job that made it are of no more use and are removed, and
tables that later steps have consumed can be dropped.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where the setting is absent, a temporary folder is made for a local master,
    as in tests; a cluster has to name its own.
    """
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="reuselens-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the jobs run here go as soon as each job ends."""
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def materialize(df: DataFrame, name: str, codec: str = "zstd", consumed: tuple[DataFrame, ...] = ()) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    ``consumed``: tables written before that nothing reads from now on; they are dropped.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    with _shuffles_removed(spark):
        df.write.option("compression", codec).parquet(path)
    drop_tables(*consumed)
    out = spark.read.schema(df.schema).parquet(path)
    out.table_path = path
    return out


def drop_tables(*tables: DataFrame) -> None:
    """Delete tables that :func:`materialize` returned."""
    for table in tables:
        drop_path(table.sparkSession, table.table_path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a table written by :func:`materialize` or a store."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)

"""Staging tables that cut lineage and survive the loss of an executor.

All staging tables of an application lie in one folder, which ``release``
deletes. A job that runs inside ``staging`` leaves none behind, whether it ends
or fails.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder all machines of the session reach.

    That is the folder in ``spark.checkpoint.dir``, or else the one set on the
    context, or else the session's warehouse. On a cluster a warehouse in the files
    of one machine is refused: the others would not see what it holds.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    configured = configured or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    one_machine = spark.sparkContext.master.split("[")[0] == "local"
    if not one_machine and warehouse.startswith("file:"):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines reach")
    return warehouse.rstrip("/")


def application_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/churnlake-{spark.sparkContext.applicationId}"


_OWNERS: list[str] = []


def new_dir(spark: SparkSession, label: str) -> str:
    return "/".join([application_dir(spark), *_OWNERS, f"{label}-{uuid.uuid4().hex}"])


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def staging(spark: SparkSession, job: str) -> Iterator[str]:
    """A folder for the staging tables of one job, deleted at its end."""
    folder = new_dir(spark, job)
    _OWNERS.append(folder.rsplit("/", 1)[1])
    try:
        yield folder
    finally:
        _OWNERS.pop()
        _delete(spark, folder)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and go on from the stored rows.

    Row ids and range partitions are not the same in every run of a plan, so
    whatever depends on them must read them back from storage.
    """
    path = new_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete the application's staging tables; nothing may read them any more."""
    _delete(spark, application_dir(spark))

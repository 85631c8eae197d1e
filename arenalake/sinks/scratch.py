"""Folders for intermediate data."""

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from arenalake.sinks.files import delete


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share, named by ``spark.checkpoint.dir``."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the scratch root; nothing is created."""
    return f"{scratch_root(spark)}/arenalake/{name}-{uuid.uuid4().hex}"


def stored(rows: DataFrame, folder: str | None = None) -> DataFrame:
    """Write the rows to the shared folder and read them back, cutting their lineage.

    ``folder`` belongs to the caller, who deletes it when all results are written;
    without it the scratch root is used and nothing is deleted. Parquet rather than
    ``checkpoint()``, so that later steps read only the columns they need.
    """
    if folder is None:
        path = scratch_path(rows.sparkSession, "stored")
    else:
        path = f"{folder}/stored-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


@contextmanager
def scratch_of_job(spark: SparkSession, root: str) -> Iterator[str]:
    """A folder below ``root`` for one job's intermediate data, deleted when the job ends."""
    folder = f"{root}/scratch/{uuid.uuid4().hex}"
    try:
        yield folder
    finally:
        delete(spark, folder)

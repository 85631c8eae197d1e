"""Scans of day-partitioned tables."""

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arenalake.schema import DAY


def as_date(day: date | str) -> date:
    return date.fromisoformat(day) if isinstance(day, str) else day


def in_days(first: date | str, last: date | str | None = None) -> Column:
    """Partition predicate for one day, or for first to last inclusive.

    Compares with date literals, so the scan is limited to those partitions.
    """
    first = as_date(first)
    last = as_date(last) if last is not None else first
    if first == last:
        return F.col(DAY) == F.lit(first)
    return F.col(DAY).between(F.lit(first), F.lit(last))


def table_days(
    spark: SparkSession, table: str, first: date | str, last: date | str | None = None
) -> DataFrame:
    return spark.table(table).filter(in_days(first, last))


def table_day_where(spark: SparkSession, table: str, day: date | str) -> DataFrame:
    """The same scan with the predicate as SQL text."""
    return spark.table(table).where(f"{DAY} = DATE'{as_date(day).isoformat()}'")


def written_by_stream(spark: SparkSession, path: str) -> bool:
    """Whether the folder has the log of a streaming file sink."""
    log = spark._jvm.org.apache.hadoop.fs.Path(path, "_spark_metadata")
    return log.getFileSystem(spark._jsc.hadoopConfiguration()).exists(log)

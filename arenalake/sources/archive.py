"""A month of day folders."""

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from arenalake.functions.casts import month_of
from arenalake.schema import DAY
from arenalake.sources.tables import as_date, table_days, written_by_stream


def month_text(day: date | str) -> str:
    return as_date(day).strftime("%Y-%m")


def month_days(day: date | str) -> tuple[date, date]:
    """First and last day of the day's month."""
    first = as_date(day).replace(day=1)
    following = (first + timedelta(31)).replace(day=1)
    return first, following - timedelta(1)


def table_month(spark: SparkSession, table: str, day: date | str) -> DataFrame:
    """The day's month of a catalog table, whatever its format."""
    return table_days(spark, table, *month_days(day))


def json_month(spark: SparkSession, base: str, day: date | str, schema: StructType) -> DataFrame:
    """Every day folder of the day's month, as JSON rows; files that are no JSON are an error.

    ``basePath`` keeps the day column, which a plain glob would lose. The schema
    is given; inferring it would read the whole month a second time.

    Files of a stream are taken by its log: a folder may also hold files of a
    failed attempt, which a glob would read twice.
    """
    reader = spark.read.schema(schema).option("mode", "FAILFAST")
    if written_by_stream(spark, base):
        return reader.json(base).filter(month_of(DAY) == F.lit(month_text(day)))
    return reader.option("basePath", base).json(f"{base}/{DAY}={month_text(day)}-*")

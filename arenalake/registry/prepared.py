"""Tables several queries start from, built once per application and data folder."""

import re
import tempfile
from datetime import date, timedelta
from functools import cache
from uuid import uuid4

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arenalake.lake import Lake
from arenalake.operators.bronze import bronze_rows
from arenalake.operators.cluster import fit_clusters
from arenalake.plans.jobs import bronze_batch, silver_analysis, silver_train_movement
from arenalake.schema import DAY
from arenalake.sinks.scratch import scratch_path
from arenalake.sources.playerlogs import raw_playerlogs, read_table, to_messages

_SESSIONS: dict[str, SparkSession] = {}


def shared_scratch(spark: SparkSession) -> None:
    """Give a session of one process a temporary folder, if none is configured.

    The queries are checks on test tables; the jobs never do this.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not configured and re.fullmatch(r"local(\[.*\])?", context.master):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="arenalake-"))


def new_lake(spark: SparkSession, **names: str) -> Lake:
    """An empty lake of its own; ``names`` are tables it takes from elsewhere."""
    lake = Lake(scratch_path(spark, "lake"), suffix=f"_arenalake_{uuid4().hex}", names=names)
    lake.create_databases(spark)
    return lake


def _application(spark: SparkSession) -> str:
    application = spark.sparkContext.applicationId
    _SESSIONS[application] = spark
    return application


def day_range(spark: SparkSession, sf_dir: str) -> tuple[date, date]:
    """First and last day of the events."""
    return _day_range(_application(spark), sf_dir)


@cache
def _day_range(application: str, sf_dir: str) -> tuple[date, date]:
    events = read_table(_SESSIONS[application], sf_dir, "events")
    return tuple(events.agg(F.min("ts").cast("date"), F.max("ts").cast("date")).first())


def one_day(spark: SparkSession, sf_dir: str) -> date:
    """The fifth day of the events, for queries on one day."""
    return day_range(spark, sf_dir)[0] + timedelta(4)


def some_days(spark: SparkSession, sf_dir: str) -> tuple[date, date]:
    """The tenth to the twentieth day of the events."""
    first = day_range(spark, sf_dir)[0]
    return first + timedelta(9), first + timedelta(19)


def separated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A position for every event, in two groups far apart: even and odd events."""
    odd = F.pmod("event_id", F.lit(2))
    return read_table(spark, sf_dir, "events").select(
        "event_id",
        (F.pmod("event_id", F.lit(5)) + odd * 1000).cast("int").alias("x"),
        (F.pmod("event_id", F.lit(7)) - odd * 500).cast("int").alias("y"),
        F.col("ts").cast("date").alias(DAY),
    )


#: Rows of one file of landed messages. A compressed file is read by one task, so it stays small.
LANDED_ROWS = 25_000


def landed_messages(spark: SparkSession, sf_dir: str) -> str:
    """Folder with the JSON message of every event, one per line, in compressed files."""
    return _landed_messages(_application(spark), sf_dir)


@cache
def _landed_messages(application: str, sf_dir: str) -> str:
    spark = _SESSIONS[application]
    path = scratch_path(spark, "messages")
    files = to_messages(raw_playerlogs(spark, sf_dir)).write.option("maxRecordsPerFile", LANDED_ROWS)
    files.text(path, compression="gzip")
    return path


def bronze_table(spark: SparkSession, sf_dir: str) -> str:
    """Name of a bronze table of all events."""
    return _bronze_table(_application(spark), sf_dir)


@cache
def _bronze_table(application: str, sf_dir: str) -> str:
    spark = _SESSIONS[application]
    lake = new_lake(spark)
    bronze_batch(to_messages(raw_playerlogs(spark, sf_dir)), lake)
    return lake.name("playerlogs")


def silver_table(spark: SparkSession, sf_dir: str) -> str:
    """Name of an analysis table of all days."""
    return _silver_table(_application(spark), sf_dir)


@cache
def _silver_table(application: str, sf_dir: str) -> str:
    spark = _SESSIONS[application]
    lake = new_lake(spark, playerlogs=_bronze_table(application, sf_dir))
    silver_analysis(spark, lake, *_day_range(application, sf_dir))
    return lake.name("analysis_playerlogs")


def movement_table(spark: SparkSession, sf_dir: str) -> str:
    """Name of a movement training table of all days."""
    return _movement_table(_application(spark), sf_dir)


@cache
def _movement_table(application: str, sf_dir: str) -> str:
    spark = _SESSIONS[application]
    lake = new_lake(spark, playerlogs=_bronze_table(application, sf_dir))
    silver_train_movement(spark, lake, *_day_range(application, sf_dir))
    return lake.name("delta_playerlogs")


def fitted_model(spark: SparkSession, sf_dir: str) -> PipelineModel:
    return _fitted_model(_application(spark), sf_dir)


@cache
def _fitted_model(application: str, sf_dir: str) -> PipelineModel:
    return fit_clusters(bronze(_SESSIONS[application], sf_dir))


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_playerlogs(spark, sf_dir)


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows of all events, not stored."""
    return bronze_rows(raw_playerlogs(spark, sf_dir))

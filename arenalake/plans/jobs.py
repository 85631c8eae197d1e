"""The daily and monthly jobs.

Every job takes one day, or a first and a last day: a range is one Spark job
that gives the tables a run per day would give.
"""

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, timedelta
from functools import partial

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from arenalake.lake import Lake
from arenalake.operators.cluster import fit_clusters, silhouette
from arenalake.operators.gold import gold_tables
from arenalake.operators.silver import (
    analysis_rows,
    files_by_room_time,
    movement_rows,
    train_indexed_rows,
)
from arenalake.schema import DAY, SCORED_SCHEMA
from arenalake.sinks.models import publish_model, save_model
from arenalake.sinks.scratch import scratch_of_job
from arenalake.sinks.tables import append_days, month_to_parquet, replace_days
from arenalake.sources.archive import json_month, month_text, table_month
from arenalake.sources.tables import as_date, table_days
from arenalake.streaming.ingest import branches

Day = date | str
#: Days of the movement table a monthly refit reads, unless told otherwise.
REFIT_DAYS = 365


def bronze_batch(
    messages: DataFrame, lake: Lake, model: PipelineModel | None = None, **options
) -> None:
    """The stream's transforms on a batch of messages.

    Appends, as the stream does: running it again adds the rows again.
    """
    lake.create_databases(messages.sparkSession)
    bronze, quarantine = branches(messages, model, **options)
    for rows, table in ((bronze, "playerlogs"), (quarantine, "invalid_data")):
        append_days(rows, lake.name(table), lake.path(table), lake.fmt)


def silver_analysis(
    spark: SparkSession, lake: Lake, first: Day, last: Day | None = None, keep: str = "any"
) -> None:
    bronze = table_days(spark, lake.name("playerlogs"), first, last)
    rows = files_by_room_time(analysis_rows(bronze, keep))
    _replace(lake, "analysis_playerlogs", rows, first, last)


def silver_train_indexed(
    spark: SparkSession,
    lake: Lake,
    first: Day,
    last: Day | None = None,
    event_day: bool = False,
    handle_null: str = "error",
    **options,
) -> int:
    """The indexed training table; returns how many rows without champion or key were skipped.

    Partitioned by the day of the room, with the event's day in ``event_date``.
    ``event_day=True`` partitions by the event's day instead. Then a game over
    midnight, or a malformed event time, puts rows into a partition that the
    run for another day replaces, and they are lost.
    """
    bronze = table_days(spark, lake.name("playerlogs"), first, last)
    with scratch_of_job(spark, lake.root) as scratch:
        rows = train_indexed_rows(
            bronze, event_day=event_day, handle_null=handle_null, scratch=scratch, **options
        )
        days = (None, None) if event_day else (first, last)
        _replace(lake, "train_playerlogs", rows.hint("rebalance", DAY), *days)
    if handle_null != "skip":
        return 0
    blank = F.col("champion").isNull() | F.col("inputkey").isNull()
    return bronze.filter(blank).count()


def silver_train_movement(
    spark: SparkSession, lake: Lake, first: Day, last: Day | None = None, **options
) -> None:
    bronze = table_days(spark, lake.name("playerlogs"), first, last)
    with scratch_of_job(spark, lake.root) as scratch:
        rows = movement_rows(bronze, scratch=scratch, **options)
        _replace(lake, "delta_playerlogs", rows.hint("rebalance", DAY), first, last)


def gold_days(spark: SparkSession, lake: Lake, first: Day, last: Day | None = None) -> None:
    """All gold tables, side by side. Each reads only its own columns of the analysis table."""
    silver = table_days(spark, lake.name("analysis_playerlogs"), first, last)

    def write(name, table):
        rows = table.from_events(silver).hint("rebalance", DAY)
        if table.order:
            rows = rows.sortWithinPartitions(*table.order)
        _replace(lake, name, rows, first, last)

    _together([partial(write, name, table) for name, table in gold_tables().items()])


def refit(
    spark: SparkSession, lake: Lake, first: Day | None = None, last: Day | None = None, publish: bool = False
) -> tuple[PipelineModel, float]:
    """Fit on the movement table (all of it, or the given days), evaluate, save.

    ``publish`` also makes it the next version that a running stream takes up.
    """
    name = lake.name("delta_playerlogs")
    rows = spark.table(name) if first is None else table_days(spark, name, first, last)
    model = fit_clusters(rows)
    score = silhouette(model, rows)
    save_model(model, lake.model_path)
    if publish:
        publish_model(spark, model, lake.models_path)
    return model, score


def archive_month(
    spark: SparkSession,
    lake: Lake,
    day: Day,
    base: str | None = None,
    schema: StructType = SCORED_SCHEMA,
) -> str:
    """The day's month of bronze rows to one Parquet folder; returns its path.

    Reads the bronze table, whatever its format. ``base`` is a folder of JSON day
    folders to read instead, with ``schema``; other files there are an error. An
    archive that exists is replaced only by one with all rows of the source.
    """
    target = f"{lake.archive_path}/{month_text(day)}"
    if base is None:
        rows = table_month(spark, lake.name("playerlogs"), day)
    else:
        rows = json_month(spark, base, day, schema)
    month_to_parquet(rows, target)
    return target


@dataclass(frozen=True)
class RunReport:
    """What a run of the daily jobs has to tell besides its tables."""

    skipped: int  # rows without champion or key, left out of the indexed table
    model: PipelineModel | None = None  # of a refit
    silhouette: float | None = None


def run_days(
    spark: SparkSession,
    lake: Lake,
    first: Day,
    last: Day | None = None,
    keep: str = "any",
    handle_null: str = "skip",
    event_day: bool = False,
    per_room: bool = False,
    refit_from: Day | None = None,
) -> RunReport:
    """Analysis then gold tables, beside them the training tables, then maybe a refit.

    ``keep``, ``handle_null``, ``event_day`` and ``per_room`` are those of the single
    jobs; rows without champion or key are skipped and counted. The refit runs if a
    month begins in the range, and reads the movement table from ``refit_from`` to the
    last day; without it, from one year before.
    """
    lake.create_databases(spark)

    def analysis_then_gold():
        silver_analysis(spark, lake, first, last, keep)
        gold_days(spark, lake, first, last)

    results = _together(
        [
            analysis_then_gold,
            partial(
                silver_train_indexed, spark, lake, first, last, event_day, handle_null=handle_null
            ),
            partial(silver_train_movement, spark, lake, first, last, per_room=per_room),
        ]
    )
    if not _month_begins(first, last):
        return RunReport(results[1])
    until = as_date(last or first)
    model, score = refit(spark, lake, refit_from or until - timedelta(REFIT_DAYS), until)
    return RunReport(results[1], model, score)


def _together(actions: list[Callable]) -> list:
    """Run independent writes at the same time; raise the first failure, return all results."""
    with ThreadPoolExecutor(len(actions)) as pool:
        return [future.result() for future in [pool.submit(action) for action in actions]]


def _replace(
    lake: Lake, table: str, rows: DataFrame, first: Day | None, last: Day | None = None
) -> None:
    """Replace the days of the run: those without rows are emptied."""
    days = None if first is None else (first, last or first)
    replace_days(rows, lake.name(table), lake.path(table), lake.fmt, days=days)


def _month_begins(first: Day, last: Day | None) -> bool:
    first, last = as_date(first), as_date(last or first)
    return first.day == 1 or (last.year, last.month) != (first.year, first.month)

"""The message stream to the bronze and quarantine tables.

Two append queries read the source: each has its own checkpoint, so each sink is
exactly-once on its own. ``joint`` has the form with one query and one read.
The queries are map-only and keep no state.
"""

from collections.abc import Callable
from functools import partial

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from arenalake.lake import Lake
from arenalake.operators.bronze import parse_messages, split_rows
from arenalake.operators.cluster import predict
from arenalake.schema import DAY

TRIGGER = {"processingTime": "1 minute"}
BRONZE_QUERY = "arenalake_accepted"
QUARANTINE_QUERY = "arenalake_refused"


def append_stream(
    rows: DataFrame,
    checkpoint: str,
    query: str,
    fmt: str = "parquet",
    partition: str | None = DAY,
    trigger: dict | None = None,
) -> DataStreamWriter:
    writer = (
        rows.writeStream.trigger(**(trigger or TRIGGER))
        .outputMode("append")
        .format(fmt)
        .option("checkpointLocation", checkpoint)
        .queryName(query)
    )
    return writer.partitionBy(partition) if partition else writer


def to_table(writer: DataStreamWriter, table: str, path: str) -> StreamingQuery:
    return writer.option("path", path).toTable(table)


def to_files(writer: DataStreamWriter, path: str) -> StreamingQuery:
    return writer.option("path", path).start()


def branches(
    messages: DataFrame,
    model: PipelineModel | None = None,
    keep_text: bool = False,
    **split,
) -> tuple[DataFrame, DataFrame]:
    """Messages to (bronze, quarantine) rows; works on a stream and on a batch.

    ``split`` are the options of ``split_rows``.
    """
    bronze, quarantine = split_rows(parse_messages(messages, keep_text), **split)
    return (predict(model, bronze) if model else bronze), quarantine


def start_all(writers: list[tuple[DataStreamWriter, Callable]]) -> list[StreamingQuery]:
    """Start every (writer, start); if one can't be started, those that run are stopped."""
    started: list[StreamingQuery] = []
    try:
        for writer, start in writers:
            started.append(start(writer))
    except BaseException:
        for query in started:
            query.stop()
        raise
    return started


def start_table_ingest(
    messages: DataFrame,
    lake: Lake,
    model: PipelineModel | None = None,
    trigger: dict | None = None,
    **options,
) -> list[StreamingQuery]:
    """Both branches to catalog tables."""
    lake.create_databases(messages.sparkSession)
    bronze, quarantine = branches(messages, model, **options)
    return start_all([
        (
            append_stream(rows, lake.checkpoint(table), query, lake.fmt, trigger=trigger),
            partial(to_table, table=lake.name(table), path=lake.path(table)),
        )
        for rows, table, query in (
            (bronze, "playerlogs", BRONZE_QUERY),
            (quarantine, "invalid_data", QUARANTINE_QUERY),
        )
    ])


def start_json_ingest(
    messages: DataFrame,
    lake: Lake,
    model: PipelineModel | None = None,
    trigger: dict | None = None,
    **options,
) -> list[StreamingQuery]:
    """Both branches to JSON files; the quarantine is not partitioned."""
    bronze, quarantine = branches(messages, model, **options)
    quarantine = quarantine.drop(DAY)
    return start_all([
        (
            append_stream(rows, lake.checkpoint(table), query, "json", partition, trigger),
            partial(to_files, path=lake.path(table)),
        )
        for rows, table, query, partition in (
            (bronze, "playerlogs", BRONZE_QUERY, DAY),
            (quarantine, "invalid_data", QUARANTINE_QUERY, None),
        )
    ])


def run_all(queries: list[StreamingQuery], poll_seconds: float = 5) -> None:
    """Block until every query has ended; when one fails, stop the others and raise."""
    try:
        while active := [query for query in queries if query.isActive]:
            active[0].awaitTermination(poll_seconds)
            _raise_failure(queries)
        _raise_failure(queries)
    finally:
        for query in queries:
            query.stop()


def _raise_failure(queries: list[StreamingQuery]) -> None:
    for query in queries:
        if not query.isActive and query.exception() is not None:
            query.awaitTermination()

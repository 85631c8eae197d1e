"""Messages per time window."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from arenalake.lake import Lake
from arenalake.streaming.ingest import append_stream, to_files


def message_rate(
    rows: DataFrame, time: str, width: str = "1 minute", late: str | None = None
) -> DataFrame:
    """(window_start, messages). On a stream, ``late`` is the watermark delay.

    The time column may lack a zone; it is then read in the session's zone.
    """
    rows = rows.select(F.col(time).cast("timestamp").alias("time"))
    if late is not None:
        rows = rows.withWatermark("time", late)
    counts = rows.groupBy(F.window("time", width)).agg(F.count("*").alias("messages"))
    return counts.select(F.col("window.start").alias("window_start"), "messages")


def start_rate_stream(
    messages: DataFrame,
    lake: Lake,
    time: str = "timestamp",
    width: str = "1 minute",
    late: str = "10 minutes",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Counts of closed windows, appended to files below the lake's root."""
    path = f"{lake.root}/message_rate"
    checkpoint = lake.checkpoint_of("message_rate")
    rows = message_rate(messages, time, width, late)
    return to_files(
        append_stream(rows, checkpoint, "arenalake_rate", partition=None, trigger=trigger), path
    )

"""Both branches of the ingest by one query, from one read of the source.

Every micro-batch is parsed once, kept while it lasts, and written to both tables under its
number. A batch that fails between the two writes, or before its commit is logged, is run again by
Spark with the same number and messages, and takes the place of what the failed try
has written: each table holds each message once. The tables are partitioned by day and batch.

The model is looked up for each batch, so a refit takes effect without a restart;
each scored row tells the version that scored it.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from arenalake.lake import Lake
from arenalake.operators.bronze import parse_messages, split_rows
from arenalake.operators.cluster import predict
from arenalake.sinks.models import current_model
from arenalake.sinks.tables import replace_batch
from arenalake.streaming.ingest import TRIGGER

QUERY = "arenalake_both"
MODEL_VERSION = "model_version"


def start_joint_ingest(
    messages: DataFrame,
    lake: Lake,
    models: str | None = None,
    trigger: dict | None = None,
    keep_text: bool = False,
    write: Callable[..., None] = replace_batch,
    **split,
) -> StreamingQuery:
    """Accepted and refused rows to ``playerlogs`` and ``invalid_data``.

    ``models`` is a folder of published model versions; ``split`` are the options of
    ``split_rows``. ``write`` writes the rows of one batch to one table.
    """
    lake.create_databases(messages.sparkSession)

    def both(batch: DataFrame, number: int) -> None:
        parsed = parse_messages(batch, keep_text).persist()
        try:
            accepted, refused = split_rows(parsed, **split)
            if models:
                version, model = current_model(batch.sparkSession, models)
                accepted = predict(model, accepted).withColumn(MODEL_VERSION, F.lit(version))
            for rows, table in ((accepted, "playerlogs"), (refused, "invalid_data")):
                write(rows, lake.name(table), lake.path(table), number, lake.fmt)
        finally:
            parsed.unpersist()

    return (
        messages.writeStream.trigger(**(trigger or TRIGGER))
        .option("checkpointLocation", lake.checkpoint_of("both"))
        .queryName(QUERY)
        .foreachBatch(both)
        .start()
    )

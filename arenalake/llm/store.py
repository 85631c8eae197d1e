"""Tables and prefix sums that the operators share."""

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """A new folder name below ``spark.checkpoint.dir``.

    Where the setting is missing, a session of one process gets a temporary
    folder; every other master is an error, since its executors share none.
    """
    context = spark.sparkContext
    root = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="arenalake-llm-"))
        root = context.getCheckpointDir()
    return f"{root.rstrip('/')}/arenalake-llm/{uuid.uuid4().hex}"


_shipped: set[str] = set()
#: Rows go to Python workers in batches of this size (one row may be larger), so that their memory does not
#: follow the length of texts times the number of rows in a batch.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each application, and bound their batches."""
    spark.conf.set(BATCH_BYTES, "4m")
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parent.parent
        folder = tempfile.mkdtemp(prefix="arenalake-code-")
        code = shutil.copytree(package, f"{folder}/code/{package.name}", ignore=shutil.ignore_patterns("__pycache__"))
        context.addPyFile(shutil.make_archive(f"{folder}/{package.name}", "zip", Path(code).parent, package.name))
        _shipped.add(context.applicationId)


def write_table(rows: DataFrame, path: str, **options: str) -> DataFrame:
    """Write Parquet and read it back: later steps start from the files, whoever is lost."""
    rows.write.options(**({"compression": "zstd"} | options)).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def stored(rows: DataFrame) -> DataFrame:
    return write_table(rows, shared_folder(rows.sparkSession))


def texts(documents: DataFrame, *more: str) -> DataFrame:
    """``doc_id``, ``text`` (null: empty) and the named columns; all others are left out."""
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        *more,
    )


def part_starts(rows: DataFrame, part: str, amount: str) -> DataFrame:
    """``part``, ``part_start``: the sum of ``amount`` over all smaller parts.

    The second pass of a prefix sum. It handles one row for each part, and a part
    is what one task has written, so its size is the number of tasks.
    """
    totals = rows.groupBy(part).agg(F.sum(amount).alias("part_total"))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        part, F.coalesce(F.sum("part_total").over(before), F.lit(0)).cast("long").alias("part_start")
    )

"""Index text columns by descending frequency."""

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arenalake.operators.slices import HOT_GROUP_ROWS, SLICE_ROWS, positions
from arenalake.sinks.scratch import stored

def value_ranks(
    rows: DataFrame,
    columns: list[str],
    by: list[str],
    hot_rows: int = HOT_GROUP_ROWS,
    slice_rows: int = SLICE_ROWS,
    scratch: str | None = None,
) -> DataFrame:
    """(by..., field, value, rank) of every non-NULL value.

    Rank 0 is the most frequent value; ties go in alphabetical order. One scan
    counts the combinations of all columns, and their counts are added up per
    column. The counts are stored below ``scratch``, since their number decides
    how the values are ranked: calling this runs a job.
    """
    combinations = rows.groupBy(*by, *columns).agg(F.count("*").alias("n"))
    counts = stored(
        combinations.unpivot([*by, "n"], columns, "field", "value")
        .filter(F.col("value").isNotNull())
        .groupBy(*by, "field", "value")
        .agg(F.sum("n").alias("n")),
        scratch,
    )
    sizes = counts.groupBy(*by, "field").agg(F.count("*").alias("values"))
    largest, total = (v or 0 for v in sizes.agg(F.max("values"), F.sum("values")).first())
    order = [F.col("n").desc(), F.col("value")]
    group = [*by, "field"]
    ranked = positions(counts, group, order, largest, total, "rank", hot_rows, slice_rows, scratch)
    return ranked.drop("n")


def frequency_index(
    rows: DataFrame,
    outputs: dict[str, str],
    by: list[str] | None = None,
    handle_null: str = "error",
    hot_rows: int = HOT_GROUP_ROWS,
    slice_rows: int = SLICE_ROWS,
    scratch: str | None = None,
) -> DataFrame:
    """Add ``outputs[column]``, the frequency rank of the column's value, as double.

    ``by`` ranks within those columns. NULL values: ``error`` fails the job,
    ``skip`` drops the row, ``keep`` gives NULL. Runs a job when called, see
    ``value_ranks``. Spark broadcasts the ranks or shuffles by their measured size.
    """
    by = by or []
    ranks = value_ranks(rows, list(outputs), by, hot_rows, slice_rows, scratch)
    for column, output in outputs.items():
        side = ranks.filter(F.col("field") == column).select(
            *[F.col(c).alias(f"_{c}_of_rank") for c in by],
            F.col("value").alias("_value"),
            F.col("rank").cast("double").alias(output),
        )
        match = [F.col(column) == F.col("_value")]
        match += [F.col(c).eqNullSafe(F.col(f"_{c}_of_rank")) for c in by]
        rows = rows.join(side, reduce(and_, match), "inner" if handle_null == "skip" else "left")
        rows = rows.drop("_value", *[f"_{c}_of_rank" for c in by])
        if handle_null == "error":
            rows = rows.withColumn(
                output,
                F.when(F.col(column).isNotNull(), F.col(output)).otherwise(
                    F.raise_error(F.lit(f"NULL in column {column}")).cast("double")
                ),
            )
    return rows

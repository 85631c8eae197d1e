"""Ordered operators that stay balanced when one group holds most of the rows.

A window sorts a whole group in one task. The two operators here do that only
while every group is small. Rows of larger groups are range-partitioned on
(group, order), and every range is cut into *slices*: a slice holds a bounded run
of neighbouring rows, and a group may span many slices. Work inside a slice is an
ordinary window; what crosses a slice border is one small row per border.

A range is a task, and costs the driver a sample of keys and a task's result. So
small slices share a range: beyond ``RANGES`` there is none with fewer than
``SLICE_ROWS`` rows on average, and what reaches the driver does not follow the
number of slices.

The borders of ranges are chosen by sampling in the job that writes the shuffle.
The slice is therefore written with the rows, next to their position in the
order, before anything is derived from it, so a lost executor cannot give the
same row another one.
"""

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arenalake.sinks.scratch import stored

#: A group above this many rows is sliced: the largest sort one task is to do.
HOT_GROUP_ROWS = 2_000_000
SLICE_ROWS = 1_000_000
#: So many ranges may be smaller than SLICE_ROWS rows.
RANGES = 200
#: Bits of the row's number in its partition, in ``monotonically_increasing_id``.
ROW_BITS = 33
#: Parts rows that are equal in every column; which of them comes first does not matter.
TIE = "_tie"


def join_keys(rows: DataFrame, small: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Null-safe join on ``keys``. ``small`` comes from stored files, whose size Spark knows."""
    renamed = small.withColumnsRenamed({c: f"_{c}_of_small" for c in keys})
    match = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}_of_small")) for c in keys])
    joined = rows.join(renamed, match, how)
    return joined.drop(*[f"_{c}_of_small" for c in keys])


def previous_values(
    rows: DataFrame,
    group: list[str],
    order: list[str],
    values: dict[str, str],
    hot_rows: int = HOT_GROUP_ROWS,
    slice_rows: int = SLICE_ROWS,
    scratch: str | None = None,
) -> DataFrame:
    """Add ``new = lag(old)`` for every ``{new: old}``, per group in the given order.

    Every remaining column extends the order, so the result does not depend on
    how rows happen to be laid out. Groups above ``hot_rows`` rows go through
    slices. Runs a job when called: it counts the groups, and stores the slices
    below ``scratch``.
    """
    order = order + [c for c in rows.columns if c not in group and c not in order]
    sizes = rows.groupBy(*group).agg(F.count("*").alias("_rows"))
    hot_sizes = sizes.filter(F.col("_rows") > hot_rows)
    n_hot, hot_total = hot_sizes.agg(F.count("*"), F.sum("_rows")).first()
    if not n_hot:
        return _lag(rows, group, order, values)
    hot_keys = stored(hot_sizes, scratch)
    cold = join_keys(rows, hot_keys, group, "left_anti")
    hot = join_keys(rows, hot_keys, group, "left_semi")
    sliced = _lag_in_slices(hot, group, order, values, hot_total, slice_rows, scratch)
    return _lag(cold, group, order, values).unionByName(sliced)


def _lag(rows, group, order, values):
    window = Window.partitionBy(*group).orderBy(*order)
    return rows.withColumns({new: F.lag(old).over(window) for new, old in values.items()})


def _lag_in_slices(rows, group, order, values, total, slice_rows, scratch):
    tied = rows.withColumn(TIE, F.monotonically_increasing_id())
    sliced = _slices(tied, group, [*order, TIE], total, slice_rows, scratch)
    slices = [*group, "_slice"]
    lagged = _lag(sliced, slices, ["_position"], values | {"_before": "_position"})
    ends = sliced.groupBy(*slices).agg(F.max("_position").alias("_position"))
    tails = join_keys(
        sliced.select(*slices, "_position", F.struct(*values.values()).alias("_carry")),
        ends.select("_position"),
        ["_position"],
        "left_semi",
    )
    carry = _carried(tails.select(*slices, "_carry"), group)
    joined = join_keys(lagged, carry, slices, "left")
    return joined.select(
        *rows.columns,
        *[
            F.when(F.col("_before").isNull(), F.col("_carry")[name])
            .otherwise(F.col(new))
            .alias(new)
            for new, name in values.items()
        ],
    )


def _slices(rows, group, order, total, slice_rows, scratch):
    """Store the rows with ``_slice`` and ``_position``, which ascends in the order.

    ``_slice`` is the position of the slice's first row.
    """
    keys = [*group, *order]
    n_ranges = min(-(-total // slice_rows), max(RANGES, -(-total // SLICE_ROWS)))
    ranged = rows.repartitionByRange(int(n_ranges), *keys).sortWithinPartitions(*keys)
    placed = ranged.withColumn("_position", F.monotonically_increasing_id())
    row = F.col("_position").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return stored(placed.withColumn("_slice", F.col("_position") - row % slice_rows), scratch)


def _carried(per_slice, group):
    """For each slice, what the previous slice of the same group ends with.

    Only the first group of a slice can have started before it, so the result
    has at most one row per slice. The window runs over one row per (group,
    slice).
    """
    before = Window.partitionBy(*group).orderBy("_slice")
    return per_slice.withColumn("_carry", F.lag("_carry").over(before)).filter(
        F.col("_carry").isNotNull()
    )


def positions(
    rows: DataFrame,
    group: list[str],
    order: list,
    largest: int,
    total: int,
    alias: str,
    hot_rows: int = HOT_GROUP_ROWS,
    slice_rows: int = SLICE_ROWS,
    scratch: str | None = None,
) -> DataFrame:
    """Add the 0-based position of each row in its group.

    ``largest`` and ``total`` are the row counts of the largest group and of all
    groups. The order must tell the rows of a group apart.
    """
    if largest <= hot_rows:
        window = Window.partitionBy(*group).orderBy(*order)
        return rows.withColumn(alias, F.row_number().over(window) - 1)
    sliced = _slices(rows, group, order, total, slice_rows, scratch)
    sizes = sliced.groupBy(*group, "_slice").agg(F.count("*").alias("_size"))
    before = Window.partitionBy(*group).orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    carry = sizes.withColumn("_carry", F.sum("_size").over(before)).filter(
        F.col("_carry").isNotNull()
    )
    window = Window.partitionBy(*group, "_slice").orderBy("_position")
    local = sliced.withColumn(alias, F.row_number().over(window) - 1)
    joined = join_keys(local, carry.drop("_size"), group + ["_slice"], "left")
    return joined.select(
        *rows.columns,
        (F.col(alias) + F.coalesce("_carry", F.lit(0))).alias(alias),
    )

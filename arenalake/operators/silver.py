"""Bronze to the analysis table and the two training tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arenalake.functions.features import (
    buy_flag,
    champion_label,
    keep_all,
    keep_any,
    step_distance,
    x_plus_y,
)
from arenalake.operators.frequency import frequency_index
from arenalake.operators.slices import HOT_GROUP_ROWS, SLICE_ROWS, previous_values
from arenalake.schema import DAY, MODEL_COLUMNS, TRAIN_COLUMNS

# Total order of one account's events. Room ids are random, so it follows time
# only inside a room.
EVENT_ORDER = ["room_id", "current_time", "datetime", "x", "y"]


def present_rows(bronze: DataFrame, keep: str = "any") -> DataFrame:
    """Drop blank rows: those with no identity at all (``any``) or with any gap (``all``)."""
    return bronze.filter({"any": keep_any, "all": keep_all}[keep]())


def analysis_rows(bronze: DataFrame, keep: str = "any") -> DataFrame:
    """The analysis table, unsorted."""
    return present_rows(bronze, keep).withColumns({"x+y": x_plus_y(), "buy": buy_flag()})


ROOM_TIME = [DAY, "room_id", "current_time"]


def sort_room_time(rows: DataFrame) -> DataFrame:
    """Global order by day, room and time, for a reader of the result itself."""
    return rows.orderBy(*ROOM_TIME)


def files_by_room_time(rows: DataFrame) -> DataFrame:
    """The same order inside every written file.

    A global order would not outlast the write, and it costs a second pass over
    the input to choose its ranges. Rebalancing groups the rows by day, and
    adaptive execution splits a large day by size, not by key, so neither a room
    nor a run of equal rows can overload a task.
    """
    return rows.hint("rebalance", DAY).sortWithinPartitions(*ROOM_TIME)


def labelled_rows(
    bronze: DataFrame,
    by_day: bool = True,
    handle_null: str = "error",
    scratch: str | None = None,
) -> DataFrame:
    """Champion and key indexes and the label.

    ``by_day`` ranks within each day, which makes one run over many days equal
    to one run per day.
    """
    indexed = frequency_index(
        bronze,
        {"champion": "cahmpion_indexed", "inputkey": "inputkey_indexed"},
        by=[DAY] if by_day else [],
        handle_null=handle_null,
        scratch=scratch,
    )
    return indexed.withColumn("label", champion_label())


def train_indexed_rows(
    bronze: DataFrame,
    event_day: bool = True,
    by_day: bool = True,
    handle_null: str = "error",
    champion_alias: bool = False,
    scratch: str | None = None,
) -> DataFrame:
    """The indexed training table.

    ``event_day`` sets the day to that of the event, so a game over midnight
    puts rows into the next day. With ``event_day=False`` the day stays that of
    the room and the event's day is added as ``event_date``.
    ``champion_alias`` adds the index under its correctly spelled name.
    """
    rows = labelled_rows(bronze, by_day, handle_null, scratch)
    extra = []
    if event_day:
        rows = rows.withColumn(DAY, F.col("datetime").cast("date"))
    else:
        extra.append(F.col("datetime").cast("date").alias("event_date"))
    if champion_alias:
        extra.append(F.col("cahmpion_indexed").alias("champion_indexed"))
    return rows.select(*TRAIN_COLUMNS[:-1], *extra, DAY)


def with_previous_position(
    bronze: DataFrame,
    per_room: bool = False,
    hot_rows: int = HOT_GROUP_ROWS,
    slice_rows: int = SLICE_ROWS,
    scratch: str | None = None,
) -> DataFrame:
    """prev_x, prev_y: the account's position at its previous event of the day.

    ``per_room`` starts anew in each room.
    """
    group = ["encrypted_account", DAY] + (["room_id"] if per_room else [])
    order = [c for c in EVENT_ORDER if c not in group]
    previous = {"prev_x": "x", "prev_y": "y"}
    rows = bronze.drop(*MODEL_COLUMNS)
    return previous_values(rows, group, order, previous, hot_rows, slice_rows, scratch)


def fill_movement(rows: DataFrame) -> DataFrame:
    return rows.na.fill(0, ["prev_x", "prev_y", "distance"])


def movement_rows(
    bronze: DataFrame,
    per_room: bool = False,
    hot_rows: int = HOT_GROUP_ROWS,
    slice_rows: int = SLICE_ROWS,
    scratch: str | None = None,
) -> DataFrame:
    """The movement training table; model columns of a scored bronze table are left out."""
    rows = with_previous_position(bronze, per_room, hot_rows, slice_rows, scratch)
    return fill_movement(rows.withColumn("distance", step_distance()))

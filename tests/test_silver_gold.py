"""Silver features and gold aggregates."""

import datetime as dt

import pytest
from compare import bag
from pyspark.sql import functions as F

from arenalake.lake import GOLD_TABLES
from arenalake.operators.gold import gold_from_events, gold_tables
from arenalake.operators.silver import (
    analysis_rows,
    movement_rows,
    sort_room_time,
    train_indexed_rows,
    with_previous_position,
)
from arenalake.plans import jobs
from arenalake.registry.prepared import bronze, day_range, new_lake, silver_table
from arenalake.schema import BRONZE_SCHEMA, DAY, TRAIN_COLUMNS

SF = "/root/testdata/sf0.001"
D1, D2 = dt.date(2024, 1, 5), dt.date(2024, 1, 6)


def event(day=D1, at=None, time=1, room="r", x=0, y=0, champion="VEX", account="a", key="q"):
    at = at or dt.datetime(day.year, day.month, day.day, 12)
    return (day, "/move", time, 0, room, at, x, y, key, champion, 0, account)


def frame(spark, *events):
    return spark.createDataFrame(list(events), BRONZE_SCHEMA)


def test_ties_have_a_fixed_order(spark):
    tied = [event(x=3, y=4), event(x=0, y=0), event(x=6, y=8, time=2)]
    for order in (tied, tied[::-1]):
        got = movement_rows(frame(spark, *order)).orderBy("x").collect()
        assert [(r.prev_x, r.prev_y, r.distance) for r in got] == [(0, 0, 0), (0, 0, 5), (3, 4, 5)]


def test_lag_crosses_rooms_unless_asked_not_to(spark):
    rows = frame(spark, event(room="a", x=1), event(room="b", x=5))
    crossing = with_previous_position(rows).orderBy("room_id").collect()
    assert [r.prev_x for r in crossing] == [None, 1]
    assert [r.prev_x for r in with_previous_position(rows, per_room=True).collect()] == [None, None]


def test_lag_starts_anew_each_day(spark):
    rows = frame(spark, event(x=1), event(day=D2, x=2))
    assert [r.prev_x for r in with_previous_position(rows).collect()] == [None, None]


def test_movement_drops_model_columns(spark):
    scored = frame(spark, event()).withColumns(
        {"prediction": F.lit(1), "features_vector": F.lit("v")}
    )
    assert set(movement_rows(scored).columns) == set(BRONZE_SCHEMA.names) | {
        "prev_x", "prev_y", "distance",
    }


def test_event_over_midnight(spark):
    rows = frame(spark, event(at=dt.datetime(2024, 1, 6, 0, 10)))
    by_event = train_indexed_rows(rows)
    assert by_event.columns == list(TRAIN_COLUMNS)
    assert by_event.first()[DAY] == D2
    by_room = train_indexed_rows(rows, event_day=False, champion_alias=True).first()
    assert (by_room[DAY], by_room.event_date) == (D1, D2)
    assert by_room.champion_indexed == by_room.cahmpion_indexed


def test_label(spark):
    rows = frame(spark, event(champion="VIKTOR"), event(champion="VEX"))
    got = {(r.cahmpion_indexed, r.label) for r in train_indexed_rows(rows).collect()}
    assert got == {(0.0, 0), (1.0, 1)}


def test_sorted_by_room_and_time(spark):
    got = [
        (r[DAY], r.room_id or "", r.current_time)
        for r in sort_room_time(analysis_rows(bronze(spark, SF))).collect()
    ]
    assert got == sorted(got)


def test_gold_average_equals_avg(spark):
    silver = analysis_rows(bronze(spark, SF))
    want = silver.groupBy("encrypted_account", "champion", DAY).agg(
        F.avg("death_count").alias("average_deaths"),
        F.avg("current_time").alias("average_game_time"),
    )
    assert bag(gold_from_events(silver, "average_death_and_time")) == bag(want)


def test_champion_deaths_are_ordered_by_room_in_each_file(spark):
    lake = new_lake(spark, analysis_playerlogs=silver_table(spark, SF))
    jobs.gold_days(spark, lake, *day_range(spark, SF))
    rows = spark.table(lake.name("champion_death_count")).select(
        F.input_file_name().alias("file"), DAY, "room_id"
    )
    per_file = {}
    for r in rows.collect():
        per_file.setdefault((r.file, r[DAY]), []).append(r.room_id or "")
    assert per_file and all(rooms == sorted(rooms) for rooms in per_file.values())


def test_one_row_group_has_no_spread(spark):
    row = gold_from_events(analysis_rows(frame(spark, event())), "room_champion_xy").first()
    assert row.stddev_x is None and row.stddev_y is None


def test_every_gold_table_has_a_place(spark):
    assert list(gold_tables()) == GOLD_TABLES

"""Casts and row-level features on hand-written values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from arenalake.functions.casts import month_of, parse_day, to_day, to_instant, to_int
from arenalake.functions.features import (
    keep_all,
    keep_any,
    pseudonym,
    share,
    step_distance,
    x_plus_y,
)


def values(spark, texts, expression):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    return [r[0] for r in rows.orderBy("i").select(expression).collect()]


TEXTS = ["3", "3.7", " 5 ", "1e2", "", "99999999999", "+4", "-7", "abc", None, "3.", "1.2.3"]


def test_strict_int(spark):
    expected = [3, None, 5, None, None, None, 4, -7, None, None, None, None]
    assert values(spark, TEXTS, to_int("s")) == expected


def test_legacy_int_truncates(spark):
    expected = [3, 3, 5, None, None, None, 4, -7, None, None, 3, None]
    assert values(spark, TEXTS, to_int("s", legacy=True)) == expected


def test_instants(spark):
    texts = [
        "2024-01-05T12:34:56Z",
        "2024-01-05T12:34:56.123456Z",
        "2024-01-05T12:34:56.123456789Z",
        "2024-01-05T12:34Z",
        "2024-01-05",
        "garbage",
        None,
    ]
    got = values(spark, texts, to_instant("s").cast("timestamp_ntz"))
    second = dt.datetime(2024, 1, 5, 12, 34, 56)
    micro = second.replace(microsecond=123456)
    assert got[:3] == [second, micro, micro]
    assert got[4:] == [dt.datetime(2024, 1, 5), None, None]
    day = dt.date(2024, 1, 5)
    assert values(spark, texts, to_day("s")) == [day] * 5 + [None, None]


def test_instant_without_seconds_is_null_but_has_a_day(spark):
    assert values(spark, ["2024-01-05T12:34Z"], to_instant("s")) == [None]
    assert values(spark, ["2024-01-05T12:34Z"], to_day("s")) == [dt.date(2024, 1, 5)]


def test_parse_day_and_month(spark):
    assert values(spark, ["2024-02-03", "nope"], parse_day("s")) == [dt.date(2024, 2, 3), None]
    assert values(spark, ["2024-02-03"], month_of(to_day("s"))) == ["2024-02"]


def test_pseudonym(spark):
    import hashlib

    plain = hashlib.sha256(b"testAccount_1").hexdigest()
    salted = hashlib.sha256(b"pepper" + b"testAccount_1").hexdigest()
    assert values(spark, ["testAccount_1", None], pseudonym("s")) == [plain, None]
    assert values(spark, ["testAccount_1"], pseudonym("s", salt="pepper")) == [salted]


def test_sums_and_distances_survive_extreme_positions(spark):
    top = 2**31 - 1
    rows = spark.createDataFrame(
        [(top, 1, -top, 0), (3, 4, 0, 0), (1, 1, None, None)],
        "x int, y int, prev_x int, prev_y int",
    )
    got = rows.select(x_plus_y().alias("s"), step_distance().alias("d")).collect()
    assert [r.s for r in got] == [None, 7, 2]
    assert got[0].d == pytest.approx(2 * top)
    assert [r.d for r in got[1:]] == [5.0, None]


def test_share_rounds_half_up_and_survives_zero(spark):
    rows = spark.createDataFrame([(29, 200), (1, 3), (0, 0)], "used bigint, total bigint")
    assert [r[0] for r in rows.select(share("used", "total")).collect()] == [0.15, 0.33, None]


def test_keep_rules(spark):
    rows = [
        ("", "", "", 1),
        (None, None, None, 1),
        ("", None, "", None),
        ("VEX", None, "", 1),
        (None, "abc", None, None),
        (None, None, "r", 1),
        ("VEX", "abc", "r", 1),
        ("VEX", "abc", "r", None),
    ]
    frame = spark.createDataFrame(
        rows, "champion string, encrypted_account string, room_id string, current_time int"
    ).withColumn("datetime", F.lit(dt.datetime(2024, 1, 1)))
    got = frame.select(keep_any().alias("any"), keep_all().alias("all")).collect()
    assert [r.any for r in got] == [False, False, False, True, True, True, True, True]
    assert [r.all is True for r in got] == [False] * 6 + [True, False]

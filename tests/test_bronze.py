"""Parsing, splitting, typing and masking."""

import json

from compare import bag
from pyspark.sql import functions as F

from arenalake.operators.bronze import (
    bronze_rows,
    invalid_rows,
    is_valid,
    parse_messages,
    quarantine_rows,
    valid_rows,
)
from arenalake.schema import BRONZE_SCHEMA, RAW_FIELDS
from arenalake.sources.playerlogs import raw_playerlogs, to_messages

SF = "/root/testdata/sf0.001"

GOOD = {
    "createRoomDate": "2024-01-05T10:00:00Z",
    "method": "/move",
    "ingametime": "12",
    "ip": "192.168.0.1",
    "deathCount": "0",
    "roomID": "r1",
    "datetime": "2024-01-05T10:00:12Z",
    "x": "-3",
    "y": "4",
    "inputkey": "q",
    "account": "testAccount_1",
    "champion": "VEX",
    "status": "0",
}


def messages(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_parse_good_broken_missing_number_null(spark):
    without_x = {k: v for k, v in GOOD.items() if k != "x"}
    number_x = {**GOOD, "x": -3}
    texts = [json.dumps(GOOD), "{broken", json.dumps(without_x), json.dumps(number_x), None]
    got = parse_messages(messages(spark, texts)).collect()
    assert got[0].asDict() == GOOD
    assert all(v is None for v in got[1].asDict().values())
    assert got[2].x is None and got[2].y == "4"
    assert got[3].x == "-3"
    assert len(got) == 5 and all(v is None for v in got[4].asDict().values())


def test_binary_value(spark):
    binary = messages(spark, [json.dumps(GOOD)]).select(F.col("value").cast("binary"))
    assert parse_messages(binary).first().asDict() == GOOD


def test_text_of_broken_message_stays_only_in_clear_quarantine(spark):
    raw = parse_messages(messages(spark, ["{broken"]), keep_text=True)
    assert quarantine_rows(raw, clear=True).first()["_raw"] == "{broken"
    assert "_raw" not in quarantine_rows(raw).columns


def test_message_is_parsed_once(spark):
    parsed = parse_messages(messages(spark, ["{}"]))
    plan = bronze_rows(parsed)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_validity_is_total_and_splits(spark):
    raw = raw_playerlogs(spark, SF)
    assert raw.filter(is_valid().isNull()).count() == 0
    both = valid_rows(raw).unionAll(invalid_rows(raw))
    assert bag(both) == bag(raw)


def test_each_rule_refuses(spark):
    bad = [
        {"createRoomDate": None},
        {"ingametime": "1.5"},
        {"deathCount": "-1"},
        {"deathCount": None},
        {"x": "abc"},
        {"y": ""},
        {"status": "-1"},
        {"status": "x"},
    ]
    texts = [json.dumps({**GOOD, **change}) for change in bad]
    raw = parse_messages(messages(spark, texts))
    assert valid_rows(raw).count() == 0
    assert invalid_rows(raw).count() == len(bad)
    assert valid_rows(raw, legacy_int=True).count() == 1


def test_bronze_schema_and_masking(spark):
    rows = bronze_rows(raw_playerlogs(spark, SF))
    assert [(f.name, f.dataType) for f in rows.schema] == [
        (f.name, f.dataType) for f in BRONZE_SCHEMA
    ]
    assert rows.filter("encrypted_account like 'testAccount%'").count() == 0


def test_quarantine_masks_by_default(spark):
    raw = raw_playerlogs(spark, SF)
    masked, clear = quarantine_rows(raw), quarantine_rows(raw, clear=True)
    assert "ip" not in masked.columns and "account" not in masked.columns
    assert bag(clear.select(*RAW_FIELDS)) == bag(invalid_rows(raw))
    assert masked.count() == clear.count()


def test_messages_round_trip(spark):
    raw = raw_playerlogs(spark, SF)
    assert bag(parse_messages(to_messages(raw))) == bag(raw)

"""Every registered query against its SQL."""

import pytest
from compare import connect, spark_bag, sql_bag

from __spark_entry__ import entry, oracle_sql, queries
from arenalake.registry.oracles import ORACLES
from arenalake.registry.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF)


def test_which_queries_have_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, connection, name):
    columns, got = spark_bag(queries()[name](spark, SF))
    want_columns, want = sql_bag(connection, oracle_sql()[name])
    assert columns == want_columns
    assert got == want


def test_entry(spark):
    assert entry(spark).count() == 402


EXPECTED_ROWS = {
    "invalid_rows": 38,
    "valid_rows": 962,
    "silver_keep_any": 954,
    "silver_keep_all": 930,
    "gold_average_death_and_time": 402,
    "gold_champion_death_count": 757,
    "gold_room_end_time": 420,
    "gold_room_champion_xy": 757,
}


@pytest.mark.parametrize("name", EXPECTED_ROWS)
def test_known_row_counts(spark, name):
    assert queries()[name](spark, SF).count() == EXPECTED_ROWS[name]

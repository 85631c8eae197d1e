"""Sliced operators give exactly what one window gives."""

import pytest
from compare import bag
from pyspark.sql import Window
from pyspark.sql import functions as F

from arenalake.operators.frequency import frequency_index
from arenalake.operators.slices import RANGES, positions, previous_values
from arenalake.sinks.files import folder_names
from arenalake.sinks.scratch import scratch_path


def skewed(spark, n=3000):
    """A third of the rows NULL account, a third one account, many equal rows."""
    return spark.range(n).select(
        F.expr(
            "case when id % 3 = 0 then null when id % 3 = 1 then 'hot' "
            "else 'a' || (id % 50) end"
        ).alias("account"),
        F.expr("case when id % 7 = 0 then null else 'r' || (id % 5) end").alias("room"),
        F.expr("cast((id * 37) % 100 as int)").alias("t"),
        F.expr("cast((id * 7919) % 11 as int)").alias("x"),
        F.expr("'k' || (id % 2)").alias("key"),
    )


def one_window(rows):
    window = Window.partitionBy("account").orderBy("room", "t", "x", "key")
    return rows.withColumn("prev_x", F.lag("x").over(window))


@pytest.mark.parametrize("hot_rows, slice_rows", [(10, 7), (100, 50), (900, 400), (1, 1000)])
def test_sliced_lag(spark, hot_rows, slice_rows):
    rows = skewed(spark)
    order = ["room", "t", "x"]
    got = previous_values(rows, ["account"], order, {"prev_x": "x"}, hot_rows, slice_rows)
    assert bag(got) == bag(one_window(rows))


def test_copies_are_kept(spark):
    rows = spark.range(1000).select(
        F.lit("hot").alias("account"), F.lit("r").alias("room"), F.lit(1).alias("t"),
        F.when(F.col("id") < 990, 5).otherwise(9).alias("x"), F.lit("k0").alias("key"),
    )
    got = previous_values(rows, ["account"], ["room", "t", "x"], {"prev_x": "x"}, 10, 100)
    assert bag(got) == bag(one_window(rows))


def test_no_slices_without_hot_groups(spark):
    rows = skewed(spark, 100)
    plan = previous_values(rows, ["account"], ["room"], {"p": "x"})
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "rangepartitioning" not in text


def test_sliced_positions(spark):
    rows = skewed(spark).groupBy("account", "room", "t").agg(F.count("*").alias("n"))
    order = [F.col("n").desc(), F.col("room"), F.col("t")]
    total = rows.count()
    want = positions(rows, ["account"], order, 0, total, "p")
    got = positions(rows, ["account"], order, total, total, "p", hot_rows=5, slice_rows=40)
    assert bag(got) == bag(want)


def test_small_slices_share_a_range(spark):
    """Tasks, and what they send to the driver, do not follow the number of slices."""
    rows, folder = skewed(spark), scratch_path(spark, "slices")
    got = previous_values(rows, ["account"], ["room", "t", "x"], {"prev_x": "x"}, 10, 2, folder)
    assert bag(got) == bag(one_window(rows))
    stored = [spark.read.parquet(path) for path in (f"{folder}/{x}" for x in folder_names(spark, folder))]
    sliced = next(x for x in stored if "_slice" in x.columns)
    ranges, largest = sliced.groupBy("_slice", F.input_file_name().alias("file")).count().agg(
        F.count_distinct("file"), F.max("count")
    ).first()
    assert 1 < ranges <= RANGES and largest <= 2


def names(spark):
    rows = [("b", 1), ("b", 1), ("a", 1), ("c", 1), ("c", 2), ("c", 2), ("a", 2)]
    return spark.createDataFrame(rows, "name string, day int")


def test_index_order_and_ties(spark):
    got = {(r.name, r.i) for r in frequency_index(names(spark), {"name": "i"}).collect()}
    assert got == {("c", 0.0), ("a", 1.0), ("b", 2.0)}
    by_day = frequency_index(names(spark), {"name": "i"}, by=["day"])
    assert {(r.day, r.name, r.i) for r in by_day.collect()} == {
        (1, "b", 0.0), (1, "a", 1.0), (1, "c", 2.0), (2, "c", 0.0), (2, "a", 1.0),
    }


def test_index_matches_string_indexer(spark):
    from pyspark.ml.feature import StringIndexer

    from arenalake.registry.prepared import bronze

    rows = bronze(spark, "/root/testdata/sf0.001").select("champion", "inputkey")
    indexer = StringIndexer(inputCols=["champion", "inputkey"], outputCols=["c", "k"])
    want = indexer.fit(rows).transform(rows)
    assert bag(frequency_index(rows, {"champion": "c", "inputkey": "k"})) == bag(want)


def test_index_in_slices(spark):
    rows = skewed(spark).select(F.coalesce("account", F.lit("none")).alias("name"), "room")
    want = frequency_index(rows, {"name": "i"}, by=["room"])
    got = frequency_index(
        rows, {"name": "i"}, by=["room"], hot_rows=2, slice_rows=3
    )
    assert bag(got) == bag(want)


def test_index_of_null(spark):
    rows = spark.createDataFrame([("a",), (None,)], "name string")
    with pytest.raises(Exception, match="NULL in column name"):
        frequency_index(rows, {"name": "i"}).collect()
    assert frequency_index(rows, {"name": "i"}, handle_null="skip").count() == 1
    kept = frequency_index(rows, {"name": "i"}, handle_null="keep")
    assert bag(kept) == {(0.0, "a"): 1, (None, None): 1}

"""Writers, jobs, plans and the command line."""

from concurrent.futures import ThreadPoolExecutor
from datetime import date

import pytest
from compare import bag
from pyspark.sql import functions as F

from arenalake.__main__ import parser, run
from arenalake.lake import GOLD_TABLES, TABLES, Lake
from arenalake.operators.gold import gold_tables
from arenalake.operators.silver import analysis_rows, files_by_room_time, movement_rows
from arenalake.plans import jobs
from arenalake.registry.prepared import bronze, bronze_table, new_lake, silver_table
from arenalake.schema import BRONZE_SCHEMA, DAY
from arenalake.sinks.scratch import scratch_path
from arenalake.sinks.tables import append_days, replace_days, replace_table
from arenalake.sources.archive import json_month
from arenalake.sources.tables import table_day_where, table_days

SF = "/root/testdata/sf0.001"
DERIVED = ["analysis_playerlogs", "train_playerlogs", "delta_playerlogs", *GOLD_TABLES]
MODE = "spark.sql.sources.partitionOverwriteMode"


def days(spark, *rows):
    return spark.createDataFrame(
        [(v, date.fromisoformat(d)) for v, d in rows], f"v int, {DAY} date"
    )


def content(spark, table):
    return sorted((r.v, r[DAY].isoformat()) for r in spark.table(table).collect())


def plan_of(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def test_replace_days_touches_only_the_days_given(spark, lake):
    name, path = lake.name("playerlogs"), lake.path("playerlogs")
    before = spark.conf.get(MODE)
    replace_days(days(spark, (1, "2024-01-01"), (2, "2024-01-02")), name, path)
    for _ in range(2):
        replace_days(days(spark, (9, "2024-01-02")), name, path, rebalance=True)
        assert content(spark, name) == [(1, "2024-01-01"), (9, "2024-01-02")]
    assert spark.conf.get(MODE) == before
    append_days(days(spark, (3, "2024-01-01")), name, path)
    assert (3, "2024-01-01") in content(spark, name)
    assert spark.sql(f"show partitions {name}").count() == 2


def test_replace_days_matches_columns_by_name(spark, lake):
    name, path = lake.name("playerlogs"), lake.path("playerlogs")
    rows = days(spark, (1, "2024-01-01"))
    replace_days(rows, name, path)
    replace_days(rows.select(DAY, "v"), name, path)
    assert content(spark, name) == [(1, "2024-01-01")]


@pytest.mark.parametrize("fmt", ["json", "orc"])
def test_other_formats(spark, lake, fmt):
    rows = bronze(spark, SF)
    name, path = lake.name("playerlogs"), lake.path("playerlogs")
    for _ in range(2):
        replace_days(rows, name, path, fmt, rebalance=True)
        assert bag(spark.table(name)) == bag(rows)


def test_concurrent_writers_stay_dynamic(spark):
    lakes = [new_lake(spark) for _ in range(4)]

    def write(lake):
        name, path = lake.name("playerlogs"), lake.path("playerlogs")
        for day in ("2024-01-01", "2024-01-02", "2024-01-03"):
            replace_days(days(spark, (1, day)), name, path)
        return content(spark, name)

    before = spark.conf.get(MODE)
    with ThreadPoolExecutor(4) as pool:
        results = list(pool.map(write, lakes))
    assert results == [[(1, f"2024-01-0{d}") for d in (1, 2, 3)]] * 4
    assert spark.conf.get(MODE) == before


def test_files_are_sorted_by_room_and_time(spark):
    silver = spark.table(silver_table(spark, SF))
    rows = (
        silver.select(
            F.input_file_name().alias("file"), DAY, "room_id", "current_time",
            F.monotonically_increasing_id().alias("position"),
        )
        .orderBy("file", "position")
        .collect()
    )
    per_file = {}
    for r in rows:
        per_file.setdefault((r.file, r[DAY]), []).append((r.room_id or "", r.current_time))
    assert per_file and all(order == sorted(order) for order in per_file.values())


def test_a_large_day_of_one_room_is_split(spark, lake):
    rows = spark.table(bronze_table(spark, SF)).withColumns(
        {DAY: F.lit("2024-01-05").cast("date"), "room_id": F.lit("r")}
    )
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "16KB")
    try:
        silver = files_by_room_time(analysis_rows(rows.repartition(8)))
        name = lake.name("analysis_playerlogs")
        replace_days(silver, name, lake.path("analysis_playerlogs"))
    finally:
        spark.conf.unset(size)
    written = spark.table(name)
    assert written.select(F.input_file_name()).distinct().count() > 1
    assert bag(written) == bag(analysis_rows(rows))


def test_replace_table_replaces_all(spark, lake):
    name, path = lake.name("playerlogs"), lake.path("playerlogs")
    replace_table(days(spark, (1, "2024-01-01"), (2, "2024-01-02")), name, path)
    replace_table(days(spark, (9, "2024-01-02")), name, path)
    assert content(spark, name) == [(9, "2024-01-02")]


def test_day_scans_are_pruned(spark):
    name = bronze_table(spark, SF)
    for rows in (
        table_days(spark, name, "2024-01-05"),
        table_day_where(spark, name, "2024-01-05"),
        table_days(spark, name, "2024-01-05", "2024-01-07"),
    ):
        text = plan_of(rows.select("x"))
        assert f"PartitionFilters: [isnotnull({DAY}" in text
        assert "ReadSchema: struct<x:int>" in text
    assert bag(table_days(spark, name, "2024-01-05")) == bag(
        table_day_where(spark, name, date(2024, 1, 5))
    )


def test_movement_shuffles_once(spark):
    text = plan_of(movement_rows(spark.table(bronze_table(spark, SF))))
    assert text.count("Exchange") == 1 and "rangepartitioning" not in text


def test_gold_reads_only_its_columns(spark):
    silver = spark.table(silver_table(spark, SF))
    text = plan_of(gold_tables()["key_used_per"].from_events(silver))
    assert "ReadSchema: struct<inputkey:string,champion:string>" in text
    assert "partial_count" in text and text.count("Exchange") == 1


def test_range_equals_day_by_day_and_reruns_change_nothing(spark):
    one, many = (new_lake(spark, playerlogs=bronze_table(spark, SF)) for _ in range(2))
    jobs.run_days(spark, one, "2024-01-02", "2024-01-04")
    for day in ("2024-01-02", "2024-01-03", "2024-01-04", "2024-01-03"):
        jobs.run_days(spark, many, day)
    for table in DERIVED:
        assert bag(spark.table(one.name(table))) == bag(spark.table(many.name(table))), table


def test_first_of_month_refits(spark):
    lake = new_lake(spark, playerlogs=bronze_table(spark, SF))
    assert jobs.run_days(spark, lake, "2024-01-02").model is None
    report = jobs.run_days(spark, lake, "2024-01-01")
    assert report.model is not None and -1 <= report.silhouette <= 1


def test_archive_takes_its_month_and_keeps_the_day(spark, lake):
    rows = bronze(spark, SF)
    later = rows.withColumn(DAY, F.add_months(DAY, 1))
    base = scratch_path(spark, "json")
    rows.unionByName(later).write.partitionBy(DAY).json(base)
    path = jobs.archive_month(spark, lake, "2024-02-17", base, BRONZE_SCHEMA)
    assert path.endswith("/2024-02")
    assert bag(spark.read.parquet(path).select(*later.columns)) == bag(later)
    january = json_month(spark, base, "2024-01-31", BRONZE_SCHEMA)
    assert bag(january.select(*rows.columns)) == bag(rows)
    files = spark.read.format("binaryFile").load(path).select("path").collect()
    assert all(".zstd.parquet" in f.path for f in files)


def test_names_of_tables():
    lake = Lake("s3a://lake", suffix="_game", names={"playerlogs": "old.logs"})
    assert lake.name("room_end_time") == "gold_game.room_end_time"
    assert lake.name("playerlogs") == "old.logs"
    assert lake.path("delta_playerlogs") == "s3a://lake/silver_train/delta_playerlogs"
    assert len({lake.path(t) for t in TABLES}) == len(TABLES)


def test_command_line(spark, capsys):
    lake = new_lake(spark)
    jobs.append_days(
        spark.table(bronze_table(spark, SF)), lake.name("playerlogs"), lake.path("playerlogs")
    )
    common = ["--root", lake.root, "--suffix", lake.suffix]
    for job in ("silver-analysis", "gold", "silver-train", "silver-movement"):
        run(spark, [*common, job, "2024-01-05"])
    run(spark, [*common, "refit"])
    assert "silhouette" in capsys.readouterr().out
    for table in DERIVED:
        assert spark.table(lake.name(table)).count() > 0
    args = parser().parse_args([*common, "ingest", "host:1", "topic", "--json"])
    assert (args.servers, args.topic, args.json) == ("host:1", "topic", True)


def test_missing_kafka_connector_is_reported(spark):
    from arenalake.sources.messages import kafka_messages

    with pytest.raises(Exception, match="(?i)kafka"):
        kafka_messages(spark, "host:1", "topic", startingOffsets="earliest")

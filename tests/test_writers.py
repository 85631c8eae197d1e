"""Faults of the day writer, the archive and the daily run that lost rows without an error."""

import threading
from datetime import date, timedelta

import pytest
from compare import bag
from pyspark.sql import functions as F

from arenalake.__main__ import parser, run
from arenalake.operators.bronze import invalid_rows, split_rows, valid_rows
from arenalake.operators.cluster import predict
from arenalake.operators.gold import gold_tables
from arenalake.operators.slices import previous_values
from arenalake.plans import jobs
from arenalake.registry.prepared import bronze, bronze_table, fitted_model, landed_messages, new_lake, raw
from arenalake.schema import BRONZE_SCHEMA, DAY
from arenalake.sinks import tables
from arenalake.sinks.files import exists, file_names, folder_names, move
from arenalake.sinks.models import current_model
from arenalake.sinks.scratch import scratch_path, scratch_root
from arenalake.sinks.tables import append_days, drop_superseded, finish_archive, month_to_parquet, replace_days
from arenalake.sources.messages import text_messages
from arenalake.streaming import ingest

SF = "/root/testdata/sf0.001"


def days(spark, *rows):
    return spark.createDataFrame([(v, date.fromisoformat(d)) for v, d in rows], f"v int, {DAY} date")


def content(spark, table):
    return sorted((r.v, r[DAY].isoformat()) for r in spark.table(table).collect())


def test_a_static_session_replaces_only_its_days(spark, lake):
    name, path = lake.name("playerlogs"), lake.path("playerlogs")
    replace_days(days(spark, (1, "2024-01-01"), (2, "2024-01-02")), name, path)
    other = spark.newSession()
    other.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    replace_days(days(other, (9, "2024-01-02")), name, path)
    assert content(spark, name) == [(1, "2024-01-01"), (9, "2024-01-02")]


def test_a_table_of_before_gets_the_dynamic_mode(spark, lake):
    name, path = lake.name("playerlogs"), lake.path("playerlogs")
    spark.sql(f"create table {name} (v int, {DAY} date) using parquet partitioned by ({DAY}) location '{path}'")
    for rows in ([(1, "2024-01-01")], [(2, "2024-01-02")]):
        replace_days(days(spark, *rows), name, path)
    assert content(spark, name) == [(1, "2024-01-01"), (2, "2024-01-02")]


@pytest.mark.parametrize("write", [replace_days, append_days])
def test_differing_columns_are_an_error(spark, lake, write):
    name, path = lake.name("playerlogs"), lake.path("playerlogs")
    write(days(spark, (1, "2024-01-01")), name, path)
    with pytest.raises(ValueError, match="prediction"):
        write(days(spark, (1, "2024-01-01")).withColumn("prediction", F.lit(1)), name, path)
    with pytest.raises(ValueError, match="'v'"):
        write(days(spark, (1, "2024-01-01")).drop("v"), name, path)


def test_a_table_over_a_folder_sees_its_days(spark, lake):
    name, path = lake.name("playerlogs"), lake.path("playerlogs")
    days(spark, (1, "2024-01-01")).write.partitionBy(DAY).parquet(path)
    replace_days(days(spark, (2, "2024-01-02")), name, path)
    assert content(spark, name) == [(1, "2024-01-01"), (2, "2024-01-02")]


def test_days_of_a_run_without_rows_are_emptied(spark, lake):
    name, path = lake.name("playerlogs"), lake.path("playerlogs")
    replace_days(days(spark, (1, "2024-01-01"), (2, "2024-01-02"), (3, "2024-01-03")), name, path)
    replace_days(days(spark, (9, "2024-01-01")), name, path, days=("2024-01-01", "2024-01-02"))
    assert content(spark, name) == [(3, "2024-01-03"), (9, "2024-01-01")]
    assert not exists(spark, f"{path}/{DAY}=2024-01-02")
    assert spark.sql(f"show partitions {name}").count() == 2


def start(spark, lake, **options):
    messages = text_messages(spark, landed_messages(spark, SF))
    ingest.run_all(ingest.start_table_ingest(messages, lake, trigger={"availableNow": True}, **options), 1)


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_archive_of_a_batch_table(spark, fmt):
    lake = new_lake(spark)
    append_days(bronze(spark, SF), lake.name("playerlogs"), lake.path("playerlogs"), fmt)
    for _ in range(2):
        path = jobs.archive_month(spark, lake, "2024-01-17")
        assert bag(spark.read.parquet(path).select(*BRONZE_SCHEMA.names)) == bag(bronze(spark, SF))
    assert {p.rsplit(".", 2)[-2] for p in file_names(spark, path) if p.startswith("part-")} == {"zstd"}


def test_archive_of_a_scored_stream_table(spark, lake):
    model = fitted_model(spark, SF)
    start(spark, lake, model=model)
    path = jobs.archive_month(spark, lake, "2024-01-17")
    scored = predict(model, bronze(spark, SF))
    assert bag(spark.read.parquet(path).select(*scored.columns)) == bag(scored)


def test_a_base_of_another_format_is_an_error_and_keeps_the_archive(spark, lake):
    append_days(bronze(spark, SF), lake.name("playerlogs"), lake.path("playerlogs"))
    path = jobs.archive_month(spark, lake, "2024-01-17")
    with pytest.raises(Exception, match="(?i)malformed|json"):
        jobs.archive_month(spark, lake, "2024-01-17", lake.path("playerlogs"))
    assert bag(spark.read.parquet(path).select(*BRONZE_SCHEMA.names)) == bag(bronze(spark, SF))


def test_an_archive_with_fewer_rows_is_not_put_in_place(spark, monkeypatch):
    path = scratch_path(spark, "archive")
    month_to_parquet(days(spark, (1, "2024-01-01")), path)
    rows = days(spark, (1, "2024-01-01"), (2, "2024-01-02"))
    counts = iter([2, 1])  # of the source, then of what was written
    monkeypatch.setattr(type(rows), "count", lambda self: next(counts))
    with pytest.raises(ValueError, match="nothing is replaced"):
        month_to_parquet(rows, path)
    monkeypatch.undo()
    assert spark.read.parquet(path).count() == 1


def planted(spark):
    """Bronze rows, some of them without champion or key."""
    rows = bronze(spark, SF)
    return rows.withColumns({
        "champion": F.when(F.col("x") % 10 == 3, None).otherwise(F.col("champion")),
        "inputkey": F.when(F.col("y") % 10 == 4, None).otherwise(F.col("inputkey")),
    })


def test_a_day_with_blank_fields_is_run_and_counted(spark, lake):
    append_days(planted(spark), lake.name("playerlogs"), lake.path("playerlogs"))
    report = jobs.run_days(spark, lake, "2024-01-05", "2024-01-06")
    inside = planted(spark).where(F.col(DAY).between("2024-01-05", "2024-01-06"))
    full = inside.where("champion is not null and inputkey is not null").count()
    assert spark.table(lake.name("train_playerlogs")).count() == full > 0
    assert report.skipped == inside.count() - full > 0 and report.model is None
    with pytest.raises(Exception, match="NULL in column"):
        jobs.run_days(spark, lake, "2024-01-05", handle_null="error")


def test_options_reach_the_tables(spark, lake):
    append_days(planted(spark), lake.name("playerlogs"), lake.path("playerlogs"))
    common = ["--root", lake.root, "--suffix", lake.suffix, "run-day", "2024-01-05"]
    run(spark, [*common, "--keep", "all", "--null", "keep", "--per-room"])
    inside = planted(spark).where(F.col(DAY) == "2024-01-05")
    assert spark.table(lake.name("train_playerlogs")).count() == inside.count()
    kept = spark.table(lake.name("analysis_playerlogs"))
    assert kept.count() < inside.count() and kept.where("champion is null").count() == 0
    args = parser().parse_args(["--root", "r", "ingest", "h", "t", "--salt", "s", "--clear", "--strict-day"])
    assert (args.salt, args.clear, args.strict_day, args.legacy_int) == ("s", True, True, False)
    args = parser().parse_args(["--root", "r", "run-day", "2024-01-05", "--refit-from", "2023-12-01"])
    assert (args.handle_null, args.refit_from) == ("skip", "2023-12-01")


def test_a_refit_reads_the_days_it_is_told(spark, monkeypatch):
    lake = new_lake(spark, playerlogs=bronze_table(spark, SF))
    jobs.run_days(spark, lake, "2024-01-02", "2024-01-03")
    seen = []
    monkeypatch.setattr(jobs, "fit_clusters", lambda rows, fit=jobs.fit_clusters: seen.append(rows) or fit(rows))
    report = jobs.run_days(spark, lake, "2024-01-01", refit_from="2024-01-01")
    assert -1 <= report.silhouette <= 1
    assert {r[DAY].isoformat() for r in seen[0].select(DAY).distinct().collect()} == {"2024-01-01"}


def test_scratch_is_empty_after_a_run(spark, monkeypatch):
    monkeypatch.setattr("arenalake.operators.silver.HOT_GROUP_ROWS", 3)
    lake = new_lake(spark)
    hot = bronze(spark, SF).withColumn("encrypted_account", F.lit("hot"))
    append_days(hot, lake.name("playerlogs"), lake.path("playerlogs"))
    jobs.silver_train_movement(spark, lake, "2024-01-05", hot_rows=3, slice_rows=10)
    jobs.run_days(spark, lake, "2024-01-05")
    assert spark.table(lake.name("delta_playerlogs")).count() > 0
    status = spark._jvm.org.apache.hadoop.fs.Path(f"{lake.root}/scratch")
    files = status.getFileSystem(spark._jsc.hadoopConfiguration())
    assert not files.exists(status) or not len(files.listStatus(status))


@pytest.mark.parametrize("hot_rows", [99, 100, 101])
def test_groups_around_the_hot_bound(spark, hot_rows):
    rows = spark.range(300).select(
        F.when(F.col("id") < 100, "a").when(F.col("id") < 101, "b").otherwise("c").alias("account"),
        (F.col("id") % 50).cast("int").alias("t"), F.lit(1).alias("x"),
    )
    got = previous_values(rows, ["account"], ["t"], {"p": "x"}, hot_rows, 40)
    want = previous_values(rows, ["account"], ["t"], {"p": "x"}, 1000, 1000)
    assert bag(got) == bag(want)


def test_equal_rows_of_a_hot_group_are_parted(spark, monkeypatch):
    rows = spark.range(1000).select(F.lit("hot").alias("account"), F.lit(1).alias("t"), F.lit(5).alias("x"))
    from arenalake.operators import slices

    sizes = []
    keep = slices.stored

    def stored(rows, folder=None):
        out = keep(rows, folder)
        if "_slice" in out.columns:
            sizes.extend(r["count"] for r in out.groupBy("_slice").count().collect())
        return out

    monkeypatch.setattr(slices, "stored", stored)
    got = previous_values(rows, ["account"], ["t"], {"p": "x"}, 10, 100)
    assert bag(got) == {("hot", None, 1, 5): 1, ("hot", 5, 1, 5): 999}
    assert max(sizes) <= 400


def test_no_global_order_in_the_gold_job(spark):
    for table in gold_tables().values():
        rows = table.from_events(spark.table(bronze_table(spark, SF)))
        assert "rangepartitioning" not in rows._jdf.queryExecution().executedPlan().toString()


def test_a_malformed_room_date_can_be_refused(spark):
    rows = raw(spark, SF).limit(1).withColumn("createRoomDate", F.lit("31st of May"))
    good = rows.withColumns({c: F.lit("1") for c in ("ingametime", "x", "y", "deathCount", "status")})
    assert (valid_rows(good).count(), invalid_rows(good).count()) == (1, 0)
    assert [b.count() for b in split_rows(good, strict_day=True)] == [0, 1]


def test_scratch_needs_a_shared_folder_under_any_master():
    from types import SimpleNamespace

    for master in ("yarn", "local[4]", "local-cluster[2,1,1024]"):
        context = SimpleNamespace(getCheckpointDir=lambda: None, master=master)
        session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: default))
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch_root(session)


def test_a_reader_beside_the_writer_sees_whole_days(spark, lake):
    """Every day is all old or all new in every read, and no read fails."""
    name, path = lake.name("playerlogs"), lake.path("playerlogs")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 4).cast("int"))

    def version(k):
        return spark.range(4000).select(F.lit(k).alias("v"), day.alias(DAY)).repartition(6)

    replace_days(version(0), name, path)
    done, seen, faults = threading.Event(), [], []
    reader = spark.newSession()

    def read():
        while not done.is_set():
            try:
                rows = reader.table(name).groupBy(DAY).agg(F.min("v").alias("a"), F.max("v").alias("b"), F.count("*").alias("n"))
                seen.append([(r.a, r.b, r.n) for r in rows.collect()])
            except Exception as error:  # a read must not fail
                faults.append(error)

    thread = threading.Thread(target=read)
    thread.start()
    for k in range(1, 5):
        replace_days(version(k), name, path)
    done.set()
    thread.join()
    assert not faults and len(seen) > 3
    assert all(len(x) == 4 and all(a == b and n == 1000 for a, b, n in x) for x in seen)
    assert {r.v for r in spark.table(name).select("v").distinct().collect()} == {4}


def test_a_write_that_ends_before_the_swap_changes_nothing(spark, lake, monkeypatch):
    name, path = lake.name("playerlogs"), lake.path("playerlogs")
    replace_days(days(spark, (1, "2024-01-01")), name, path)
    monkeypatch.setattr(tables, "_set_places", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        replace_days(days(spark, (2, "2024-01-01")), name, path)
    monkeypatch.undo()
    assert content(spark, name) == [(1, "2024-01-01")]
    # Nor is what it left taken for the last version when the table is made anew.
    spark.sql(f"drop table {name}")
    replace_days(days(spark, (3, "2024-01-03")), name, path)
    assert content(spark, name) == [(1, "2024-01-01"), (3, "2024-01-03")]


def test_a_table_made_anew_finds_the_last_versions(spark, lake):
    name, path = lake.name("playerlogs"), lake.path("playerlogs")
    rows = days(spark, (1, "2024-01-01"), (2, "2024-01-02"), (3, "2024-01-03"))
    replace_days(rows.unionByName(rows.limit(1).withColumn(DAY, F.lit(None).cast("date"))), name, path)
    replace_days(days(spark, (9, "2024-01-01")), name, path, days=("2024-01-01", "2024-01-02"))
    def listed():
        return sorted((r.v, str(r[DAY])) for r in spark.table(name).collect())

    before = listed()
    assert len(before) == 3
    spark.sql(f"drop table {name}")
    replace_days(days(spark, (5, "2024-01-05")), name, path)
    assert listed() == sorted([*before, (5, "2024-01-05")])


def test_superseded_versions_are_dropped_after_a_while(spark, lake):
    name, path = lake.name("playerlogs"), lake.path("playerlogs")
    for v in (1, 2):
        replace_days(days(spark, (v, "2024-01-01"), (v, "2024-01-02")), name, path)
    replace_days(days(spark, (3, "2024-01-02")), name, path)
    assert drop_superseded(spark, name) == 0
    assert drop_superseded(spark, name, timedelta(0)) == 3
    assert content(spark, name) == [(2, "2024-01-01"), (3, "2024-01-02")]
    assert drop_superseded(spark, name, timedelta(0)) == 0


def test_the_catalog_is_asked_and_no_day_is_listed(spark, lake, monkeypatch):
    name, path = lake.name("playerlogs"), lake.path("playerlogs")
    many = [(k, f"2024-01-{k:02d}") for k in range(1, 31)]
    replace_days(days(spark, *many), name, path)
    asked = []
    monkeypatch.setattr(tables, "folder_names", lambda s, f, names=folder_names: asked.append(f) or names(s, f))
    replace_days(days(spark, *many), name, path, days=("2024-01-01", "2024-01-31"))
    assert len(asked) == 1


@pytest.mark.parametrize("moved", ["none", "old", "both"])
def test_an_archive_whose_swap_ended_early_is_finished(spark, moved):
    path = scratch_path(spark, "archive")
    month_to_parquet(days(spark, (1, "2024-01-01")), path)
    days(spark, (2, "2024-01-01")).write.parquet(f"{path}.checked-x")
    if moved != "none":
        move(spark, path, f"{path}.old-y")
    if moved == "both":
        move(spark, f"{path}.checked-x", path)
    assert finish_archive(spark, path) == (moved == "old")
    assert [r.v for r in spark.read.parquet(path).collect()] == [1 if moved == "none" else 2]
    root, name = path.rsplit("/", 1)
    assert [x for x in folder_names(spark, root) if x.startswith(name)] == [name]


def test_superseded_versions_of_all_tables(spark, lake, capsys):
    name, path = lake.name("room_end_time"), lake.path("room_end_time")
    for v in (1, 2):
        replace_days(days(spark, (v, "2024-01-01")), name, path)
    run(spark, ["--root", lake.root, "--suffix", lake.suffix, "drop-superseded", "--hours", "0"])
    assert f"{name}: 1" in capsys.readouterr().out
    assert content(spark, name) == [(2, "2024-01-01")]


def test_options_of_streams_and_refits():
    args = parser().parse_args(["--root", "r", "ingest", "h", "t", "--joint", "--follow"])
    assert args.joint and args.follow
    assert parser().parse_args(["--root", "r", "refit", "--publish"]).publish


def test_a_refit_is_published(spark):
    lake = new_lake(spark, playerlogs=bronze_table(spark, SF))
    jobs.silver_train_movement(spark, lake, "2024-01-05")
    for version in (1, 2):
        model, _ = jobs.refit(spark, lake, publish=True)
        number, published = current_model(spark, lake.models_path)
        assert number == version
        assert published.stages[-1].clusterCenters()[0].tolist() == model.stages[-1].clusterCenters()[0].tolist()

"""Streams against their batch twins."""

import pytest
from compare import bag
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from arenalake.operators.bronze import parse_messages, split_rows
from arenalake.operators.cluster import fit_clusters, predict
from arenalake.plans.jobs import archive_month
from arenalake.registry.prepared import bronze, fitted_model, landed_messages, new_lake, raw
from arenalake.schema import RAW_SCHEMA
from arenalake.sinks.scratch import scratch_path
from arenalake.sinks.files import delete
from arenalake.sinks.models import current_model, publish_model
from arenalake.sinks.tables import BATCH, append_days, replace_batch, replace_days
from arenalake.sources.messages import text_messages
from arenalake.sources.playerlogs import read_table, to_messages
from arenalake.streaming import ingest
from arenalake.streaming.joint import MODEL_VERSION, start_joint_ingest
from arenalake.streaming.rate import message_rate

SF = "/root/testdata/sf0.001"
DRAIN = {"availableNow": True}


def start(spark, lake, path=None, starter=ingest.start_table_ingest, **options):
    messages = text_messages(spark, path or landed_messages(spark, SF))
    ingest.run_all(starter(messages, lake, trigger=DRAIN, **options), poll_seconds=1)


def test_landed_messages_are_small_compressed_files(spark):
    """All messages, in a fifth of their length at most, and no file with too many for a task."""
    sf = "/root/testdata/sf0.1"
    landed = spark.read.text(landed_messages(spark, sf))
    sums = [F.count("*"), F.sum(F.length("value")), F.sum(F.crc32("value"))]
    want = to_messages(raw(spark, sf)).agg(*sums).first()
    assert landed.agg(*sums).first() == want
    files = landed.select("value", "_metadata.file_path", "_metadata.file_size").groupBy("file_path")
    sizes = files.agg(F.count("*").alias("n"), F.first("file_size").alias("size"))
    largest, size = sizes.agg(F.max("n"), F.sum("size")).first()
    assert largest <= 25_000 and size * 5 < want[1]


def test_tables_equal_the_batch_and_a_restart_adds_nothing(spark, lake):
    valid, refused = split_rows(raw(spark, SF))
    for _ in range(2):
        start(spark, lake)
        assert bag(spark.table(lake.name("playerlogs"))) == bag(valid)
        assert bag(spark.table(lake.name("invalid_data"))) == bag(refused)


def test_a_batch_cannot_write_into_a_stream_table(spark, lake):
    start(spark, lake)
    for write in (append_days, replace_days):
        with pytest.raises(ValueError, match="belongs to a stream"):
            write(bronze(spark, SF), lake.name("playerlogs"), lake.path("playerlogs"))


def test_new_files_are_picked_up_where_it_stopped(spark, lake):
    path = scratch_path(spark, "landing")
    rows = to_messages(raw(spark, SF))
    first = F.col("value").contains("/move")
    rows.filter(first).write.text(path)
    start(spark, lake, path)
    rows.filter(~first).write.mode("append").text(path)
    start(spark, lake, path)
    assert bag(spark.table(lake.name("playerlogs"))) == bag(bronze(spark, SF))


def test_quarantine_is_partitioned_by_day(spark, lake):
    start(spark, lake)
    partitions = spark.sql(f"describe {lake.name('invalid_data')}").collect()
    names = [r.col_name for r in partitions]
    assert names[names.index("# col_name") + 1] == "create_room_date"


def test_json_files(spark, lake):
    start(spark, lake, starter=ingest.start_json_ingest, clear=True)
    got = spark.read.schema(bronze(spark, SF).schema).json(lake.path("playerlogs"))
    assert bag(got) == bag(bronze(spark, SF))
    refused = spark.read.schema(RAW_SCHEMA).json(lake.path("invalid_data"))
    assert bag(refused) == bag(split_rows(raw(spark, SF), clear=True)[1].drop("create_room_date"))


def test_scored_stream(spark, lake):
    model = fitted_model(spark, SF)
    start(spark, lake, model=model)
    scored = spark.table(lake.name("playerlogs"))
    assert "features_vector" not in scored.columns
    assert bag(scored) == bag(predict(model, bronze(spark, SF)))


def test_archive_of_a_scored_json_stream(spark, lake):
    """Keeps the prediction, and leaves out files the stream's log does not know."""
    model = fitted_model(spark, SF)
    start(spark, lake, model=model, starter=ingest.start_json_ingest)
    scored = predict(model, bronze(spark, SF))
    stray = f"{lake.path('playerlogs')}/create_room_date=2024-01-05"
    scored.drop("create_room_date").limit(5).write.mode("append").json(stray)
    archived = spark.read.parquet(archive_month(spark, lake, "2024-01-31", lake.path("playerlogs")))
    assert bag(archived) == bag(scored)


def test_broken_messages_reach_the_quarantine(spark, lake):
    path = scratch_path(spark, "landing")
    spark.createDataFrame([("{broken",), ("",)], "value string").write.text(path)
    start(spark, lake, path, keep_text=True, clear=True)
    assert spark.table(lake.name("playerlogs")).count() == 0
    assert {r._raw for r in spark.table(lake.name("invalid_data")).collect()} == {"{broken", ""}


def test_one_failure_stops_all(spark):
    lake = new_lake(spark)
    messages = text_messages(spark, landed_messages(spark, SF))
    failure = F.raise_error(F.lit("broken sink")).cast("string")
    failing = parse_messages(messages).select(failure.alias("c"))
    good = parse_messages(messages)
    forever = {"processingTime": "1 hour"}
    queries = [
        ingest.to_files(
            ingest.append_stream(
                rows, f"{lake.root}/{name}-c", name, partition=None, trigger=forever
            ),
            f"{lake.root}/{name}",
        )
        for rows, name in ((good, "good"), (failing, "failing"))
    ]
    with pytest.raises(Exception, match="broken sink"):
        ingest.run_all(queries, poll_seconds=0.2)
    assert not any(q.isActive for q in queries)


def test_rate_of_a_stream(spark):
    """All windows but the last, which stays open below the watermark."""
    events = read_table(spark, SF, "events")
    want = message_rate(events, "ts")
    path = scratch_path(spark, "rate")
    events.write.parquet(f"{path}/in")
    stream = spark.readStream.schema(events.schema).parquet(f"{path}/in")
    writer = ingest.append_stream(
        message_rate(stream, "ts", late="10 minutes"), f"{path}/c", "rate", partition=None,
        trigger=DRAIN,
    )
    ingest.run_all([ingest.to_files(writer, f"{path}/out")])
    got = spark.read.parquet(f"{path}/out")
    last = want.agg(F.max("window_start")).first()[0]
    assert bag(got.filter(F.col("window_start") < last)) == bag(
        want.filter(F.col("window_start") < last)
    )


def landed(spark, files=4):
    path = scratch_path(spark, "landed")
    to_messages(raw(spark, SF)).repartition(files).write.text(path)
    return path


def joint(spark, lake, path, files=1, **options):
    messages = text_messages(spark, path, maxFilesPerTrigger=files)
    running = start_joint_ingest(messages, lake, trigger=DRAIN, **options)
    ingest.run_all([running], poll_seconds=1)
    return running


def assert_joint_tables(spark, lake):
    valid, refused = split_rows(raw(spark, SF))
    assert bag(spark.table(lake.name("playerlogs")).drop(BATCH)) == bag(valid)
    assert bag(spark.table(lake.name("invalid_data")).drop(BATCH)) == bag(refused)


def test_both_branches_from_one_read(spark, lake):
    running = joint(spark, lake, landed(spark))
    assert_joint_tables(spark, lake)
    batches = [x for x in running.recentProgress if x["numInputRows"]]
    assert len(batches) == 4
    assert sum(x["numInputRows"] for x in batches) == raw(spark, SF).count()


@pytest.mark.parametrize("table", ["playerlogs", "invalid_data"])
@pytest.mark.parametrize("before", [True, False])
def test_a_batch_that_failed_is_run_again_and_adds_nothing(spark, lake, table, before):
    """Stops before or after the write of either table in the second batch."""
    path, failures = landed(spark), [1]

    def write(rows, name, place, number, fmt):
        fails = failures and name == lake.name(table) and number == failures[0]
        if not (fails and before):
            replace_batch(rows, name, place, number, fmt)
        if fails:
            failures.clear()
            raise RuntimeError("stopped inside the batch")

    with pytest.raises(StreamingQueryException, match="stopped inside the batch"):
        joint(spark, lake, path, write=write)
    joint(spark, lake, path, write=write)
    assert_joint_tables(spark, lake)


def test_a_batch_without_its_commit_is_run_again(spark, lake):
    path = landed(spark)
    joint(spark, lake, path)
    delete(spark, f"{lake.checkpoint_of('both')}/commits/3")
    joint(spark, lake, path)
    assert_joint_tables(spark, lake)


def test_days_of_a_failed_try_do_not_stay(spark, lake):
    name, path = lake.name("playerlogs"), lake.path("playerlogs")

    def rows(*days):
        return spark.createDataFrame([(k, d) for k, d in enumerate(days)], "v int, d string").select(
            "v", F.col("d").cast("date").alias("create_room_date")
        )

    lake.create_databases(spark)
    replace_batch(rows("2024-01-01", "2024-01-02", None), name, path, 0)
    replace_batch(rows("2024-01-01"), name, path, 1)
    replace_batch(rows("2024-01-03", None), name, path, 0)
    got = sorted((r[BATCH], str(r.create_room_date), r.v) for r in spark.table(name).collect())
    assert got == [(0, "2024-01-03", 0), (0, "None", 1), (1, "2024-01-01", 0)]
    replace_batch(rows(), name, path, 0)
    assert spark.table(name).count() == 1
    with pytest.raises(ValueError, match="differ"):
        replace_batch(rows("2024-01-01").drop("v"), name, path, 2)


def test_a_refit_takes_effect_in_a_running_stream(spark, lake):
    models = scratch_path(spark, "models")
    first = fitted_model(spark, SF)
    second = fit_clusters(bronze(spark, SF), k=3)
    assert publish_model(spark, first, models) == 1

    def write(rows, name, place, number, fmt):
        replace_batch(rows, name, place, number, fmt)
        if number == 1 and name == lake.name("invalid_data"):
            assert publish_model(spark, second, models) == 2

    joint(spark, lake, landed(spark), models=models, write=write)
    scored = spark.table(lake.name("playerlogs"))
    versions = {(r[BATCH], r[MODEL_VERSION]) for r in scored.select(BATCH, MODEL_VERSION).distinct().collect()}
    assert versions == {(0, 1), (1, 1), (2, 2), (3, 2)}
    for version, model in ((1, first), (2, second)):
        own = scored.filter(F.col(MODEL_VERSION) == version)
        assert bag(own) == bag(predict(model, own.drop("prediction")).select(*own.columns))


def test_a_version_counts_when_it_is_whole(spark):
    models = scratch_path(spark, "models")
    with pytest.raises(FileNotFoundError, match="no model"):
        current_model(spark, models)
    publish_model(spark, fitted_model(spark, SF), models)
    fitted_model(spark, SF).write().save(f"{models}/version=2/model")
    assert current_model(spark, models)[0] == 1
    assert publish_model(spark, fitted_model(spark, SF), models) == 3
    assert current_model(spark, models)[0] == 3


@pytest.mark.parametrize("log", ["commit", "sink"])
def test_file_sinks_after_a_failure_inside_a_batch(spark, lake, log):
    path = landed(spark)

    def drain():
        messages = text_messages(spark, path, maxFilesPerTrigger=1)
        ingest.run_all(ingest.start_table_ingest(messages, lake, trigger=DRAIN), poll_seconds=1)

    drain()
    for table in ("playerlogs", "invalid_data"):
        delete(spark, f"{lake.checkpoint(table)}/commits/3")
        if log == "sink":
            delete(spark, f"{lake.path(table)}/_spark_metadata/3")
    drain()
    valid, refused = split_rows(raw(spark, SF))
    for table, rows in (("playerlogs", valid), ("invalid_data", refused)):
        spark.catalog.refreshTable(lake.name(table))
        assert bag(spark.table(lake.name(table))) == bag(rows)


def test_a_query_that_cannot_start_stops_the_others(spark, lake):
    messages = text_messages(spark, landed(spark))
    good = ingest.append_stream(
        parse_messages(messages), f"{lake.root}/good-c", "good", partition=None, trigger={"processingTime": "1 hour"}
    )

    def fails(writer):
        raise OSError("no such place")

    started = []

    def starts(writer):
        started.append(ingest.to_files(writer, f"{lake.root}/good"))
        return started[0]

    with pytest.raises(OSError, match="no such place"):
        ingest.start_all([(good, starts), (good, fails)])
    assert not started[0].isActive


def test_bounded_batches(spark):
    messages = text_messages(spark, landed(spark, 6), maxFilesPerTrigger=2)
    path = scratch_path(spark, "bounded")
    writer = ingest.append_stream(parse_messages(messages), f"{path}-c", "bounded", partition=None, trigger=DRAIN)
    received = ingest.to_files(writer, path)
    ingest.run_all([received])
    sizes = [x["numInputRows"] for x in received.recentProgress if x["numInputRows"]]
    total = raw(spark, SF).count()
    assert len(sizes) == 3 and sum(sizes) == total and max(sizes) <= total * 2 / 6 + 6

"""One query per operator, each over all rows of the test tables."""

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import wraps

from pyspark.errors import StreamingQueryException
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from arenalake.functions.casts import month_of, parse_day, to_day, to_instant, to_int
from arenalake.functions.features import (
    buy_flag,
    champion_label,
    pseudonym,
    share,
    step_distance,
    x_plus_y,
)
from arenalake.lake import GOLD_TABLES, Lake
from arenalake.operators.bronze import (
    drop_features,
    invalid_rows,
    mask_identity,
    message_text,
    parse_messages,
    raw_fields,
    typed_rows,
    valid_rows,
)
from arenalake.operators.cluster import assembler, fit_clusters, predict, silhouette
from arenalake.operators.frequency import frequency_index
from arenalake.operators.gold import gold_from_events, summarise
from arenalake.operators.silver import (
    ROOM_TIME,
    analysis_rows,
    fill_movement,
    labelled_rows,
    movement_rows,
    present_rows,
    sort_room_time,
    train_indexed_rows,
    with_previous_position,
)
from arenalake.plans import jobs
from arenalake.registry.prepared import (
    bronze,
    bronze_table,
    day_range,
    fitted_model,
    landed_messages,
    movement_table,
    new_lake,
    one_day,
    raw,
    separated,
    shared_scratch,
    silver_table,
    some_days,
)
from arenalake.schema import BRONZE_SCHEMA, DAY, FEATURES, PREDICTION, RAW_SCHEMA, TRAIN_COLUMNS
from arenalake.sinks.files import delete
from arenalake.sinks.models import load_model, publish_model, save_model
from arenalake.sinks.scratch import scratch_path
from arenalake.sinks.tables import BATCH, replace_batch, replace_days, replace_table
from arenalake.sources.archive import json_month
from arenalake.sources.messages import text_messages
from arenalake.sources.playerlogs import read_table, to_messages
from arenalake.sources.tables import table_day_where, table_days
from arenalake.streaming import ingest
from arenalake.streaming.joint import MODEL_VERSION, start_joint_ingest
from arenalake.streaming.rate import message_rate

DRAIN = {"availableNow": True}

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query_named(name: str) -> Callable[[Query], Query]:
    def register(function):
        @wraps(function)
        def prepared(spark, sf_dir):
            shared_scratch(spark)
            return function(spark, sf_dir)

        QUERIES[name] = prepared
        return prepared

    return register


def query(function: Query) -> Query:
    return query_named(function.__name__)(function)


def plain(rows: DataFrame) -> DataFrame:
    """Timestamps without zone, so that results compare across engines."""
    zoned = [f.name for f in rows.schema.fields if isinstance(f.dataType, TimestampType)]
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})


def rounded(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.withColumns({c: F.round(c, 6) for c in columns})


# Sources


@query
def src_kafka_stream(spark, sf_dir):
    """A message stream with a ``value`` column; the text source stands in for Kafka."""
    stream = parse_messages(text_messages(spark, landed_messages(spark, sf_dir)))
    path = scratch_path(spark, "received")
    writer = ingest.append_stream(
        stream, f"{path}-checkpoint", "received", partition=None, trigger=DRAIN
    )
    ingest.run_all([ingest.to_files(writer, path)])
    return spark.read.schema(RAW_SCHEMA).parquet(path)


#: Files of messages, and how many of them a bounded micro-batch takes.
LANDED_FILES, BATCH_FILES = 6, 2
BOUNDED = {"maxFilesPerTrigger": BATCH_FILES}


def _landed_files(spark, sf_dir):
    """Folder with the messages of all events in ``LANDED_FILES`` files."""
    path = scratch_path(spark, "landed")
    to_messages(raw(spark, sf_dir)).repartition(LANDED_FILES).write.text(path)
    return path


@query
def src_kafka_stream_bounded(spark, sf_dir):
    """A backlog drained in several micro-batches of bounded size; each row once, with no batch too large."""
    stream = parse_messages(text_messages(spark, _landed_files(spark, sf_dir), **BOUNDED))
    path = scratch_path(spark, "received")
    writer = ingest.append_stream(stream, f"{path}-checkpoint", "bounded", partition=None, trigger=DRAIN)
    received = ingest.to_files(writer, path)
    ingest.run_all([received])
    sizes = [x["numInputRows"] for x in received.recentProgress if x["numInputRows"]]
    if len(sizes) < LANDED_FILES // BATCH_FILES:
        raise AssertionError(f"the backlog came in {len(sizes)} batches")
    return spark.read.schema(RAW_SCHEMA).parquet(path)


def _json_days(spark, sf_dir):
    path = scratch_path(spark, "json")
    bronze(spark, sf_dir).hint("rebalance", DAY).write.partitionBy(DAY).json(path)
    return path


@query
def src_json_month_glob(spark, sf_dir):
    return plain(json_month(spark, _json_days(spark, sf_dir), one_day(spark, sf_dir), BRONZE_SCHEMA))


@query
def src_table_day(spark, sf_dir):
    return plain(table_days(spark, bronze_table(spark, sf_dir), one_day(spark, sf_dir)))


@query
def src_table_day_sql(spark, sf_dir):
    return plain(table_day_where(spark, silver_table(spark, sf_dir), one_day(spark, sf_dir)))


@query
def src_table_full(spark, sf_dir):
    """The training table a refit reads."""
    return plain(spark.table(movement_table(spark, sf_dir)))


def _disagreements(rows, first, second):
    """(rows, differing): how often two models predict differently."""
    both = first(rows).withColumnRenamed(PREDICTION, "_first")
    return second(both).agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("_first") != F.col(PREDICTION)).alias("differing"),
    )


@query
def src_model_load(spark, sf_dir):
    """A loaded model predicts what the fitted one does."""
    model, path = fitted_model(spark, sf_dir), scratch_path(spark, "model")
    save_model(model, path)
    loaded = load_model(path)
    return _disagreements(
        bronze(spark, sf_dir), lambda r: predict(model, r), lambda r: predict(loaded, r)
    )


# Sinks


def _ingested(spark, sf_dir, start=ingest.start_table_ingest, model=None, **options) -> Lake:
    lake = new_lake(spark)
    messages = text_messages(spark, landed_messages(spark, sf_dir))
    ingest.run_all(start(messages, lake, model, DRAIN, **options))
    return lake


@query
def sink_stream_parquet_table(spark, sf_dir):
    return plain(spark.table(_ingested(spark, sf_dir).name("playerlogs")))


@query
def sink_stream_quarantine_table(spark, sf_dir):
    return spark.table(_ingested(spark, sf_dir, clear=True).name("invalid_data"))


@query
def sink_stream_json_path(spark, sf_dir):
    lake = _ingested(spark, sf_dir, ingest.start_json_ingest)
    return plain(spark.read.schema(BRONZE_SCHEMA).json(lake.path("playerlogs")))


@query
def sink_stream_quarantine_json(spark, sf_dir):
    lake = _ingested(spark, sf_dir, ingest.start_json_ingest, clear=True)
    return spark.read.schema(RAW_SCHEMA).json(lake.path("invalid_data"))


@query
def sink_dynamic_partition_overwrite(spark, sf_dir):
    """Write all days twice over, then two days shifted, at once and from two sessions.

    Only these two days change, although both sessions replace all days of a write by
    default.
    """
    lake = new_lake(spark)
    name, path = lake.name("playerlogs"), lake.path("playerlogs")
    for _ in range(2):
        replace_days(bronze(spark, sf_dir), name, path, rebalance=True)

    def shift(session, day, by):
        rows = bronze(session, sf_dir).filter(F.col(DAY) == F.lit(day))
        replace_days(rows.withColumn("x", F.col("x") + by), name, path, days=(day, day))

    day, other = one_day(spark, sf_dir), day_range(spark, sf_dir)[0]
    with ThreadPoolExecutor(2) as pool:
        work = [pool.submit(shift, spark, day, 1000), pool.submit(shift, spark.newSession(), other, 2000)]
        for done in work:
            done.result()
    spark.catalog.refreshTable(name)
    return plain(spark.table(name))


@query
def sink_full_overwrite(spark, sf_dir):
    """Write all rows, then the valid VIKTOR rows: nothing else is left."""
    lake = new_lake(spark)
    name, path = lake.name("delta_playerlogs"), lake.path("delta_playerlogs")
    rows = bronze(spark, sf_dir)
    replace_table(rows, name, path)
    replace_table(rows.filter(champion_label() == 1), name, path)
    return plain(spark.table(name))


def _archived(spark, sf_dir):
    """The archive of the table the default ingest writes."""
    lake = _ingested(spark, sf_dir)
    return jobs.archive_month(spark, lake, one_day(spark, sf_dir))


@query
def sink_month_archive(spark, sf_dir):
    """An archive written twice: all rows, read back from the zstd folder."""
    lake = _ingested(spark, sf_dir)
    for _ in range(2):
        path = jobs.archive_month(spark, lake, one_day(spark, sf_dir))
    return plain(spark.read.parquet(path))


@query
def sink_month_archive_json(spark, sf_dir):
    """The same from JSON day folders."""
    base = _json_days(spark, sf_dir)
    path = jobs.archive_month(spark, new_lake(spark), one_day(spark, sf_dir), base, BRONZE_SCHEMA)
    return plain(spark.read.parquet(path))


@query
def sink_model_save(spark, sf_dir):
    """Saving over a stored model replaces it."""
    path = scratch_path(spark, "model")
    rows = bronze(spark, sf_dir)
    save_model(fit_clusters(rows, k=3), path)
    model = fitted_model(spark, sf_dir)
    save_model(model, path)
    stored = load_model(path)
    return _disagreements(rows, lambda r: predict(model, r), lambda r: predict(stored, r))


# Projections and scalar functions


@query
def parse_value_string(spark, sf_dir):
    """Binary messages to text; measured, since engines print JSON differently."""
    binary = to_messages(raw(spark, sf_dir)).select(F.col("value").cast("binary").alias("value"))
    return message_text(binary).select(
        F.get_json_object("value", "$.datetime").alias("datetime"),
        F.get_json_object("value", "$.x").alias("x"),
        F.get_json_object("value", "$.ip").alias("ip"),
    )


@query
def parse_json_fixed(spark, sf_dir):
    """All fields of every message, from its binary form."""
    binary = to_messages(raw(spark, sf_dir)).select(F.col("value").cast("binary").alias("value"))
    return parse_messages(binary)


@query
def expand_struct(spark, sf_dir):
    return raw_fields(parse_messages(to_messages(raw(spark, sf_dir))))


@query
def typed_rename(spark, sf_dir):
    return plain(typed_rows(valid_rows(raw(spark, sf_dir))))


@query
def cast_int(spark, sf_dir):
    names = ("ingametime", "deathCount", "x", "y", "status")
    return raw(spark, sf_dir).select("datetime", "ip", *[to_int(c).alias(c) for c in names])


@query
def cast_date(spark, sf_dir):
    return raw(spark, sf_dir).select("ip", "ingametime", to_day("createRoomDate").alias(DAY))


@query
def cast_timestamp(spark, sf_dir):
    return plain(raw(spark, sf_dir).select("ip", "x", to_instant("datetime").alias("datetime")))


@query
def pseudonymise_account(spark, sf_dir):
    return raw(spark, sf_dir).select(
        "roomID", "ingametime", pseudonym("account").alias("encrypted_account")
    )


@query
def drop_columns(spark, sf_dir):
    """Account, address and the vector of the model are gone."""
    masked = mask_identity(typed_rows(valid_rows(raw(spark, sf_dir))))
    return plain(drop_features(assembler().transform(masked)))


@query
def derive_x_plus_y(spark, sf_dir):
    return bronze(spark, sf_dir).select("x", "y", x_plus_y().alias("x+y"))


@query
def flag_buy(spark, sf_dir):
    return bronze(spark, sf_dir).select("room_id", "method", "x", buy_flag().alias("buy"))


@query
def label_champion(spark, sf_dir):
    return bronze(spark, sf_dir).select("champion", "x", "y", champion_label().alias("label"))


@query
def date_from_timestamp(spark, sf_dir):
    return bronze(spark, sf_dir).select(
        "x", "current_time", F.col("datetime").cast("date").alias(DAY)
    )


@query
def parse_date_fmt(spark, sf_dir):
    """Text through the pattern, and a date that passes unchanged."""
    return raw(spark, sf_dir).select(
        "x",
        parse_day(F.substring("createRoomDate", 1, 10)).alias("from_text"),
        parse_day(to_day("createRoomDate")).alias("from_date"),
    )


@query
def subset_columns(spark, sf_dir):
    """The columns of the training table, under the day of the room."""
    return plain(labelled_rows(bronze(spark, sf_dir)).select(*TRAIN_COLUMNS))


@query
def fill_nulls(spark, sf_dir):
    moved = with_previous_position(bronze(spark, sf_dir))
    filled = fill_movement(moved.withColumn("distance", step_distance()))
    return filled.select("encrypted_account", DAY, "prev_x", "prev_y", "distance")


@query
def euclid_step(spark, sf_dir):
    moved = with_previous_position(bronze(spark, sf_dir))
    return moved.select("x", "y", "prev_x", "prev_y", step_distance().alias("distance"))


@query
def ratio_round2(spark, sf_dir):
    counts = summarise(analysis_rows(bronze(spark, sf_dir)), ["room_id", "champion"])
    return counts.select("room_id", "champion", share("used", "total").alias("total_q"))


@query
def month_of_date(spark, sf_dir):
    return (
        bronze(spark, sf_dir)
        .groupBy(month_of(DAY).alias("month"), "champion")
        .agg(F.count("*").alias("rows"))
    )


# Filters


@query_named("valid_rows")
def valid_raw(spark, sf_dir):
    return valid_rows(raw(spark, sf_dir))


@query_named("invalid_rows")
def invalid_raw(spark, sf_dir):
    return invalid_rows(raw(spark, sf_dir))


@query
def filter_day(spark, sf_dir):
    """A range of days of the stored bronze table, counted."""
    days = table_days(spark, bronze_table(spark, sf_dir), *some_days(spark, sf_dir))
    return days.groupBy(DAY, "champion").agg(F.count("*").alias("rows"))


@query
def silver_keep_any(spark, sf_dir):
    return plain(present_rows(bronze(spark, sf_dir), "any"))


@query
def silver_keep_all(spark, sf_dir):
    return plain(present_rows(bronze(spark, sf_dir), "all"))


# Aggregations


def _gold(spark, sf_dir, name):
    return gold_from_events(analysis_rows(bronze(spark, sf_dir)), name)


@query
def gold_average_death_and_time(spark, sf_dir):
    rows = _gold(spark, sf_dir, "average_death_and_time")
    return rounded(rows, "average_deaths", "average_game_time")


@query
def gold_champion_death_count(spark, sf_dir):
    return _gold(spark, sf_dir, "champion_death_count")


@query
def gold_key_used_per(spark, sf_dir):
    return _gold(spark, sf_dir, "key_used_per")


@query
def gold_room_end_time(spark, sf_dir):
    return _gold(spark, sf_dir, "room_end_time")


@query
def gold_room_champion_xy(spark, sf_dir):
    return rounded(_gold(spark, sf_dir, "room_champion_xy"), "stddev_x", "stddev_y")


# Windows


@query
def prev_position(spark, sf_dir):
    return plain(with_previous_position(bronze(spark, sf_dir)))


@query
def prev_position_per_room(spark, sf_dir):
    return plain(with_previous_position(bronze(spark, sf_dir), per_room=True))


@query
def prev_position_sliced(spark, sf_dir):
    """The same as prev_position, with every account above 3 rows a day split into slices."""
    rows = bronze(spark, sf_dir)
    return plain(with_previous_position(rows, hot_rows=3, slice_rows=500))


@query
def movement_features(spark, sf_dir):
    return plain(movement_rows(bronze(spark, sf_dir)))


# Sorts


@query_named("sort_room_time")
def sort_room_time_rows(spark, sf_dir):
    return plain(sort_room_time(analysis_rows(bronze(spark, sf_dir))))


def _order_violations(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(rows, violations): neighbours of one partition that descend, and partitions that begin too low."""
    key = F.struct(*keys)
    placed = rows.select(
        key.alias("key"),
        F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().alias("place"),
    )
    before = F.lag("key").over(Window.partitionBy("part").orderBy("place"))
    inside = placed.select("*", (before > F.col("key")).cast("long").alias("wrong"))
    # One row for each partition.
    parts = inside.groupBy("part").agg(
        F.count("*").alias("rows"), F.sum("wrong").alias("wrong"), F.min("key").alias("low"), F.max("key").alias("high")
    )
    last = F.lag("high").over(Window.orderBy("part"))
    parts = parts.select("rows", "wrong", (last > F.col("low")).cast("long").alias("border"))
    return parts.agg(
        F.sum("rows").alias("rows"),
        (F.coalesce(F.sum("wrong"), F.lit(0)) + F.coalesce(F.sum("border"), F.lit(0))).alias("violations"),
    )


@query
def sort_room(spark, sf_dir):
    """The gold table in the order of rooms: how often neighbours or partitions are out of order."""
    keys = ["room_id", "champion", DAY]
    return _order_violations(_gold(spark, sf_dir, "champion_death_count").orderBy(*keys), keys)


@query
def sort_room_time_order(spark, sf_dir):
    return _order_violations(sort_room_time(analysis_rows(bronze(spark, sf_dir))), ROOM_TIME)


# Machine learning


@query
def ml_string_index(spark, sf_dir):
    outputs = {"champion": "champion_indexed", "inputkey": "inputkey_indexed"}
    indexed = frequency_index(bronze(spark, sf_dir), outputs)
    return indexed.select("champion", "champion_indexed", "inputkey", "inputkey_indexed")


@query
def ml_string_index_shuffled(spark, sf_dir):
    """The same with values ranked in slices."""
    outputs = {"champion": "champion_indexed", "inputkey": "inputkey_indexed"}
    indexed = frequency_index(bronze(spark, sf_dir), outputs, hot_rows=5, slice_rows=5)
    return indexed.select("champion", "champion_indexed", "inputkey", "inputkey_indexed")


@query
def train_table_indexed(spark, sf_dir):
    return plain(train_indexed_rows(bronze(spark, sf_dir)))


@query
def ml_assemble(spark, sf_dir):
    vectors = assembler().transform(bronze(spark, sf_dir).select("room_id", "x", "y"))
    parts = vector_to_array(FEATURES)
    return vectors.select("room_id", parts[0].alias("v0"), parts[1].alias("v1"))


def _by_centre(model: PipelineModel) -> Column:
    """The number of a row's cluster, counted by the centres' x."""
    centres = model.stages[-1].clusterCenters()
    order = sorted(range(len(centres)), key=lambda i: centres[i][0])
    return F.element_at(F.array(*(F.lit(order.index(i)) for i in range(len(centres)))), F.col(PREDICTION) + 1)


@query
def ml_kmeans_fit(spark, sf_dir):
    """Sizes and centres of a fit on two groups far apart."""
    rows = separated(spark, sf_dir)
    model = fit_clusters(rows)
    order = sorted((float(x), float(y)) for x, y in model.stages[-1].clusterCenters())
    centres = spark.createDataFrame(
        [(i, x, y) for i, (x, y) in enumerate(order)], "cluster int, centre_x double, centre_y double"
    )
    sizes = predict(model, rows).groupBy(_by_centre(model).alias("cluster")).agg(F.count("*").alias("rows"))
    return rounded(sizes.join(F.broadcast(centres), "cluster"), "centre_x", "centre_y")


@query
def ml_predict_batch(spark, sf_dir):
    rows = separated(spark, sf_dir)
    model = fit_clusters(rows)
    return predict(model, rows).select("event_id", "x", "y", _by_centre(model).alias("cluster"))


@query
def ml_predict_nearest(spark, sf_dir):
    """(rows, away): how many predictions are not the nearest centre."""
    model = fitted_model(spark, sf_dir)
    centres = model.stages[-1].clusterCenters()
    squares = [
        (F.col("x") - float(x)) ** 2 + (F.col("y") - float(y)) ** 2 for x, y in centres
    ]
    chosen = F.element_at(F.array(*squares), F.col(PREDICTION) + 1)
    return predict(model, bronze(spark, sf_dir)).agg(
        F.count("*").alias("rows"), F.count_if(chosen > F.least(*squares)).alias("away")
    )


@query
def ml_silhouette(spark, sf_dir):
    rows = separated(spark, sf_dir)
    score = silhouette(fit_clusters(rows), rows)
    return rounded(spark.createDataFrame([(score,)], "silhouette double"), "silhouette")


@query
def ml_score_stream(spark, sf_dir):
    """Rows scored in the stream, against the same model on the stored rows."""
    model = fitted_model(spark, sf_dir)
    lake = _ingested(spark, sf_dir, model=model)
    scored = spark.table(lake.name("playerlogs"))
    return _disagreements(scored, lambda rows: rows, lambda rows: predict(model, rows))


@query
def ml_score_stream_refit(spark, sf_dir):
    """A model published while the stream runs scores the batches after it; each row agrees with its version."""
    lake, models = new_lake(spark), scratch_path(spark, "models")
    versions = {publish_model(spark, model := fitted_model(spark, sf_dir), models): model}

    def write(rows, table, path, number, fmt):
        replace_batch(rows, table, path, number, fmt)
        if number == 0 and len(versions) == 1:
            model = fit_clusters(bronze(spark, sf_dir), k=3)
            versions[publish_model(spark, model, models)] = model

    messages = text_messages(spark, _landed_files(spark, sf_dir), **BOUNDED)
    ingest.run_all([start_joint_ingest(messages, lake, models, DRAIN, write=write)])
    scored, result = spark.table(lake.name("playerlogs")), None
    for version, model in versions.items():
        own = scored.filter(F.col(MODEL_VERSION) == version)
        same = _disagreements(own, lambda rows: rows, lambda rows, model=model: predict(model, rows))
        result = same if result is None else result.unionByName(same)
    return result.agg(
        F.sum("rows").alias("rows"), F.count_if(F.col("rows") > 0).alias("versions"), F.sum("differing").alias("differing")
    )


# Streaming


@query
def stream_checkpoint(spark, sf_dir):
    """Starting the drained stream again from its checkpoints adds nothing."""
    lake = new_lake(spark)
    for _ in range(2):
        messages = text_messages(spark, landed_messages(spark, sf_dir))
        ingest.run_all(ingest.start_table_ingest(messages, lake, trigger=DRAIN))
    return plain(spark.table(lake.name("playerlogs")))


@query
def stream_fanout(spark, sf_dir):
    """What both branches add up to per day."""
    lake = _ingested(spark, sf_dir)
    return _day_sums(spark, lake, ["playerlogs", "invalid_data"])


@query
def stream_fanout_once(spark, sf_dir):
    """Both branches by one query from one read; a batch that failed between its two writes is run again."""
    lake, failures = new_lake(spark), [1]
    path = _landed_files(spark, sf_dir)

    def write(rows, table, *rest):
        if failures and table == lake.name("invalid_data") and rest[1] == failures[0]:
            failures.clear()
            raise RuntimeError("stopped between the two writes")
        replace_batch(rows, table, *rest)

    for _ in range(2):
        messages = text_messages(spark, path, **BOUNDED)
        try:
            ingest.run_all([start_joint_ingest(messages, lake, trigger=DRAIN, write=write)])
        except StreamingQueryException as error:
            if "between the two writes" not in str(error):
                raise
    return _day_sums(spark, lake, ["playerlogs", "invalid_data"])


@query
def stream_recovery(spark, sf_dir):
    """Two file sinks after a failure inside their last batch.

    The files of both are written; one has lost the commit of its query, the other also
    the entry of its sink's log, and both are started again.
    """
    lake, path = new_lake(spark), _landed_files(spark, sf_dir)

    def drain():
        ingest.run_all(ingest.start_table_ingest(text_messages(spark, path, **BOUNDED), lake, trigger=DRAIN))

    drain()
    last = LANDED_FILES // BATCH_FILES - 1
    for table in ("playerlogs", "invalid_data"):
        delete(spark, f"{lake.checkpoint(table)}/commits/{last}")
    delete(spark, f"{lake.path('invalid_data')}/_spark_metadata/{last}")
    drain()
    for table in ("playerlogs", "invalid_data"):
        spark.catalog.refreshTable(lake.name(table))
    return _day_sums(spark, lake, ["playerlogs", "invalid_data"])


def _day_sums(spark, lake, tables):
    """Per table and day: the rows, the sum of each number, the filled places of each other column."""
    result = None
    for table in tables:
        rows = spark.table(lake.name(table)).drop(BATCH)
        numbers = {"int", "bigint", "double"}
        measures = {"rows": F.count("*").cast("double")}
        for name, kind in rows.dtypes:
            if name != DAY:
                column = F.col(f"`{name}`")
                total = F.sum(column.cast("double")) if kind in numbers else F.count(column)
                measures[name] = F.coalesce(total.cast("double"), F.lit(0.0))
        sums = rows.groupBy(DAY).agg(*(value.alias(name) for name, value in measures.items()))
        sums = sums.unpivot([DAY], [f"`{name}`" for name in measures], "measure", "value")
        sums = sums.select(
            F.lit(table).alias("table_name"), DAY, F.trim("measure", F.lit("`")).alias("measure"), F.round("value", 2).alias("value")
        )
        result = sums if result is None else result.unionByName(sums)
    return result


# Jobs


@query
def job_bronze_ingest(spark, sf_dir):
    """The scored ingest; the prediction itself is checked by ml_score_stream."""
    lake = _ingested(spark, sf_dir, model=fitted_model(spark, sf_dir))
    return plain(spark.table(lake.name("playerlogs")).drop(PREDICTION))


@query
def job_silver_analysis(spark, sf_dir):
    lake = new_lake(spark, playerlogs=bronze_table(spark, sf_dir))
    jobs.silver_analysis(spark, lake, *day_range(spark, sf_dir))
    return plain(spark.table(lake.name("analysis_playerlogs")))


@query
def job_silver_train_indexed(spark, sf_dir):
    lake = new_lake(spark, playerlogs=bronze_table(spark, sf_dir))
    jobs.silver_train_indexed(spark, lake, *day_range(spark, sf_dir))
    return plain(spark.table(lake.name("train_playerlogs")))


@query
def job_silver_train_movement(spark, sf_dir):
    lake = new_lake(spark, playerlogs=bronze_table(spark, sf_dir))
    jobs.silver_train_movement(spark, lake, *day_range(spark, sf_dir))
    return plain(spark.table(lake.name("delta_playerlogs")))


@query
def job_gold_day(spark, sf_dir):
    """All gold tables in one frame, columns a table lacks being NULL."""
    lake = new_lake(spark, analysis_playerlogs=silver_table(spark, sf_dir))
    jobs.gold_days(spark, lake, *day_range(spark, sf_dir))
    result = None
    for name in GOLD_TABLES:
        rows = spark.table(lake.name(name)).withColumn("table_name", F.lit(name))
        result = rows if result is None else result.unionByName(rows, allowMissingColumns=True)
    return rounded(result, "average_deaths", "average_game_time", "stddev_x", "stddev_y")


@query
def job_refit(spark, sf_dir):
    """The stored model of a refit on two groups far apart: sizes and silhouette."""
    lake = new_lake(spark)
    name, path = lake.name("delta_playerlogs"), lake.path("delta_playerlogs")
    replace_table(separated(spark, sf_dir), name, path)
    _, score = jobs.refit(spark, lake, *day_range(spark, sf_dir))
    model = load_model(lake.model_path)
    sizes = predict(model, spark.table(name)).groupBy(_by_centre(model).alias("cluster"))
    return rounded(
        sizes.agg(F.count("*").alias("rows")).withColumn("silhouette", F.lit(score)), "silhouette"
    )


@query
def job_month_archive(spark, sf_dir):
    return plain(spark.read.parquet(_archived(spark, sf_dir)))


@query
def job_run_day(spark, sf_dir):
    """All daily jobs over all days, and over one day: what every table adds up to."""
    tables = ["analysis_playerlogs", "train_playerlogs", "delta_playerlogs", *GOLD_TABLES]
    day = one_day(spark, sf_dir)
    result = None
    for run, days in (("range", day_range(spark, sf_dir)), ("day", (day,))):
        lake = new_lake(spark, playerlogs=bronze_table(spark, sf_dir))
        jobs.run_days(spark, lake, *days)
        sums = _day_sums(spark, lake, tables).withColumn("run", F.lit(run))
        result = sums if result is None else result.unionByName(sums)
    return result


@query_named("message_rate")
def message_rate_per_minute(spark, sf_dir):
    return plain(message_rate(read_table(spark, sf_dir, "events"), "ts"))


@query
def message_rate_per_second(spark, sf_dir):
    return plain(message_rate(read_table(spark, sf_dir, "events"), "ts", "1 second"))


#: Parts in which events arrive, and the days of one part.
ARRIVALS, ARRIVAL_DAYS = 4, 8


@query
def message_rate_stream(spark, sf_dir):
    """Closed windows of a stream with a watermark, in several runs from one checkpoint.

    A twentieth of the events arrives two parts later, when most of their windows are closed.
    """
    path = scratch_path(spark, "rate")
    events = read_table(spark, sf_dir, "events").select("event_id", "ts")
    day = F.datediff(F.col("ts").cast("date"), F.lit(day_range(spark, sf_dir)[0]))
    late = F.when(F.col("event_id") % 20 == 7, 2).otherwise(0)
    arrival = F.least(F.floor(day / ARRIVAL_DAYS) + late, F.lit(ARRIVALS - 1))
    for number in range(ARRIVALS):
        events.filter(arrival == number).write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(events.schema).parquet(f"{path}/in")
        rows = message_rate(stream, "ts", late="10 minutes")
        writer = ingest.append_stream(rows, f"{path}/checkpoint", "rates", partition=None, trigger=DRAIN)
        ingest.run_all([ingest.to_files(writer, f"{path}/out")])
    return plain(spark.read.parquet(f"{path}/out"))

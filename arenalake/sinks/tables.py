"""Writers of day-partitioned catalog tables.

A replaced day is written to a new folder, ``<table>/version-.../<day>``, and becomes
visible when the catalog is told the day's new place, in one step. A reader sees
the old or the new rows of a day, never a mix, and what it began to read stays where it is
until ``drop_superseded`` removes folders that no day lies in any more.
"""

from datetime import UTC, date, datetime, timedelta
from pathlib import PurePosixPath
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arenalake.schema import DAY
from arenalake.sinks.files import delete, exists, folder_names, make_folder, move
from arenalake.sources.tables import as_date, written_by_stream

#: Replacing days is a property of the table, so no session can replace more by mistake.
DYNAMIC = "partitionOverwriteMode"
VERSION = "version-"
#: In a version's folder: all its days are in their places; days it took the rows of.
SWAPPED, EMPTIED = "_swapped", "_emptied"
#: The column of a stream's batch, where one query writes several tables.
BATCH = "batch"
#: How a day folder of rows without a day is named.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"
#: How long a superseded folder stays for readers that began before.
GRACE = timedelta(days=1)


def create_table(rows: DataFrame, table: str, path: str, fmt: str = "parquet") -> None:
    """A table at ``path`` with the rows' columns, the day last.

    Day folders that are there already become partitions of the new table, each day by its last
    version. A table that exists gets the dynamic mode, if it was created without.
    """
    spark = rows.sparkSession
    if spark.catalog.tableExists(table):
        if not _is_dynamic(spark, table):
            spark.sql(f"ALTER TABLE {table} SET SERDEPROPERTIES ('{DYNAMIC}'='dynamic')")
        return
    columns = ", ".join(
        f"`{field.name}` {field.dataType.simpleString()}" for field in rows.schema.fields
    )
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING {fmt} "
        f"OPTIONS ('{DYNAMIC}'='dynamic') PARTITIONED BY ({DAY}) LOCATION '{path}'"
    )
    _set_places(spark, table, _found_places(spark, path))


def _described(spark: SparkSession, table: str, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where(F.col("col_name") == name)
    return next((row.data_type for row in rows.collect()), "")


def _is_dynamic(spark: SparkSession, table: str) -> bool:
    return f"{DYNAMIC}=dynamic".lower() in _described(spark, table, "Storage Properties").lower()


def replace_days(
    rows: DataFrame,
    table: str,
    path: str,
    fmt: str = "parquet",
    rebalance: bool = False,
    days: tuple[date | str, date | str] | None = None,
) -> None:
    """Replace the days that occur in ``rows``; other days stay.

    Each day changes in one step, see above; if the job ends before, no row has changed or, between
    two days, some days are new and the others old, and the run can be repeated. ``days``, the first and the last
    day of a run, are emptied as well if no row of them came. ``rebalance`` groups the
    rows by day before writing, if they are not grouped yet: adaptive execution then writes a
    few files of even size per day, splitting large days.
    """
    if rebalance:
        rows = rows.hint("rebalance", DAY)
    if fmt == "delta":
        (
            rows.write.format(fmt)
            .mode("overwrite")
            .option(DYNAMIC, "dynamic")
            .option("path", path)
            .partitionBy(DAY)
            .saveAsTable(table)
        )
        return
    spark = rows.sparkSession
    _check_batch_table(spark, path)
    create_table(rows, table, path, fmt)
    ordered = _in_table_order(rows, table)
    place = (_described(spark, table, "Location") or path).rstrip("/")
    version = f"{place}/{VERSION}{datetime.now(UTC):%Y%m%dT%H%M%S%f}-{uuid4().hex[:8]}"
    ordered.write.format(fmt).partitionBy(DAY).save(version)
    written = [x for x in folder_names(spark, version) if x.startswith(f"{DAY}=")]
    emptied = [x for x in _each(days) if x not in written]
    for folder in emptied:
        make_folder(spark, f"{version}/{EMPTIED}/{folder}")
    _set_places(spark, table, {x: f"{version}/{x}" for x in written}, emptied)
    make_folder(spark, f"{version}/{SWAPPED}")


def _each(days: tuple[date | str, date | str] | None) -> list[str]:
    """Folder names of the first to the last day."""
    if days is None:
        return []
    first, last = as_date(days[0]), as_date(days[1])
    return [f"{DAY}={first + timedelta(k)}" for k in range((last - first).days + 1)]


def _spec(folder: str) -> str:
    """A partition's name, such as ``create_room_date=2024-01-05/batch=3``, in SQL."""
    values = []
    for part in folder.split("/"):
        name, _, value = part.partition("=")
        if name == DAY:
            value = "null" if value == NO_DAY else f"DATE'{value}'"
        values.append(f"{name}={value}")
    return f"PARTITION ({', '.join(values)})"


def _set_places(
    spark: SparkSession, table: str, places: dict[str, str], emptied: list[str] | None = None, among: str = ""
) -> None:
    """Tell the catalog where partitions lie; it is asked once which ones it has (``among`` a part of them)."""
    known = {row.partition for row in spark.sql(f"SHOW PARTITIONS {table} {among}").collect()}
    new = [f"{_spec(x)} LOCATION '{place}'" for x, place in places.items() if x not in known]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD {' '.join(new)}")
    for folder, place in places.items():
        if folder in known:
            spark.sql(f"ALTER TABLE {table} {_spec(folder)} SET LOCATION '{place}'")
    emptied = known - set(places) if among else emptied or []
    if gone := [_spec(x) for x in emptied if x in known]:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(gone)}")


def _found_places(spark: SparkSession, path: str) -> dict[str, str]:
    """Where the days of a folder lie: as written without versions, or in the last version that has them."""
    names = folder_names(spark, path)
    places = {x: f"{path}/{x}" for x in names if x.startswith(f"{DAY}=")}
    for version in sorted(x for x in names if x.startswith(VERSION)):
        folders = folder_names(spark, f"{path}/{version}")
        if SWAPPED in folders:
            places |= {x: f"{path}/{version}/{x}" for x in folders if x.startswith(f"{DAY}=")}
            for folder in folder_names(spark, f"{path}/{version}/{EMPTIED}"):
                places.pop(folder, None)
    return places


def drop_superseded(spark: SparkSession, table: str, grace: timedelta = GRACE) -> int:
    """Delete versions of days that the table no longer reads, ``grace`` after they were written; returns their number."""
    place = _described(spark, table, "Location").rstrip("/")
    spark.catalog.refreshTable(table)
    read = {PurePosixPath(file).parent.parts[-2:] for file in spark.table(table).inputFiles()}
    last = f"{VERSION}{datetime.now(UTC) - grace:%Y%m%dT%H%M%S%f}"
    dropped = 0
    for version in folder_names(spark, place):
        if not version.startswith(VERSION) or version > last:
            continue
        days = [x for x in folder_names(spark, f"{place}/{version}") if x.startswith(f"{DAY}=")]
        for folder in days:
            if (version, folder) not in read:
                delete(spark, f"{place}/{version}/{folder}")
                dropped += 1
    return dropped


def replace_batch(rows: DataFrame, table: str, path: str, number: int, fmt: str = "parquet") -> None:
    """Make ``rows`` the rows of batch ``number``, whatever an earlier try of it has left.

    The table is partitioned by day and batch. The rows are written to a new folder first and become
    visible when the catalog is told; a try that ends before leaves files no reader
    looks at, and the next one takes its place.
    """
    spark = rows.sparkSession
    _check_batch_table(spark, path)
    if not spark.catalog.tableExists(table):
        columns = ", ".join(f"`{x.name}` {x.dataType.simpleString()}" for x in rows.schema.fields)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({columns}, {BATCH} BIGINT) USING {fmt} "
            f"PARTITIONED BY ({DAY}, {BATCH}) LOCATION '{path}'"
        )
    names = [x for x in spark.table(table).columns if x != BATCH]
    if differing := sorted(set(names) ^ set(rows.columns)):
        raise ValueError(f"{table} and the rows to write differ in the columns {differing}")
    version = f"{path.rstrip('/')}/{VERSION}{datetime.now(UTC):%Y%m%dT%H%M%S%f}-{uuid4().hex[:8]}"
    rows.select(*[f"`{name}`" for name in names]).write.format(fmt).partitionBy(DAY).save(version)
    days = [x for x in folder_names(spark, version) if x.startswith(f"{DAY}=")]
    places = {f"{x}/{BATCH}={number}": f"{version}/{x}" for x in days}
    _set_places(spark, table, places, among=f"PARTITION ({BATCH}={number})")


def append_days(rows: DataFrame, table: str, path: str, fmt: str = "parquet") -> None:
    """Append, a few files of even size per day."""
    _check_batch_table(rows.sparkSession, path)
    create_table(rows, table, path, fmt)
    _in_table_order(rows, table).hint("rebalance", DAY).write.insertInto(table)


def _check_batch_table(spark: SparkSession, path: str) -> None:
    """Refuse a folder a stream writes to.

    Readers of such a folder go by the stream's log and would not see files of a
    batch, without any error.
    """
    if written_by_stream(spark, path):
        raise ValueError(f"{path} belongs to a stream; write batches to another table")


def _in_table_order(rows: DataFrame, table: str) -> DataFrame:
    """insertInto goes by position. Rows of other columns than the table's are an error."""
    names = rows.sparkSession.table(table).columns
    if differing := sorted(set(names) ^ set(rows.columns)):
        raise ValueError(f"{table} and the rows to write differ in the columns {differing}")
    return rows.select(*[f"`{name}`" for name in names])


def replace_table(rows: DataFrame, table: str, path: str, fmt: str = "parquet") -> None:
    """Replace the whole table."""
    (
        rows.write.format(fmt)
        .mode("overwrite")
        .option(DYNAMIC, "static")
        .option("path", path)
        .partitionBy(DAY)
        .saveAsTable(table)
    )


def month_to_parquet(rows: DataFrame, path: str) -> int:
    """One month as one folder of zstd Parquet files; returns the number of rows.

    Adaptive execution makes few files of even size out of many small ones. The
    folder is written beside the old one, and takes its place only if it has as many
    rows as the source. A run that ended between the two moves is finished by the next one, or by
    ``finish_archive``: the new folder is whole when the old one has moved.
    """
    spark = rows.sparkSession
    finish_archive(spark, path)
    new, old = (f"{path}.{word}-{uuid4().hex}" for word in ("new", "old"))
    rows.hint("rebalance").write.option("compression", "zstd").parquet(new)
    expected, written = rows.count(), spark.read.parquet(new).count()
    if written != expected:
        delete(spark, new)
        raise ValueError(f"{path}: {written} rows were written of {expected}; nothing is replaced")
    # From here on the new folder is known to be whole.
    checked = new.replace(".new-", ".checked-")
    move(spark, new, checked)
    replaced = move(spark, path, old)
    move(spark, checked, path)
    if replaced:
        delete(spark, old)
    return written


def finish_archive(spark: SparkSession, path: str) -> bool:
    """Put the archive in its place if a run ended before; whether there was one to put."""
    root, name = path.rsplit("/", 1)
    left = sorted(x for x in folder_names(spark, root) if x.startswith(f"{name}.checked-"))
    missing = not exists(spark, path)
    if missing and left:
        move(spark, f"{root}/{left[-1]}", path)
    for folder in folder_names(spark, root):
        if folder.startswith((f"{name}.old-", f"{name}.checked-")):
            delete(spark, f"{root}/{folder}")
    return bool(missing and left)

"""Command line of the jobs.

    spark-submit arenalake/__main__.py --root s3a://lake gold 2024-01-05
"""

import argparse
import sys
from datetime import timedelta
from pathlib import Path

if __package__ in (None, ""):
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import SparkSession

from arenalake.lake import TABLES, Lake
from arenalake.plans import jobs
from arenalake.sinks.models import load_model
from arenalake.sinks.tables import drop_superseded
from arenalake.sources.messages import kafka_messages
from arenalake.streaming import ingest
from arenalake.streaming.joint import start_joint_ingest
from arenalake.streaming.rate import start_rate_stream

DAY_JOBS = {
    "silver-analysis": jobs.silver_analysis,
    "silver-train": jobs.silver_train_indexed,
    "silver-movement": jobs.silver_train_movement,
    "gold": jobs.gold_days,
    "run-day": jobs.run_days,
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="arenalake")
    top.add_argument("--root", required=True, help="folder of the tables")
    top.add_argument("--suffix", default="", help="added to every database name")
    top.add_argument("--format", default="parquet", help="table format")
    job = top.add_subparsers(dest="job", required=True)

    stream = job.add_parser("ingest", help="Kafka topic to the bronze tables")
    stream.add_argument("servers")
    stream.add_argument("topic")
    stream.add_argument("--model", help="stored pipeline to score with")
    stream.add_argument(
        "--option", action="append", default=[], metavar="KEY=VALUE", help="Kafka source option"
    )
    stream.add_argument("--every", default="1 minute", help="time between micro-batches")
    stream.add_argument("--json", action="store_true", help="write JSON files, no tables")
    stream.add_argument("--joint", action="store_true", help="one query for both tables, from one read")
    stream.add_argument("--follow", action="store_true", help="with --joint, score with the last published model")
    stream.add_argument("--salt", help="added to the account before it is hashed")
    stream.add_argument("--legacy-int", action="store_true", help="truncate fractional numbers")
    stream.add_argument("--clear", action="store_true", help="keep refused messages as they came")
    stream.add_argument("--keep-text", action="store_true", help="with --clear, keep their text")
    stream.add_argument(
        "--strict-day", action="store_true", help="refuse messages with a malformed room date"
    )

    rate = job.add_parser("message-rate", help="messages per time window, as a stream")
    rate.add_argument("servers")
    rate.add_argument("topic")
    rate.add_argument("--width", default="1 minute")
    rate.add_argument("--late", default="10 minutes")
    rate.add_argument("--every", default="1 minute", help="time between micro-batches")

    for name in DAY_JOBS:
        day = job.add_parser(name)
        day.add_argument("first", help="yyyy-mm-dd")
        day.add_argument("last", nargs="?", help="last day of a range")
        if name in ("silver-analysis", "run-day"):
            day.add_argument(
                "--keep", choices=["any", "all"], default="any",
                help="drop rows without any identity, or rows with any gap",
            )
        if name in ("silver-train", "run-day"):
            day.add_argument(
                "--null", choices=["error", "skip", "keep"], dest="handle_null",
                default="skip" if name == "run-day" else "error",
                help="what to do with rows that have no champion or key",
            )
            day.add_argument(
                "--event-day", action="store_true", help="partition by the day of the event"
            )
        if name in ("silver-movement", "run-day"):
            day.add_argument(
                "--per-room", action="store_true", help="start anew in each room"
            )
        if name == "run-day":
            day.add_argument("--refit-from", help="first day a monthly refit reads")

    refit = job.add_parser("refit")
    refit.add_argument("first", nargs="?")
    refit.add_argument("last", nargs="?")

    refit.add_argument("--publish", action="store_true", help="make it the version that streams follow")

    drop = job.add_parser("drop-superseded", help="delete replaced versions of days")
    drop.add_argument("--hours", type=float, default=24, help="age from which they are deleted")

    archive = job.add_parser("archive", help="the month of a day to Parquet")
    archive.add_argument("day")
    archive.add_argument("--base", help="folder of the JSON day folders")
    return top


def run(spark: SparkSession, arguments: list[str]) -> None:
    args = parser().parse_args(arguments)
    lake = Lake(args.root, args.suffix, args.format)
    if args.job == "ingest":
        start = ingest.start_json_ingest if args.json else ingest.start_table_ingest
        model = load_model(args.model) if args.model else None
        option = dict(option.split("=", 1) for option in args.option)
        messages = kafka_messages(spark, args.servers, args.topic, **option)
        names = ("salt", "legacy_int", "clear", "keep_text", "strict_day")
        options = {name: getattr(args, name) for name in names}
        every = {"processingTime": args.every}
        if args.joint:
            models = lake.models_path if args.follow else None
            ingest.run_all([start_joint_ingest(messages, lake, models, every, **options)])
        else:
            ingest.run_all(start(messages, lake, model, every, **options))
    elif args.job == "message-rate":
        messages = kafka_messages(spark, args.servers, args.topic)
        every = {"processingTime": args.every}
        ingest.run_all([start_rate_stream(messages, lake, "timestamp", args.width, args.late, every)])
    elif args.job == "refit":
        _, score = jobs.refit(spark, lake, args.first, args.last, args.publish)
        print(f"silhouette: {score}")
    elif args.job == "drop-superseded":
        for table in filter(spark.catalog.tableExists, map(lake.name, TABLES)):
            print(f"{table}: {drop_superseded(spark, table, timedelta(hours=args.hours))}")
    elif args.job == "archive":
        print(jobs.archive_month(spark, lake, args.day, args.base))
    else:
        lake.create_databases(spark)
        names = ("keep", "handle_null", "event_day", "per_room", "refit_from")
        options = {name: getattr(args, name) for name in names if hasattr(args, name)}
        report = DAY_JOBS[args.job](spark, lake, args.first, args.last, **options)
        if isinstance(report, jobs.RunReport):
            print(f"skipped rows: {report.skipped}")
            if report.silhouette is not None:
                print(f"silhouette: {report.silhouette}")


if __name__ == "__main__":
    parser().parse_args()  # usage errors come before a session is started
    session = SparkSession.builder.appName("arenalake").enableHiveSupport().getOrCreate()
    run(session, sys.argv[1:])
    session.stop()

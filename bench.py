"""Time the headline queries; print one JSON line.

    BENCH_SF_DIR   folder of the parquet tables (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores (default 8)
"""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from arenalake.lake import GOLD_TABLES  # noqa: E402
from arenalake.operators.bronze import bronze_rows, parse_messages, quarantine_rows  # noqa: E402
from arenalake.operators.cluster import fit_clusters, silhouette  # noqa: E402
from arenalake.operators.gold import gold_from_events  # noqa: E402
from arenalake.operators.silver import (  # noqa: E402
    analysis_rows,
    files_by_room_time,
    movement_rows,
    train_indexed_rows,
)
from arenalake.plans import jobs  # noqa: E402
from arenalake.registry import prepared  # noqa: E402
from arenalake.registry.queries import DRAIN  # noqa: E402
from arenalake.schema import DAY  # noqa: E402
from arenalake.session import local_session  # noqa: E402
from arenalake.sources.messages import text_messages  # noqa: E402
from arenalake.sources.playerlogs import read_table  # noqa: E402
from arenalake.streaming import ingest  # noqa: E402
from arenalake.streaming.rate import message_rate  # noqa: E402

REPEATS = 3


def consume(rows):
    rows.write.format("noop").mode("overwrite").save()


def workloads(spark, sf_dir):
    """name -> action, over stored tables as the jobs read them."""
    landed = prepared.landed_messages(spark, sf_dir)
    bronze_name = prepared.bronze_table(spark, sf_dir)
    silver_name = prepared.silver_table(spark, sf_dir)
    first, last = prepared.day_range(spark, sf_dir)

    def bronze():
        return spark.table(bronze_name)

    def silver():
        return spark.table(silver_name)

    def job_lake():
        return prepared.new_lake(spark, playerlogs=bronze_name, analysis_playerlogs=silver_name)

    def stream():
        lake = prepared.new_lake(spark)
        ingest.run_all(ingest.start_table_ingest(text_messages(spark, landed), lake, None, DRAIN))

    def archive():
        jobs.archive_month(spark, prepared.new_lake(spark, playerlogs=bronze_name), first)

    def run_day():
        lake = prepared.new_lake(spark, playerlogs=bronze_name)
        jobs.run_days(spark, lake, prepared.one_day(spark, sf_dir))

    def hot_account():
        """A third of all rows belongs to one account, on one day; it goes through slices."""
        hot = F.pmod(F.xxhash64("room_id", "datetime", "x", "y"), F.lit(3)) == 0
        rows = bronze().withColumns(
            {
                "encrypted_account": F.when(hot, F.lit("hot")).otherwise(F.col("encrypted_account")),
                DAY: F.when(hot, F.lit(first)).otherwise(F.col(DAY)),
            }
        )
        consume(movement_rows(rows, hot_rows=10_000, slice_rows=10_000))

    def refit():
        silhouette(fit_clusters(bronze()), bronze())

    work = {
        "parse_valid": lambda: consume(bronze_rows(parse_messages(spark.read.text(landed)))),
        "parse_invalid": lambda: consume(quarantine_rows(parse_messages(spark.read.text(landed)))),
        "silver_analysis": lambda: consume(files_by_room_time(analysis_rows(bronze()))),
        "train_table_indexed": lambda: consume(train_indexed_rows(bronze())),
        "movement_features": lambda: consume(movement_rows(bronze())),
        "message_rate": lambda: consume(message_rate(read_table(spark, sf_dir, "events"), "ts")),
        "kmeans_refit": refit,
        "stream_ingest": stream,
        "job_gold_day": lambda: jobs.gold_days(spark, job_lake(), first, last),
        "job_silver_movement": lambda: jobs.silver_train_movement(spark, job_lake(), first, last),
        "movement_hot_account": hot_account,
        "job_month_archive": archive,
        "job_run_day": run_day,
    }
    for name in GOLD_TABLES:
        work[f"gold_{name}"] = lambda name=name: consume(gold_from_events(silver(), name))
    return work


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"))
    prepared.shared_scratch(spark)
    messages = read_table(spark, sf_dir, "events").count()
    seconds, first_run = {}, {}
    for name, action in workloads(spark, sf_dir).items():
        times = []
        for _ in range(REPEATS + 1):
            start = time.perf_counter()
            action()
            times.append(time.perf_counter() - start)
        first_run[name] = round(times[0], 4)
        seconds[name] = round(sorted(times[1:])[REPEATS // 2], 4)
    result = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 4),
        "unit": "sec",
        "queries": seconds,
        "first_run": first_run,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "messages": messages,
        "messages_per_minute": {
            name: round(60 * messages / seconds[name]) for name in ("parse_valid", "stream_ingest")
        },
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()

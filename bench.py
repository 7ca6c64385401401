"""Times the registered queries and prints one JSON line.

BENCH_SF_DIR  tables to read (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default: all)

Raw input (log files, CSV) is written first and timed on its own. Every query then runs twice, whole, into
a sink that discards rows, and the median (the mean of the two) counts; queries that write or stream do so within their
time. The total is that of the medians and of writing the input.
"""

from __future__ import annotations

import json
import os
import sys
import time
from statistics import median

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from basketflow.catalogue import inputs  # noqa: E402
from basketflow.catalogue.queries import QUERIES  # noqa: E402
from basketflow.sources import read_fact  # noqa: E402
from basketflow.streaming import start_ingest  # noqa: E402
from basketflow.workspace import new_folder  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
LATENCY_DIR = os.environ.get("BENCH_LATENCY_DIR", "/root/testdata/sf0.001")
STAGES = {
    "stage_logs": inputs.log_folder,
    "stage_broken_logs": inputs.broken_log_folder,
    "stage_flawed_logs": inputs.flawed_log_folder,
    "stage_redelivered_logs": inputs.redelivered_log_folder,
    "stage_csv": inputs.csv_file,
    "stage_broken_csv": inputs.broken_csv_folder,
    "stage_reused_ids": inputs.reused_id_folder,
    "stage_skus_csv": inputs.skus_csv,
    "stage_supermarkets_csv": inputs.supermarkets_csv,
}
RATED = ["shred_details", "end_to_end_sales", "stream_shred_details", "stream_dedupe", "scan_details"]


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("basketflow-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def run(spark: SparkSession, sf_dir: str, names: list[str]) -> dict[str, float]:
    return {
        name: seconds(lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save())
        for name in names
    }


def arrival_to_visible(spark: SparkSession, files: int = 5) -> list[float]:
    """Seconds from a log file's landing to its rows being read from the tables, per file."""
    root = new_folder(spark, "latency")
    incoming, facts = f"{root}/incoming", f"{root}/facts"
    deliveries = spark.read.text(inputs.log_folder(spark, LATENCY_DIR)).repartition(files + 1)
    parts = f"{root}/parts"
    deliveries.write.text(parts)
    names = sorted(name for name in os.listdir(parts) if name.endswith(".txt"))
    os.makedirs(incoming)
    query = start_ingest(
        spark, incoming, facts, f"{root}/progress", state_partitions=int(CPUS), trigger={"processingTime": "0 seconds"}
    )
    times, seen = [], 0
    for name in names:
        start = time.perf_counter()
        os.rename(os.path.join(parts, name), os.path.join(incoming, name))
        while (now := read_fact(spark, facts, "headers").count()) == seen:
            time.sleep(0.02)
        seen = now
        times.append(round(time.perf_counter() - start, 3))
    query.stop()
    return times[1:]  # the first file waits for the query to start


def main() -> None:
    spark = session()
    names = sys.argv[1:] or list(QUERIES)
    staging = {name: seconds(lambda: stage(spark, SF_DIR)) for name, stage in STAGES.items()}
    first = run(spark, SF_DIR, names)
    latency = [] if sys.argv[1:] or not os.path.isdir(LATENCY_DIR) else arrival_to_visible(spark)
    runs = [first, run(spark, SF_DIR, names)]
    timed = {name: median(times[name] for times in runs) for name in names}
    transactions = inputs.table(spark, SF_DIR, "orders").count()
    result = {
        "metric": "total seconds over all pipeline queries and the writing of their input",
        "value": round(sum(timed.values()) + sum(staging.values()), 3),
        "unit": "sec",
        "queries": timed,
        "sf": os.path.basename(SF_DIR.rstrip("/")),
        "staging": staging,
        "transactions_per_second": {
            name: round(transactions / timed[name]) for name in RATED if name in timed
        },
        "cpus": int(CPUS),
    }
    if latency:
        result["arrival_to_visible_seconds"] = latency
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()

"""Command line of the pipeline: ``spark-submit -m basketflow.jobs <job> ...``.

historical  load a CSV export, replacing earlier historical rows
live        load log files as they land, or what is there if no interval is given
live-sales  keep units by store and SKU up to date while log files land
checks      show what the batches of a load held, as counted while they were written
orphans     count items without a header, reading only what is new since the last run
live-report show units, sales and best-selling SKUs of the live-sales report at current prices
merge       merge the folders of a stream's committed batches
arrange     lay the rows of one load out by day, week or month
sales       write the sales-by-store report
top-skus    write the best-selling SKUs
"""

from __future__ import annotations

import argparse

from basketflow.operators.decode import decode_csv_rows
from basketflow.plans.reports import in_dates, once, sales_by_store, top_skus_by_sales, top_skus_by_units
from basketflow.session import job_session
from basketflow.sinks import overwrite_historical
from basketflow.sinks.merge import arrange_load, merge_batches
from basketflow.sinks.orphans import audit_new_loads
from basketflow.sources import read_fact, read_skus, read_supermarkets, read_transactions_csv
from basketflow.streaming import read_live_sales, read_live_top_skus, start_ingest, start_live_sales
from basketflow.streaming.archive import close_archive
from basketflow.streaming.checks import read_checks


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="basketflow")
    jobs = parser.add_subparsers(dest="job", required=True)

    historical = jobs.add_parser("historical")
    historical.add_argument("--csv", required=True)
    historical.add_argument("--facts", required=True)
    historical.add_argument("--multi-line", action="store_true", help="fields may hold line breaks")

    live = jobs.add_parser("live")
    live.add_argument("--input", required=True)
    live.add_argument("--facts", required=True)
    live.add_argument("--checkpoint", required=True)
    live.add_argument("--every", help="interval such as '10 seconds'; default: load what is there and stop")
    live.add_argument("--horizon", default="1 hour", help="drop copies within this time; 'none' keeps all")
    live.add_argument("--lanes", type=int, default=8)
    live.add_argument("--max-files", type=int)
    live.add_argument("--max-bytes", type=int)
    live.add_argument("--archive")
    live.add_argument("--archive-threads", type=int, default=1)
    live.add_argument("--files", type=int, help="at most so many files for each table and batch")
    live.add_argument("--state-partitions", type=int, help="tasks that keep the keys; fixed at the first start")
    live.add_argument("--checks", action="store_true", help="count faults of each batch while it is written")
    live.add_argument("--set-aside-broken", action="store_true", help="refuse compressed files that cannot be unpacked")
    live.add_argument("--check-stored", action="store_true", help="also drop copies of what earlier loads stored")

    merge = jobs.add_parser("merge")
    merge.add_argument("--facts", required=True)
    merge.add_argument("--checkpoint", required=True)
    merge.add_argument("--stream", required=True, help="the id in the names of the stream's folders")
    merge.add_argument("--period", choices=["day", "week", "month"], help="lay rows out in a folder for each")

    arrange = jobs.add_parser("arrange")
    arrange.add_argument("--facts", required=True)
    arrange.add_argument("--origin", default="historical")
    arrange.add_argument("--load", default="batch")
    arrange.add_argument("--period", choices=["day", "week", "month"], default="day")

    checks = jobs.add_parser("checks")
    checks.add_argument("--facts", required=True)

    orphans = jobs.add_parser("orphans")
    orphans.add_argument("--facts", required=True)
    orphans.add_argument("--state", required=True, help="folder that carries open items from run to run")

    live_report = jobs.add_parser("live-report")
    live_report.add_argument("--report", required=True)
    live_report.add_argument("--skus", required=True)
    live_report.add_argument("-k", type=int, default=10)
    live_report.add_argument("--out", help="folder for the two tables; default: print them")

    live_sales = jobs.add_parser("live-sales")
    live_sales.add_argument("--input", required=True)
    live_sales.add_argument("--report", required=True)
    live_sales.add_argument("--checkpoint", required=True)
    live_sales.add_argument("--every")
    live_sales.add_argument("--horizon", default="1 hour")
    live_sales.add_argument("--lanes", type=int, default=8)
    live_sales.add_argument("--state-partitions", type=int)

    top = jobs.add_parser("top-skus")
    top.add_argument("--facts", required=True)
    top.add_argument("--skus", required=True)
    top.add_argument("--by", choices=["units", "sales"], default="units")
    top.add_argument("--since")
    top.add_argument("--until")
    top.add_argument("-k", type=int, default=10)
    top.add_argument("--out", required=True)

    sales = jobs.add_parser("sales")
    sales.add_argument("--facts", required=True)
    sales.add_argument("--skus", required=True)
    sales.add_argument("--supermarkets", required=True)
    sales.add_argument("--since")
    sales.add_argument("--until")
    sales.add_argument("--out", required=True)
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    spark = job_session(f"basketflow-{args.job}")
    if args.job == "historical":
        written = overwrite_historical(decode_csv_rows(read_transactions_csv(spark, args.csv, multi_line=args.multi_line)), args.facts)
        print(written)
    elif args.job == "live":
        start_ingest(
            spark,
            args.input,
            args.facts,
            args.checkpoint,
            horizon=None if args.horizon == "none" else args.horizon,
            lanes=args.lanes,
            files=args.files,
            state_partitions=args.state_partitions,
            archive_threads=args.archive_threads,
            check_stored=args.check_stored,
            checks=args.checks,
            set_aside_broken=args.set_aside_broken,
            trigger={"processingTime": args.every} if args.every else None,
            max_files=args.max_files,
            max_bytes=args.max_bytes,
            archive_dir=args.archive,
        ).awaitTermination()
        if args.archive:
            print(close_archive(spark, args.input, args.checkpoint, args.archive), "files moved")
    elif args.job == "merge":
        print(merge_batches(spark, args.facts, args.checkpoint, args.stream, period=args.period))
    elif args.job == "arrange":
        print(arrange_load(spark, args.facts, args.origin, args.load, period=args.period))
    elif args.job == "checks":
        read_checks(spark, args.facts).where("rows > 0").orderBy("stream_id", "batch_id", "rule").show(10_000, truncate=False)
    elif args.job == "orphans":
        print(audit_new_loads(spark, args.facts, args.state).count(), "items without a header")
    elif args.job == "live-report":
        skus = read_skus(spark, args.skus)
        for name, rows in (("stores", read_live_sales(spark, args.report, skus)), ("skus", read_live_top_skus(spark, args.report, skus, args.k))):
            if args.out:
                rows.write.mode("overwrite").parquet(f"{args.out}/{name}")
            else:
                rows.show(1000, truncate=False)
    elif args.job == "live-sales":
        start_live_sales(
            spark,
            args.input,
            args.report,
            args.checkpoint,
            horizon=None if args.horizon == "none" else args.horizon,
            lanes=args.lanes,
            state_partitions=args.state_partitions,
            trigger={"processingTime": args.every} if args.every else None,
        ).awaitTermination()
    elif args.job == "top-skus":
        details = in_dates(read_fact(spark, args.facts, "details", stored=True, since=args.since, until=args.until), args.since, args.until)
        items = once(details, "tx_key", "sku", "quantity")
        best = top_skus_by_units if args.by == "units" else top_skus_by_sales
        best(items, read_skus(spark, args.skus), args.k).write.mode("overwrite").parquet(args.out)
    else:
        sales_by_store(
            read_fact(spark, args.facts, "headers", stored=True, since=args.since, until=args.until),
            read_fact(spark, args.facts, "details", stored=True, since=args.since, until=args.until),
            read_skus(spark, args.skus),
            read_supermarkets(spark, args.supermarkets),
            since=args.since,
            until=args.until,
            on="tx_key",
        ).write.mode("overwrite").parquet(args.out)


if __name__ == "__main__":
    main()

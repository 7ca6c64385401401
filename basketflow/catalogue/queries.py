"""Registered queries. Each reads whole tables below the given folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.catalogue import inputs
from basketflow.files import Files
from basketflow.functions import format_local_time, sku_key, store_key, transaction_key, zone_time
from basketflow.operators import audit
from basketflow.operators.decode import accepted, decode_csv_rows, decode_lines, rejected
from basketflow.operators.dedupe import drop_copies
from basketflow.operators.numbering import assign_transaction_ids
from basketflow.operators.shred import details as shred_details
from basketflow.operators.shred import headers as shred_headers
from basketflow.operators.shred import to_log_line
from basketflow.plans import reports, views
from basketflow.sinks import append_load, fact_rows, generations, overwrite_historical, write_batch
from basketflow.sinks.merge import arrange_load, merge_batches
from basketflow.sinks.orphans import audit_new_loads
from basketflow.sinks.sketches import write_sketch
from basketflow.sinks.stored_copies import drop_stored_copies, settled
from basketflow.sources import read_fact, read_log_lines, read_skus, read_supermarkets, read_transactions_csv
from basketflow.streaming import read_live_sales, read_live_top_skus, start_ingest, start_live_sales
from basketflow.streaming.archive import close_archive
from basketflow.streaming.checks import read_checks
from basketflow.workspace import new_folder, path_exists

# Where the two origins meet, the report's year, and the last day with a header in
# the orphan check.
ORIGIN_SPLIT = "2000-01-01"
REPORT_SINCE, REPORT_UNTIL = "1997-01-01", "1998-01-01"
HEADERS_UNTIL = "2000-01-01"
TOP_K = 10
PREVIEW = 20

Query = Callable[[SparkSession, str], DataFrame]


def _log_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_lines(read_log_lines(spark, inputs.log_folder(spark, sf_dir)))


def _csv_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_csv_rows(read_transactions_csv(spark, inputs.csv_file(spark, sf_dir)))


def _contents(headers: DataFrame, details: DataFrame, rejects: DataFrame | None = None) -> DataFrame:
    """Whole tables as rows of text, so that one query shows them all, each row as often as it is stored."""
    of_headers = headers.select(
        F.lit("headers").alias("stored_in"), "transaction_id",
        F.concat_ws(" ", "supermarket_id", format_local_time(F.col("transaction_date"))).alias("content"),
    )
    of_details = details.select(
        F.lit("details").alias("stored_in"), "transaction_id",
        F.concat_ws(" ", "sku", F.col("quantity").cast("string")).alias("content"),
    )
    rows = of_headers.unionAll(of_details)
    if rejects is None:
        return rows
    count = rejects.agg(F.count("*").cast("string").alias("content"))
    return rows.unionAll(count.select(F.lit("rejects"), F.lit("none"), "content"))


def _stored_contents(spark: SparkSession, folder: str) -> DataFrame:
    return _contents(*[read_fact(spark, folder, name) for name in ("headers", "details", "rejects")])


# --- raw records ---------------------------------------------------------------------------


def headers_from_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shred_headers(_log_records(spark, sf_dir))


def details_from_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shred_details(_log_records(spark, sf_dir))


def filter_valid_tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = accepted(_log_records(spark, sf_dir))
    return kept.select(F.col("tx.transaction_id").alias("transaction_id"))


def quarantine_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read_log_lines(spark, inputs.broken_log_folder(spark, sf_dir))
    return audit.reject_counts(decode_lines(lines))


def bad_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales of the lowest order priority get a date no pattern fits: half a date, half prose."""
    spoilt = F.when(F.col("o_orderkey") % 2 == 0, F.lit("bad")).otherwise(
        F.substring(F.col("o_orderdate").cast("string"), 1, 10)
    )
    date_text = F.when(F.col("o_orderpriority") == "5-LOW", spoilt).otherwise(
        format_local_time(F.col("o_orderdate"))
    )
    tx = F.struct(
        transaction_key(F.col("o_orderkey") + 1).alias("transaction_id"), date_text.alias("transaction_date")
    )
    lines = inputs.table(spark, sf_dir, "orders").select(
        to_log_line(tx).alias("value"),
        F.lit("orders").alias("source_file"),
        F.current_timestamp().alias("arrived_at"),
    )
    return (
        accepted(decode_lines(lines))
        .where(F.array_contains("flags", "bad_date"))
        .select(F.col("tx.transaction_id").alias("transaction_id"), F.col("tx.transaction_date").alias("date_text"))
    )


def flag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept records with something missing: one line for every order, half of them with flaws."""
    lines = read_log_lines(spark, inputs.flawed_log_folder(spark, sf_dir))
    return audit.flag_counts(decode_lines(lines))


def csv_items_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shred_details(_csv_records(spark, sf_dir))


def csv_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shred_headers(_csv_records(spark, sf_dir))


def csv_multi_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of an export whose fields hold line breaks, its files read in splits."""
    return shred_details(decode_csv_rows(read_transactions_csv(spark, inputs.multi_line_csv_folder(spark, sf_dir), multi_line=True)))


def csv_broken_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What becomes of CSV rows broken in the ways an export can be, kept ones without a flag as well."""
    records = decode_csv_rows(read_transactions_csv(spark, inputs.broken_csv_folder(spark, sf_dir)))
    outcome = F.coalesce("reason", F.when(F.size("flags") == 0, F.lit("kept")).otherwise(F.array_join("flags", " ")))
    return records.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("lines"))


# --- dimensions and facts ------------------------------------------------------------------


def dim_skus(spark: SparkSession, sf_dir: str) -> DataFrame:
    skus = read_skus(spark, inputs.skus_csv(spark, sf_dir), inputs.PRICE_PRECISION)
    return skus.withColumn("price", F.col("price").cast("double"))


def dim_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_supermarkets(spark, inputs.supermarkets_csv(spark, sf_dir))


def _historical_facts(spark: SparkSession, sf_dir: str) -> str:
    folder = new_folder(spark, "facts")
    overwrite_historical(_csv_records(spark, sf_dir), folder)
    return folder


def _log_facts(spark: SparkSession, sf_dir: str) -> str:
    """In the log files the records of one order differ in their part, so none is a copy of another."""
    folder = new_folder(spark, "facts")
    append_load(_log_records(spark, sf_dir), folder, "logs")
    return folder


def scan_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    headers = read_fact(spark, _historical_facts(spark, sf_dir), "headers")
    return headers.agg(
        F.count("*").alias("headers"),
        F.min("transaction_date").alias("first_sale"),
        F.max("transaction_date").alias("last_sale"),
    )


def scan_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    details = read_fact(spark, _historical_facts(spark, sf_dir), "details")
    return details.agg(
        F.count("*").alias("details"),
        F.sum("quantity").alias("units"),
        F.min("sku").alias("first_sku"),
        F.max("sku").alias("last_sku"),
    )


def write_overwrite_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "facts")
    for _ in range(2):
        overwrite_historical(_csv_records(spark, sf_dir), folder)
    return read_fact(spark, folder, "details")


def write_append_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads, split at a date, into one table."""
    folder = new_folder(spark, "facts")
    records = _csv_records(spark, sf_dir)
    earlier = F.col("tx.transaction_date") < ORIGIN_SPLIT
    append_load(records.where(earlier), folder, "earlier", origin="historical")
    append_load(records.where(~earlier), folder, "later")
    return read_fact(spark, folder, "headers")


# --- joins, reports ------------------------------------------------------------------------


def join_header_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.header_lines(inputs.headers(spark, sf_dir), inputs.details(spark, sf_dir))


def line_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = reports.line_revenue(inputs.details(spark, sf_dir), inputs.skus(spark, sf_dir))
    return lines.withColumn("price", F.col("price").cast("double")).withColumn(
        "revenue", F.col("revenue").cast("double")
    )


def sales_by_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.sales_by_store(
        inputs.headers(spark, sf_dir),
        inputs.details(spark, sf_dir),
        inputs.skus(spark, sf_dir),
        inputs.supermarkets(spark, sf_dir),
    )


def _facts_by_month(spark: SparkSession, sf_dir: str) -> str:
    """A load laid out in folders of a month."""
    folder = _log_facts(spark, sf_dir)
    arrange_load(spark, folder, "realtime", "logs", period="month")
    return folder


def sales_by_store_dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over stored facts laid out by month: the range cuts both scans to its folders."""
    return _stored_sales(spark, sf_dir, _facts_by_month(spark, sf_dir), since=REPORT_SINCE, until=REPORT_UNTIL)


def sales_on_quarter_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales of the last month of each quarter, over facts laid out by month: the set of months is a table, and only the
    folders in it are read."""
    folder = _facts_by_month(spark, sf_dir)
    months = inputs.table(spark, sf_dir, "orders").select(F.trunc("o_orderdate", "month").alias("day")).distinct()
    months = months.where(F.month("day") % 3 == 0)
    sales = reports.sales_by_day(*[read_fact(spark, folder, name, stored=True, on_days=months) for name in ("headers", "details")])
    return sales.withColumn("day", F.col("day").cast("timestamp_ntz"))


def top_skus_by_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_skus_by_units(inputs.details(spark, sf_dir), inputs.skus(spark, sf_dir), TOP_K)


def top_skus_by_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_skus_by_sales(inputs.details(spark, sf_dir), inputs.skus(spark, sf_dir), TOP_K)


def end_to_end_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw log lines, without copies, to stored facts to the sales report, joined on the record key."""
    folder = new_folder(spark, "facts")
    append_load(drop_copies(_log_records(spark, sf_dir)), folder, "logs")
    return _stored_sales(spark, sf_dir, folder)


def sales_after_redelivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every log line stored twice, in two loads, counts once."""
    folder = new_folder(spark, "facts")
    for load_id in ("first", "again"):
        append_load(_log_records(spark, sf_dir), folder, load_id)
    return _stored_sales(spark, sf_dir, folder)


def _stored_sales(spark: SparkSession, sf_dir: str, folder: str, **dates: str) -> DataFrame:
    return reports.sales_by_store(
        read_fact(spark, folder, "headers", stored=True, **dates),
        read_fact(spark, folder, "details", stored=True, **dates),
        inputs.skus(spark, sf_dir),
        inputs.supermarkets(spark, sf_dir),
        on="tx_key",
        **dates,
    )


# --- audits --------------------------------------------------------------------------------


def orphan_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    headers = inputs.headers(spark, sf_dir, until=HEADERS_UNTIL)
    return audit.without_parent(inputs.details(spark, sf_dir), headers, "transaction_id")


def headers_without_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.headers_without_items(inputs.headers(spark, sf_dir), inputs.details(spark, sf_dir))


def quantity_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.quantity_profile(inputs.details(spark, sf_dir))


def basket_size_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.basket_size_profile(inputs.headers(spark, sf_dir), inputs.details(spark, sf_dir))


def domain_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.domain_violations(inputs.headers(spark, sf_dir), inputs.details(spark, sf_dir))


def open_hours_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.open_hours_sales(inputs.headers(spark, sf_dir))


def out_of_hours_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.out_of_hours_by_store(inputs.headers(spark, sf_dir))


def dedupe_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read_log_lines(spark, inputs.redelivered_log_folder(spark, sf_dir))
    records = drop_copies(decode_lines(lines))
    return _contents(shred_headers(records), shred_details(records), rejected(records))


def late_copies_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole second delivery after two loads are stored adds nothing; sketches tell which loads to look in."""
    folder = new_folder(spark, "facts")
    records = _log_records(spark, sf_dir)
    earlier = F.col("tx.transaction_date") < ORIGIN_SPLIT
    append_load(records.where(earlier), folder, "earlier", sketch=True)
    append_load(records.where(~F.coalesce(earlier, F.lit(False))), folder, "later", sketch=True)
    again = settled(decode_lines(read_log_lines(spark, inputs.redelivered_log_folder(spark, sf_dir))))
    append_load(drop_stored_copies(again, folder), folder, "second")
    return _stored_contents(spark, folder)


# --- keys, times, numbers ------------------------------------------------------------------


def format_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of order size, and of a thousand times that to pass each key's width."""
    key = F.col("o_orderkey")
    return inputs.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        transaction_key(key).alias("transaction_id"),
        store_key(key).alias("supermarket_id"),
        sku_key(key).alias("sku"),
        transaction_key(key * 1000).alias("wide_transaction_id"),
    )


def local_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.table(spark, sf_dir, "events").select(
        "event_id", zone_time(F.col("ts")).alias("store_time")
    )


def assign_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = inputs.table(spark, sf_dir, "orders").select("o_orderdate", "o_orderkey")
    return assign_transaction_ids(orders, ["o_orderdate", "o_orderkey"])


# --- tables as a whole ---------------------------------------------------------------------


def union_origins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A historical load and a live one in one table; each row tells where it came from."""
    folder = new_folder(spark, "facts")
    earlier = F.col("tx.transaction_date") < ORIGIN_SPLIT
    overwrite_historical(_csv_records(spark, sf_dir).where(earlier), folder)
    append_load(_log_records(spark, sf_dir).where(~earlier), folder, "live")
    rows = read_fact(spark, folder, "headers", stored=True)
    return rows.select("transaction_id", "supermarket_id", "transaction_date", "origin")


def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first sales of all, in order."""
    return inputs.headers(spark, sf_dir).orderBy("transaction_date", "transaction_id").limit(PREVIEW)


def _tables(spark: SparkSession, sf_dir: str, folder: str | None = None) -> dict[str, DataFrame]:
    folder = folder or _log_facts(spark, sf_dir)
    return views.load_tables(spark, folder, inputs.skus(spark, sf_dir), inputs.supermarkets(spark, sf_dir))


def sql_reused_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units of each sale though every id is handed out to two orders."""
    folder = new_folder(spark, "facts")
    append_load(decode_lines(read_log_lines(spark, inputs.reused_id_folder(spark, sf_dir))), folder, "reused")
    views.register(_tables(spark, sf_dir, folder), prefix="basketflow_reused_")
    return spark.sql(
        """
        select h.transaction_id, h.supermarket_id, h.transaction_date, sum(d.quantity) as units
        from basketflow_reused_headers h join basketflow_reused_details d on d.tx_key = h.tx_key
        group by h.transaction_id, h.supermarket_id, h.transaction_date
        """
    )


def sql_three_way(spark: SparkSession, sf_dir: str) -> DataFrame:
    views.register(_tables(spark, sf_dir), prefix="basketflow_")
    return spark.sql(
        """
        select s.supermarket_name, k.article_name,
               sum(d.quantity) as units,
               cast(sum(d.quantity * k.price) as double) as sales
        from basketflow_details d
        join basketflow_headers h on h.tx_key = d.tx_key
        join basketflow_skus k on k.sku = d.sku
        join basketflow_supermarkets s on s.supermarket_id = h.supermarket_id
        group by s.supermarket_name, k.article_name
        """
    )


def readme_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    views.register(views.with_public_names(_tables(spark, sf_dir)), prefix="basketflow_public_")
    return spark.sql(
        """
        select t.transaction_id, t.store_id, s.store_name, t.transaction_datetime,
               i.sku_id, k.product_name, cast(k.price as double) as price, i.quantity
        from basketflow_public_transactions t
        join basketflow_public_transaction_items i on i.tx_key = t.tx_key
        join basketflow_public_skus k on k.sku_id = i.sku_id
        join basketflow_public_supermarkets s on s.store_id = t.store_id
        """
    )


# --- streams -------------------------------------------------------------------------------


# Log files, as delivered: bytes that a task of the state stands for, and that a batch of a long load takes, about.
STATE_BYTES = 64 << 20
BATCH_BYTES = 256 << 20


def _state_partitions(spark: SparkSession, folder: str) -> int:
    """Small state needs no more tasks than there are cores; what many logs bring is dealt to as many rounds of them, so
    that the rows of a task fit its memory."""
    few = min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return few * max(1, -(-Files(spark, folder).size(folder) // (few * STATE_BYTES)))


def _ingest(spark: SparkSession, folder: str, facts: str, progress: str, **options) -> None:
    start_ingest(
        spark, folder, facts, progress, state_partitions=_state_partitions(spark, folder), count_state=False, **options
    ).awaitTermination()


def _ingested_logs(spark: SparkSession, sf_dir: str) -> str:
    facts = new_folder(spark, "facts")
    _ingest(spark, inputs.log_folder(spark, sf_dir), facts, new_folder(spark, "progress"), horizon=None)
    return facts


def stream_shred_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_fact(spark, _ingested_logs(spark, sf_dir), "headers")


def stream_shred_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_fact(spark, _ingested_logs(spark, sf_dir), "details")


def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log files land and are loaded; they land again under other names, and the same stream
    goes on. The first delivery holds each line twice as well. A batch takes a bounded share of a delivery, and
    what it shuffled goes before the next one."""
    incoming, facts, progress = (new_folder(spark, name) for name in ("incoming", "facts", "progress"))
    lines = spark.read.text(inputs.log_folder(spark, sf_dir))
    for copies in (2, 1):
        for _ in range(copies):
            inputs.deliver(spark, lines, incoming)
        _ingest(spark, incoming, facts, progress, max_bytes=BATCH_BYTES)
    return _stored_contents(spark, facts)


def stream_late_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the lines land; the other half lands later, in files dated a month before."""
    incoming, facts, progress = (new_folder(spark, name) for name in ("incoming", "facts", "progress"))
    lines = spark.read.text(inputs.log_folder(spark, sf_dir))
    for half, days_old in ((0, 0), (1, 30)):
        inputs.deliver(spark, lines.where(F.pmod(F.xxhash64("value"), F.lit(2)) == half), incoming, days_old)
        _ingest(spark, incoming, facts, progress, horizon=None)
    return _stored_contents(spark, facts)


def _placed(headers: DataFrame, details: DataFrame, place: str) -> DataFrame:
    """Whole tables as rows of text with the place that each row was found in."""
    return _contents(headers.withColumn("place", F.lit(place)), details).withColumn("place", F.lit(place))


def compacted_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches merged into a unit, then one more; each row with where it lies. What the unit replaced is gone."""
    incoming, facts, progress = (new_folder(spark, name) for name in ("incoming", "facts", "progress"))
    lines = spark.read.text(inputs.log_folder(spark, sf_dir))
    for quarter in range(4):
        inputs.deliver(spark, lines.where(inputs.share_of(4) == quarter), incoming)
        query = start_ingest(spark, incoming, facts, progress, horizon=None)
        query.awaitTermination()
        if quarter == 2:
            for _ in range(2):  # what a merge replaced goes with the next one
                merge_batches(spark, facts, progress, query.id, fan=3, base_bytes=1 << 40, keep_seconds=0)
    tables = ("headers", "details")
    parts = generations.parts(spark, facts, [*tables, "rejects"])
    found = None
    for kind, chosen in (("unit", [p for p in parts if p.run]), ("load", [p for p in parts if not p.run])):
        rows = _placed(*[generations.read_parts(spark, facts, name, chosen) for name in tables], kind)
        found = rows if found is None else found.unionAll(rows)
    loads = sorted({number for name in tables for *_, number in generations.loads(spark, facts, name)})
    folders = spark.range(1).select(F.lit("folders").alias("stored_in"), F.lit("none").alias("transaction_id"), F.lit(str(loads)).alias("content"), F.lit("load").alias("place"))
    rejects = read_fact(spark, facts, "rejects").agg(F.count("*").cast("string").alias("content"))
    return found.unionAll(folders).unionAll(rejects.select(F.lit("rejects"), F.lit("none"), "content", F.lit("all")))


def stream_broken_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder with compressed files that were cut off: they are set aside, the others load."""
    facts = new_folder(spark, "facts")
    folder = inputs.part_broken_log_folder(spark, sf_dir)
    _ingest(spark, folder, facts, new_folder(spark, "progress"), horizon=None, set_aside_broken=True)
    rejects = read_fact(spark, facts, "rejects")
    reasons = rejects.groupBy("reason").agg(F.count("*").cast("string").alias("content"))
    stored = _contents(read_fact(spark, facts, "headers"), read_fact(spark, facts, "details"))
    return stored.unionAll(reasons.select(F.lit("rejects"), "reason", "content"))


def load_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refused lines, flags and broken rules of a load of several batches, counted while each was written."""
    facts, incoming, progress = (new_folder(spark, name) for name in ("facts", "incoming", "progress"))
    lines = spark.read.text(inputs.log_folder(spark, sf_dir)).unionAll(spark.read.text(inputs.flawed_log_folder(spark, sf_dir)))
    for half in range(2):
        inputs.deliver(spark, lines.where(inputs.share_of(2) == half), incoming)
        _ingest(spark, incoming, facts, progress, horizon=None, checks=True)
    return read_checks(spark, facts).groupBy("rule").agg(F.sum("rows").alias("rows"))


def orphans_by_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items without a header after three loads, each audited as it came: a header comes a load before its items, a load
    after them, or never."""
    facts, state = new_folder(spark, "facts"), new_folder(spark, "orphans")
    # Decoded once for all three loads.
    rows = fact_rows(settled(_log_records(spark, sf_dir)))
    third = F.pmod(F.substring("transaction_id", 3, 20).cast("bigint"), F.lit(3))
    for number in range(3):
        items = (F.col("table") == "details") & (third == number)
        heads = (F.col("table") == "headers") & (third == (number + 2) % 3) & (F.col("transaction_date") < F.lit(HEADERS_UNTIL).cast("timestamp_ntz"))
        write_batch(rows.where(items | heads), facts, "realtime", "split", number)
        load = generations.Unit("realtime", "split", number, number, "", 0)
        write_sketch(spark, facts, load.name, generations.read_parts(spark, facts, "headers", [load]))
        found = audit_new_loads(spark, facts, state)
    return found.select("transaction_id", "sku", "quantity")


def stream_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines by where they are after three deliveries with an archive and the closing pass: all in the archive."""
    incoming, facts, progress, archive = (new_folder(spark, name) for name in ("incoming", "facts", "progress", "archive"))
    lines = spark.read.text(inputs.log_folder(spark, sf_dir))
    for third in range(3):
        inputs.deliver(spark, lines.where(F.pmod(F.xxhash64("value"), F.lit(3)) == third), incoming)
        _ingest(spark, incoming, facts, progress, horizon=None, archive_dir=archive)
    close_archive(spark, incoming, progress, archive)
    found = None
    for place, folder in (("archive", archive), ("incoming", incoming)):
        lines = spark.read.schema("value string").option("recursiveFileLookup", True).text(folder) if path_exists(spark, folder) else spark.createDataFrame([], "value string")
        records = decode_lines(lines.select("value", F.lit("").alias("source_file"), F.current_timestamp().alias("arrived_at")))
        rows = _contents(shred_headers(records), shred_details(records), rejected(records)).withColumn("place", F.lit(place))
        found = rows if found is None else found.unionAll(rows)
    return found


def stream_sales_by_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of a stream that a new checkpoint began anew, was stopped and went on as more files landed."""
    report, incoming = new_folder(spark, "live-sales"), new_folder(spark, "incoming")
    _live_sales(spark, inputs.redelivered_log_folder(spark, sf_dir), report, new_folder(spark, "progress"), horizon=None)
    lines, progress = spark.read.text(inputs.log_folder(spark, sf_dir)), new_folder(spark, "progress")
    for third in inputs.shares(spark, lines, 3):
        inputs.land(spark, third, incoming)
        _live_sales(spark, incoming, report, progress, fan=2)
    live = read_live_sales(spark, report, inputs.skus(spark, sf_dir))
    return live.withColumn("sales", F.col("sales").cast("double"))


def _live_sales(spark: SparkSession, folder: str, report: str, progress: str, **options) -> None:
    start_live_sales(
        spark, folder, report, progress, state_partitions=_state_partitions(spark, folder), count_state=False, **options
    ).awaitTermination()


def stream_top_skus(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = new_folder(spark, "live-sales")
    _live_sales(spark, inputs.log_folder(spark, sf_dir), report, new_folder(spark, "progress"))
    return read_live_top_skus(spark, report, inputs.skus(spark, sf_dir), TOP_K)


QUERIES: dict[str, Query] = {
    "shred_headers": headers_from_logs,
    "shred_details": details_from_logs,
    "filter_valid_tx": filter_valid_tx,
    "quarantine_reasons": quarantine_reasons,
    "flag_counts": flag_counts,
    "bad_dates": bad_dates,
    "csv_items_roundtrip": csv_items_roundtrip,
    "csv_headers": csv_headers,
    "dim_skus": dim_skus,
    "dim_stores": dim_stores,
    "scan_headers": scan_headers,
    "scan_details": scan_details,
    "write_overwrite_readback": write_overwrite_readback,
    "write_append_readback": write_append_readback,
    "stream_shred_headers": stream_shred_headers,
    "stream_shred_details": stream_shred_details,
    "stream_dedupe": stream_dedupe,
    "dedupe_transactions": dedupe_transactions,
    "late_copies_dropped": late_copies_dropped,
    "stream_sales_by_store": stream_sales_by_store,
    "join_header_detail": join_header_detail,
    "line_revenue": line_revenue,
    "sales_by_store": sales_by_store,
    "sales_by_store_dated": sales_by_store_dated,
    "end_to_end_sales": end_to_end_sales,
    "top_skus_by_units": top_skus_by_units,
    "top_skus_by_sales": top_skus_by_sales,
    "orphan_details": orphan_details,
    "headers_without_items": headers_without_items,
    "quantity_profile": quantity_profile,
    "basket_size_profile": basket_size_profile,
    "domain_violations": domain_violations,
    "open_hours_filter": open_hours_filter,
    "out_of_hours_audit": out_of_hours_audit,
    "assign_ids": assign_ids,
    "format_keys": format_keys,
    "local_time": local_time,
    "union_origins": union_origins,
    "preview": preview,
    "csv_broken_rows": csv_broken_rows,
    "csv_multi_line": csv_multi_line,
    "stream_broken_files": stream_broken_files,
    "load_checks": load_checks,
    "orphans_by_load": orphans_by_load,
    "sales_on_quarter_ends": sales_on_quarter_ends,
    "sales_after_redelivery": sales_after_redelivery,
    "stream_late_files": stream_late_files,
    "stream_archive": stream_archive,
    "compacted_readback": compacted_readback,
    "stream_top_skus": stream_top_skus,
    "sql_reused_ids": sql_reused_ids,
    "sql_three_way": sql_three_way,
    "readme_views": readme_views,
}

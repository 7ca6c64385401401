"""The driver's tables as the pipeline's inputs.

nation -> supermarkets, part -> skus, orders with customer -> headers, lineitem -> details, and
from those raw log lines and CSV exports. Raw input is written to the shared folder once per
session and table folder, and read back by the queries like any delivered file.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from basketflow import schemas
from basketflow.files import Files
from basketflow.functions import format_local_time, sku_key, store_key, transaction_key
from basketflow.operators.shred import to_log_line
from basketflow.session import SHUFFLES_GO, temporary_settings
from basketflow.sinks import write_skus_csv, write_supermarkets_csv, write_transactions_csv
from basketflow.workspace import new_folder, path_exists

PRICE_PRECISION = 12
# Items of a record, about: an order comes as the records that its lineitems fill at this size, at least one.
RECORD_ITEMS = 20


_table_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its schema is read from the file once, not in a job for every query."""
    path = os.path.join(sf_dir, f"{name}.parquet")
    if path not in _table_schemas:
        _table_schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_table_schemas[path]).parquet(path)


def supermarkets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        store_key(F.col("n_nationkey") + 1).alias("supermarket_id"), F.col("n_name").alias("supermarket_name")
    )


def skus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        sku_key(F.col("p_partkey") + 1).alias("sku"),
        F.col("p_name").alias("article_name"),
        F.col("p_retailprice").cast(f"decimal({PRICE_PRECISION},2)").alias("price"),
    )


def _sale_time() -> Column:
    """Order dates are midnights; a fixed spread of seconds makes times of day."""
    seconds = (F.col("o_orderkey") * 7919) % 86400
    return F.col("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def _customer_orders(
    spark: SparkSession, sf_dir: str, since: str | None = None, until: str | None = None
) -> DataFrame:
    """Orders with the nation of their customer, numbers only. ``since`` and ``until`` are days, so a test of the
    order's day is a test of its sale time, and one the Parquet scan can use."""
    orders = table(spark, sf_dir, "orders")
    if since:
        orders = orders.where(F.col("o_orderdate") >= F.lit(since).cast("timestamp_ntz"))
    if until:
        orders = orders.where(F.col("o_orderdate") < F.lit(until).cast("timestamp_ntz"))
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    return orders.join(customers, "o_custkey").select("o_orderkey", "o_orderdate", "c_nationkey")


def _header_columns() -> list[Column]:
    return [
        transaction_key(F.col("o_orderkey") + 1).alias("transaction_id"),
        store_key(F.col("c_nationkey") + 1).alias("supermarket_id"),
        _sale_time().alias("transaction_date"),
    ]


def headers(spark: SparkSession, sf_dir: str, since: str | None = None, until: str | None = None) -> DataFrame:
    return _customer_orders(spark, sf_dir, since, until).select(*_header_columns())


def details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        transaction_key(F.col("l_orderkey") + 1).alias("transaction_id"),
        sku_key(F.col("l_partkey") + 1).alias("sku"),
        F.col("l_quantity").cast("int").alias("quantity"),
    )


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item lists by order and ``part``: exactly ceil(items / RECORD_ITEMS) parts of an order, so that no
    list is collected for a whole order whatever its size. A part may be empty.

    Lineitems are shuffled once, as numbers, by order: they are counted, dealt to parts and collected in place, and
    lie where the join on the order needs them. The first one of an order brings a row without an item for each of
    several parts, so that empty parts are there."""
    lines = table(spark, sf_dir, "lineitem").where(F.col("l_orderkey").isNotNull()).select(
        F.col("l_orderkey").alias("o_orderkey"),
        "l_partkey",
        F.col("l_quantity").cast("int").alias("quantity"),
        F.monotonically_increasing_id().alias("place"),
    )
    order = Window.partitionBy("o_orderkey")
    counted = lines.withColumn("parts", F.ceil(F.count("*").over(order) / RECORD_ITEMS).cast("int")).withColumn(
        "opens", (F.min("place").over(order) == F.col("place")) & (F.col("parts") > 1)
    )
    item = F.struct(sku_key(F.col("l_partkey") + 1).alias("sku"), "quantity")
    own = F.struct(F.pmod(F.xxhash64("place"), "parts").cast("int").alias("part"), item.alias("item"))
    empty = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda part: F.struct(part.alias("part"), F.lit(None).cast("struct<sku:string,quantity:int>").alias("item")),
    )
    dealt = counted.select("o_orderkey", F.explode(F.when(F.col("opens"), F.concat(F.array(own), empty)).otherwise(F.array(own))).alias("row"))
    return dealt.select("o_orderkey", "row.part", "row.item").groupBy("o_orderkey", "part").agg(F.collect_list("item").alias("items"))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested transactions as a till sends them, dates as text; an order without lineitems has an
    empty list. A large order comes as several transactions with the same header, told apart by
    ``part``."""
    return (
        _customer_orders(spark, sf_dir)
        .join(_records(spark, sf_dir), "o_orderkey", "left")
        .select(*_header_columns(), "items", "part")
        .select(
            "transaction_id",
            "supermarket_id",
            format_local_time(F.col("transaction_date")).alias("transaction_date"),
            F.coalesce("items", F.array().cast(schemas.ITEMS_TYPE)).alias("items"),
            F.when(F.col("part") > 0, F.col("part")).alias("part"),
        )
    )


def transaction_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = transactions(spark, sf_dir)
    return sent.select(to_log_line(F.struct(*sent.columns)).alias("value"))


def _prose(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text that is no transaction, one line each."""
    return table(spark, sf_dir, "conversations").select(F.regexp_replace("text", r"[\r\n]+", " ").alias("text"))


def junk_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation text as a router wraps it, and bare."""
    prose = _prose(spark, sf_dir)
    wrapped = prose.select(F.to_json(F.struct(F.col("text").alias("log"))).alias("value"))
    return wrapped.unionByName(prose.select(F.col("text").alias("value")))


# Kinds of broken line, by order key; also in the oracle of `quarantine_reasons`.
BROKEN_KINDS = 12


def broken_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line for every order, each broken in one of the ways a feed can be."""
    ident = transaction_key(F.col("o_orderkey") + 1)
    good = F.to_json(F.struct(ident.alias("transaction_id"), F.lit("STORE0001").alias("supermarket_id")))

    def wrap(text: Column) -> Column:
        return F.to_json(F.struct(text.alias("log")))

    def cut_off(text: Column) -> Column:
        return F.substr(text, F.lit(1), F.length(text) - 1)

    kinds = [
        F.concat(F.lit("Starting "), ident),  # bad_line: prose
        F.concat(F.lit("["), good, F.lit("]")),  # bad_line: an array
        cut_off(wrap(good)),  # bad_line
        F.lit('{"log": ""}'),  # no_log
        F.lit('{"log": null}'),  # no_log
        F.concat(F.lit('{"other": '), good, F.lit("}")),  # no_log
        wrap(F.concat(F.lit("Stores are closed after "), ident)),  # not_json
        wrap(cut_off(good)),  # not_json
        wrap(F.concat(F.lit("["), good, F.lit("]"))),  # not_object
        wrap(F.col("o_orderkey").cast("string")),  # not_object
        wrap(F.lit('{"supermarket_id": "STORE0001"}')),  # no_id
        wrap(F.lit('{"transaction_id": null}')),  # null_id
    ]
    value = F.lit(None).cast("string")
    for kind, text in enumerate(kinds):
        value = F.when(F.col("o_orderkey") % BROKEN_KINDS == kind, text).otherwise(value)
    return table(spark, sf_dir, "orders").select(value.alias("value"))


# Items and date of a kept but flawed line, by order key; also in the oracle of `flag_counts`.
FLAWS = [
    ('[{"sku": "SKU00001", "quantity": 1}]', "2024-04-10 19:22:28"),  # none
    ('[{"sku": "SKU00001", "quantity": 1}]', "2024-04-10"),  # bad_date
    ('"nothing"', "2024-04-10 19:22:28"),  # bad_items
    ("null", "2024-04-10 19:22:28"),  # none
    ("[null]", "2024-04-10 19:22:28"),  # null_item
    ('[{"sku": "SKU00001", "quantity": 1.5}]', "bad"),  # bad_date, bad_quantity
    ('[null, {"sku": "SKU00001", "quantity": "3"}]', "2024-04-10 19:22:28"),  # null_item, bad_quantity
    ("[]", "2024-02-30 19:22:28"),  # bad_date
]


def flawed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line for every order; each is a transaction, some with parts that cannot be read."""
    ident = transaction_key(F.col("o_orderkey") + 1)
    value = F.lit(None).cast("string")
    for kind, (items, date_text) in enumerate(FLAWS):
        text = F.concat(
            F.lit('{"transaction_id": "'),
            ident,
            F.lit(f'", "transaction_date": "{date_text}", "items": {items}}}'),
        )
        line = F.to_json(F.struct(text.alias("log")))
        value = F.when(F.col("o_orderkey") % len(FLAWS) == kind, line).otherwise(value)
    return table(spark, sf_dir, "orders").select(value.alias("value"))


ITEMS_CSV = '[{""sku"": ""SKU00001"", ""quantity"": 1}]'
# Rows of a CSV export by order key, the id left out: how each is broken, and what becomes of it is in the
# oracle of `csv_broken_rows`. The last one has a line break inside its item list.
CSV_ROWS = [
    f',STORE0001,2024-04-10 19:22:28,"{ITEMS_CSV}"',
    f',STORE0001,2024-04-10 19:22:28,"{ITEMS_CSV} {ITEMS_CSV}"',
    f',STORE0001,2024-04-10 19:22:28,"{ITEMS_CSV}",more',
    ",STORE0001",
    f',STORE0001,2024-04-10,"{ITEMS_CSV}"',
    ',STORE0001,2024-04-10 19:22:28,"[{""sku"": ""SKU00001"",\n""quantity"": 1}]"',
]


def broken_csv_folder(spark: SparkSession, sf_dir: str) -> str:
    """CSV files with a header each and one row for every order."""
    files = 4
    value = F.lit(None).cast("string")
    for kind, rest in enumerate(CSV_ROWS):
        row = F.concat(transaction_key(F.col("o_orderkey") + 1), F.lit(rest))
        value = F.when(F.col("o_orderkey") % len(CSV_ROWS) == kind, row).otherwise(value)
    rows = table(spark, sf_dir, "orders").select(
        (F.col("o_orderkey") % files).cast("int").alias("file"), F.lit(1).alias("place"), value.alias("value")
    )
    heads = spark.range(files).select(F.col("id").cast("int").alias("file"), F.lit(0).alias("place"), F.lit(schemas.CSV_HEADER).alias("value"))
    lines = rows.unionAll(heads).repartitionById(files, "file").sortWithinPartitions("place").select("value")
    return _stage(spark, sf_dir, "broken-csv", lines.write.text)


def reused_id_folder(spark: SparkSession, sf_dir: str) -> str:
    """Log files in which ids are handed out again: half as many ids as orders."""
    half = table(spark, sf_dir, "orders").count() // 2
    sent = transactions(spark, sf_dir)
    number = F.substring("transaction_id", 3, 20).cast("bigint") - 1
    again = sent.withColumn("transaction_id", transaction_key(number % half + 1))
    lines = again.select(to_log_line(F.struct(*again.columns)).alias("value"))
    return _stage(spark, sf_dir, "reused-ids", _packed(lines))


def deliver(spark: SparkSession, lines: DataFrame, folder: str, days_old: int = 0) -> None:
    """Add files of these lines to a folder, dated some days back."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    before = {f.getPath().toString() for f in files.listStatus(path)} if files.exists(path) else set()
    _packed(lines, "append")(folder)
    for found in files.listStatus(path):
        if days_old and found.getPath().toString() not in before:
            files.setTimes(found.getPath(), found.getModificationTime() - days_old * 86_400_000, -1)


def _packed(lines: DataFrame, mode: str = "error", *folders: str) -> Callable[[str], None]:
    """Writes log files compressed, as routers send them: a sixth of the disk of their text."""
    return lines.write.mode(mode).partitionBy(*folders).option("compression", "gzip").text


_staged: dict[tuple[str, str, str], str] = {}


def _stage(spark: SparkSession, sf_dir: str, label: str, write: Callable[[str], None]) -> str:
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir), label)
    if key not in _staged or not path_exists(spark, _staged[key]):
        folder = new_folder(spark, label)
        with temporary_settings(spark, SHUFFLES_GO):
            write(folder)
        _staged[key] = folder
    return _staged[key]


def log_folder(spark: SparkSession, sf_dir: str) -> str:
    """Log files: every transaction, and the prose lines twice."""
    lines = transaction_lines(spark, sf_dir).unionByName(junk_lines(spark, sf_dir))
    return _stage(spark, sf_dir, "logs", _packed(lines))


def broken_log_folder(spark: SparkSession, sf_dir: str) -> str:
    lines = broken_lines(spark, sf_dir).unionByName(junk_lines(spark, sf_dir))
    return _stage(spark, sf_dir, "broken-logs", lines.write.text)


def flawed_log_folder(spark: SparkSession, sf_dir: str) -> str:
    return _stage(spark, sf_dir, "flawed-logs", _packed(flawed_lines(spark, sf_dir)))


def redelivered_log_folder(spark: SparkSession, sf_dir: str) -> str:
    """The log files once more under other names, beside the first ones."""

    def write(folder: str) -> None:
        delivered = spark.read.text(log_folder(spark, sf_dir))
        for _ in range(2):
            _packed(delivered, "append")(folder)

    return _stage(spark, sf_dir, "redelivered-logs", write)


def share_of(parts: int) -> Column:
    """The part that a log line is in, by the number in its id; lines without one are in the first."""
    number = F.regexp_extract("value", "TX([0-9]+)", 1)
    return F.pmod(F.coalesce(F.when(number != "", number.cast("bigint")), F.lit(0)), F.lit(parts))


def shares(spark: SparkSession, lines: DataFrame, parts: int) -> list[str]:
    """Folders with the log files of each part, written in one pass over the lines."""
    folder = new_folder(spark, "shares")
    # With a writer per part a task need not sort its lines by part.
    with temporary_settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": parts}):
        _packed(lines.select("value", share_of(parts).alias("share")), "error", "share")(folder)
    return [f"{folder}/share={part}" for part in range(parts)]


def land(spark: SparkSession, sent: str, folder: str) -> None:
    """Move the files of a share into a folder, which is there afterwards also if the share has none."""
    files = Files(spark, folder)
    files.make(folder)
    for name in files.names(sent):
        files.move(f"{sent}/{name}", f"{folder}/{os.path.basename(sent)}-{name}")


# Parts of the log lines: how they are sent, in a folder with broken files.
SENT_PLAIN, SENT_PACKED, SENT_BROKEN = 0, 1, 2
BROKEN_FILES = 2


def part_broken_log_folder(spark: SparkSession, sf_dir: str) -> str:
    """A third of the log lines in plain files, one in compressed files, and one in compressed files cut off half-way."""

    def write(folder: str) -> None:
        lines = spark.read.text(log_folder(spark, sf_dir))
        broken = new_folder(spark, "broken-files")
        lines.where(share_of(3) == SENT_BROKEN).repartition(BROKEN_FILES).write.option("compression", "gzip").text(broken)
        files = Files(spark, folder)
        for number, path in enumerate(p for p in files.below(broken) if p.endswith(".gz")):
            files.halve(path)
            files.move(path, f"{folder}/broken-{number}.txt.gz")
        lines.where(share_of(3) == SENT_PLAIN).write.mode("append").text(folder)
        lines.where(share_of(3) == SENT_PACKED).write.mode("append").option("compression", "gzip").text(folder)

    return _stage(spark, sf_dir, "part-broken-logs", write)


# Records of a file of the export with line breaks, about; it is read in splits.
CSV_FILE_RECORDS = 500_000


def multi_line_csv_folder(spark: SparkSession, sf_dir: str) -> str:
    """The export with a line break after each comma of an item list, in two files or, where it is large, more."""
    sent = transactions(spark, sf_dir)
    files = max(2, -(-table(spark, sf_dir, "orders").count() // CSV_FILE_RECORDS))
    spread = sent.select(
        "transaction_id", "supermarket_id", "transaction_date", F.to_json("items").alias("items")
    ).repartition(files).withColumn("items", F.regexp_replace("items", ",", ",\n"))
    return _stage(
        spark, sf_dir, "multi-line-csv",
        lambda folder: spread.write.option("header", True).option("quote", '"').option("escape", '"').csv(folder),
    )


def csv_file(spark: SparkSession, sf_dir: str) -> str:
    return _stage(
        spark, sf_dir, "csv", lambda folder: write_transactions_csv(transactions(spark, sf_dir), folder, compression="gzip")
    )


def skus_csv(spark: SparkSession, sf_dir: str) -> str:
    return _stage(spark, sf_dir, "skus-csv", lambda folder: write_skus_csv(skus(spark, sf_dir), folder))


def supermarkets_csv(spark: SparkSession, sf_dir: str) -> str:
    return _stage(
        spark,
        sf_dir,
        "supermarkets-csv",
        lambda folder: write_supermarkets_csv(supermarkets(spark, sf_dir), folder),
    )

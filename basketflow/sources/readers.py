"""Readers with fixed schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow import schemas
from basketflow.functions import money
from basketflow.sinks import generations
from basketflow.sources.multi_line import read_records
from basketflow.sources.packed import BINARY, PACKED, PLAIN, unpacked, with_no_fault
from basketflow.workspace import path_exists


def _with_lineage(rows: DataFrame) -> DataFrame:
    """Unlike ``_metadata``, whose struct stays in the scan, these cost nothing when not used."""
    return rows.select("*", F.input_file_name().alias("source_file"), F.current_timestamp().alias("arrived_at"))


def _quoted_csv(spark: SparkSession, schema: str):
    """Header, double quotes, and a quote inside a field written twice.

    With Spark's default escape the JSON would be cut at its first comma.
    """
    return spark.read.schema(schema).option("header", True).option("quote", '"').option("escape", '"')


def read_transactions_csv(spark: SparkSession, path: str, *, multi_line: bool = False) -> DataFrame:
    """Historical export: four text columns, the item list as JSON text.

    A row with more or fewer fields keeps its text in the fifth column and is refused later.
    ``multi_line`` reads fields with line breaks in them, large files in many tasks (see ``multi_line``);
    without it the halves of such a row are refused.
    """
    schema = f"{schemas.CSV_TRANSACTIONS}, {schemas.CSV_BROKEN} string"
    if not multi_line:
        return _with_lineage(_quoted_csv(spark, schema).option("columnNameOfCorruptRecord", schemas.CSV_BROKEN).csv(path))
    records = read_records(spark, path).where(F.rtrim("value", F.lit("\r")) != schemas.CSV_HEADER)
    options = {"quote": '"', "escape": '"', "multiLine": "true", "columnNameOfCorruptRecord": schemas.CSV_BROKEN}
    # A carriage return before the line break is part of the line break.
    parsed = records.select(F.from_csv(F.regexp_replace("value", r"\r\z", ""), F.lit(schema), options).alias("row"), "source_file")
    return parsed.select("row.*", "source_file", F.current_timestamp().alias("arrived_at"))


def read_skus(spark: SparkSession, path: str, precision: int = 10) -> DataFrame:
    return _quoted_csv(spark, schemas.CSV_SKUS).csv(path).select(
        "sku",
        F.col("name of article").alias("article_name"),
        money(F.col("price"), precision).alias("price"),
    )


def read_supermarkets(spark: SparkSession, path: str) -> DataFrame:
    return _quoted_csv(spark, schemas.CSV_SUPERMARKETS).csv(path)


def read_log_lines(spark: SparkSession, path: str, *, set_aside_broken: bool = False) -> DataFrame:
    """Log lines as text: no inference pass, and lines that are not JSON stay visible. ``set_aside_broken`` gives
    a compressed file that cannot be unpacked as one row that says so, instead of failing."""
    if not set_aside_broken:
        return _with_lineage(spark.read.text(path))
    plain = with_no_fault(_with_lineage(spark.read.option("pathGlobFilter", PLAIN).text(path)))
    packed = unpacked(spark.read.format("binaryFile").option("pathGlobFilter", PACKED).load(path))
    return plain.unionByName(packed.withColumn("arrived_at", F.current_timestamp()))


def stream_log_lines(
    spark: SparkSession,
    path: str,
    *,
    max_files: int | None = None,
    max_bytes: int | None = None,
    archive_dir: str | None = None,
    max_file_age: str = "36500d",
    set_aside_broken: bool = False,
) -> DataFrame:
    """The same lines from files as they land.

    ``max_files`` or ``max_bytes`` bounds a batch. With ``archive_dir`` a file is moved there
    once a later batch has started, so only files whose rows are committed are ever moved; the
    files of the last batch stay until the next one, in this run or a later one (or ``close_archive``), and a
    move that fails is only logged.

    Spark ignores a file for good when it is older than ``maxFileAge`` against the newest one
    seen. A late file must be loaded, so the default here never cuts. The list of files seen then
    grows with the folder; the archive keeps both small.

    ``set_aside_broken`` reads compressed files by a second source, which gives each whole or as one row that says
    why not; the bounds of a batch hold for either source. It must not change under a checkpoint.
    """
    if max_files and max_bytes:
        raise ValueError("give max_files or max_bytes, not both")
    options = {"maxFileAge": max_file_age}
    if max_files:
        options["maxFilesPerTrigger"] = str(max_files)
    if max_bytes:
        options["maxBytesPerTrigger"] = str(max_bytes)
    if archive_dir:
        options |= {"cleanSource": "archive", "sourceArchiveDir": archive_dir}
    reader = spark.readStream.format("text").options(**options)
    if not set_aside_broken:
        return _with_lineage(reader.load(path))
    plain = with_no_fault(_with_lineage(reader.option("pathGlobFilter", PLAIN).load(path)))
    files = spark.readStream.format("binaryFile").schema(BINARY).options(**options).option("pathGlobFilter", PACKED).load(path)
    return plain.unionByName(unpacked(files).withColumn("arrived_at", F.current_timestamp()))


def read_fact(
    spark: SparkSession,
    path: str,
    table: str,
    *,
    stored: bool = False,
    days: bool = False,
    on_days: DataFrame | None = None,
    since: str | None = None,
    until: str | None = None,
) -> DataFrame:
    """``headers``, ``details`` or ``rejects`` of a fact folder, as of the current generation.

    ``stored`` gives every stored column (record key, flags, lineage, load) instead of the table's own ones. A table
    no load has written to yet is empty. ``since`` and ``until`` leave out folders of days that lie outside; rows
    of other layouts are not filtered. ``days`` adds the column ``day``, the first day of the layout's period (of the
    row itself where its load has no such layout). ``on_days``, a table with the column ``day``, keeps the rows of those
    days; its rows, one for each day at most, are sent to the scans, which leave out other folders when they run.
    """
    chosen = F.broadcast(on_days.select("day").distinct()) if on_days is not None else None
    days = days or chosen is not None

    schema, folder = schemas.FACT_SCHEMAS[table], f"{path}/table={table}"
    columns = [column.split()[0] for column in schema.split(", ")]
    units = generations.current(spark, path).units
    dated = table != "rejects"
    own_day = [F.to_date("transaction_date").alias("day")] if days and dated else []
    found = []
    if path_exists(spark, folder):
        rows = spark.read.schema(schema).parquet(folder)
        for unit in units:
            covered = (F.col("origin") == unit.origin) & (F.col("stream_id") == unit.stream_id) & F.col("batch_id").between(unit.low, unit.high)
            rows = rows.where(~F.coalesce(covered, F.lit(False)))
        found.append(rows.select(*columns, *own_day))
    for period in sorted({unit.period if dated else None for unit in units if table in unit.tables}, key=str):
        folders = [generations.unit_folder(path, u, table) for u in units if table in u.tables and (not dated or u.period == period)]
        merged = spark.read.schema(f"{schema}, day date" if period else schema).option("basePath", generations.merged_root(path)).parquet(*folders)
        if period and since:
            merged = merged.where(F.col("day") >= F.trunc(F.lit(since).cast("date"), period) if period != "day" else F.col("day") >= F.lit(since).cast("date"))
        if period and until:
            merged = merged.where(F.col("day") < F.lit(until).cast("timestamp_ntz"))
        found.append(merged.select(*columns, *(["day"] if period and days else own_day)))
    if chosen is not None:
        found = [part.join(chosen, "day") for part in found]
    rows = found[0] if found else spark.createDataFrame([], f"{schema}, day date" if own_day else schema)
    for part in found[1:]:
        rows = rows.unionByName(part)
    return rows if stored or days else rows.select(schemas.FACT_COLUMNS[table])

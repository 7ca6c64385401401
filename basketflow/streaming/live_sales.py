"""Sales reports that are kept up to date while log files land."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from basketflow.files import Files
from basketflow.functions import from_cents, in_cents, wide_cents
from basketflow.operators.decode import accepted, decode_lines
from basketflow.operators.dedupe import drop_copies_in_stream
from basketflow.operators.shred import items
from basketflow.session import stream_settings, temporary_settings
from basketflow.sinks import generations
from basketflow.sinks.generations import Unit
from basketflow.sinks.merge import runs_to_merge
from basketflow.sources import stream_log_lines
from basketflow.streaming.clock import clock_guard

TOTALS = "supermarket_id string, sku string, units bigint, refreshed_at timestamp, origin string, stream_id string, batch_id bigint"
FOLD_BASE_BYTES = 1 << 20
#: Changes to the report: a row for each pair whose units a refresh changed.
TABLE = "totals"
ORIGIN = "live"
KEYS = ["supermarket_id", "sku"]
#: Refreshes of one tier that are folded into one.
FAN = 8
KEEP_SECONDS = 600.0


def start_live_sales(
    spark: SparkSession,
    input_dir: str,
    report_path: str,
    checkpoint: str,
    *,
    horizon: str | None = "1 hour",
    lanes: int = 8,
    state_partitions: int | None = None,
    count_state: bool = True,
    trigger: dict | None = None,
    max_files: int | None = None,
    max_bytes: int | None = None,
    fan: int = FAN,
    keep_seconds: float = KEEP_SECONDS,
) -> StreamingQuery:
    """Running units by store and SKU: the state has a row for each pair that was sold.

    Prices are joined when the report is read, so it shows current prices as the batch report does,
    and the stream joins nothing. Rows are summed within each task before the shuffle, so a store or
    SKU with a third of all sales costs its reducer one row per task. Copies are dropped by the same
    rule and default as in the load.

    A refresh writes the pairs that changed, with their new units; a reader takes the last row of each pair. Refreshes are
    folded by size like the batches of a load (see ``merge``), and a fold becomes visible in one step, so the
    report stays about as large as its pairs and a refresh costs what it changes. A new checkpoint is a new
    query, whose report replaces the old one's with its first refresh.
    """
    records = decode_lines(stream_log_lines(spark, input_dir, max_files=max_files, max_bytes=max_bytes))
    check_clock = clock_guard(spark, checkpoint, horizon) if horizon else None
    if horizon:
        # What the report needs of a record; a refused one has no items, so it needs no place in the state.
        tx = F.struct(*[f"tx.{name}" for name in ("transaction_id", "supermarket_id", "items")])
        records = drop_copies_in_stream(accepted(records).select("tx_key", "arrived_at", tx.alias("tx")), horizon, lanes)
    totals = items(records, "supermarket_id").groupBy(*KEYS).agg(F.sum("quantity").alias("units"))

    def refresh(batch: DataFrame, batch_id: int) -> None:
        if check_clock:
            check_clock()
        session = batch.sparkSession
        query = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        folder = generations.load_folder(report_path, TABLE, ORIGIN, query, batch_id)
        batch.withColumn("refreshed_at", F.current_timestamp()).write.mode("overwrite").parquet(folder)
        _fold(session, report_path, query, batch_id, fan, keep_seconds)

    writer = (
        totals.writeStream.outputMode("update")
        .foreachBatch(refresh)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
    )
    with temporary_settings(spark, stream_settings(state_partitions, count_state)):
        return writer.start()


def _latest(changes: DataFrame) -> DataFrame:
    """The last row of each pair."""
    return changes.groupBy(*KEYS).agg(
        F.max_by("units", "batch_id").alias("units"), F.max("refreshed_at").alias("refreshed_at"), F.max("batch_id").alias("batch_id")
    )


def _fold(spark: SparkSession, report_path: str, query: str, batch_id: int, fan: int, keep_seconds: float) -> None:
    """Fold refreshes before this one where a tier is full; the one just written may have to be written again."""
    files = Files(spark, report_path)
    parts = [p for p in generations.parts(spark, report_path, [TABLE]) if p.stream_id == query and p.high < batch_id]
    if len(parts) < fan:
        return
    sizes = [p.size or files.size(generations.part_folder(report_path, p, TABLE)) for p in parts]
    groups = [parts[a:b] for a, b in runs_to_merge(sizes, FOLD_BASE_BYTES, fan)]
    if not groups:
        return
    # Older queries' reports have been replaced: with this fold they are no longer named, and their folders go later.
    generations.drop_replaced(spark, report_path, [TABLE], keep_seconds)
    now, units = generations.current(spark, report_path), []
    for group in groups:
        run = uuid.uuid4().hex
        unit = Unit(ORIGIN, query, group[0].low, group[-1].high, run, 0, [TABLE])
        folded = _latest(generations.read_parts(spark, report_path, TABLE, group, TOTALS))
        folded.withColumn("origin", F.lit(ORIGIN)).withColumn("stream_id", F.lit(query)).write.parquet(generations.unit_folder(report_path, unit, TABLE))
        units.append(replace(unit, size=files.size(generations.unit_folder(report_path, unit, TABLE))))
    gone = {part.run for group in groups for part in group if part.run}
    generations.publish(spark, report_path, now, [u for u in now.units if u.run not in gone and u.stream_id == query] + units)


def read_live_totals(spark: SparkSession, report_path: str) -> DataFrame:
    """Units by store and SKU as of the last refresh of the latest query."""
    files = Files(spark, report_path)
    parts = generations.parts(spark, report_path, [TABLE])
    # The query that refreshed last, by the time of its last folder.
    newest = max(parts, key=lambda p: files.modified(generations.part_folder(report_path, p, TABLE)), default=None)
    mine = [part for part in parts if newest is not None and part.stream_id == newest.stream_id]
    changes = generations.read_parts(spark, report_path, TABLE, mine, TOTALS) if mine else None
    if changes is None:
        return spark.createDataFrame([], "supermarket_id string, sku string, units bigint")
    return _latest(changes).select(*KEYS, "units")


def read_live_sales(spark: SparkSession, report_path: str, skus: DataFrame) -> DataFrame:
    """Units and sales by store at current prices; items without a known SKU do not count."""
    priced = skus.select("sku", in_cents(F.col("price")).alias("cents"))
    return (
        read_live_totals(spark, report_path)
        .join(priced, "sku")
        .groupBy("supermarket_id")
        .agg(F.sum("units").alias("units"), F.sum(wide_cents("units") * F.col("cents")).alias("cents"))
        .select("supermarket_id", "units", from_cents("cents").alias("sales"))
    )


def read_live_top_skus(spark: SparkSession, report_path: str, skus: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` SKUs that sold most pieces; ties go to the lower SKU."""
    units = read_live_totals(spark, report_path).groupBy("sku").agg(F.sum("units").alias("units"))
    named = units.join(skus.select("sku", "article_name"), "sku").select("sku", "article_name", "units")
    return named.orderBy(F.desc_nulls_last("units"), "sku").limit(k)

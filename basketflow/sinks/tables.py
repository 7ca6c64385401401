"""Writers for the fact folders and the CSV files.

Headers, details and refused lines of one load are written by one job in one pass over the
records: each record fans out to its header row and its item rows, and ``table`` is the first
partition column. So the source is parsed once and nothing is cached, and no failure can leave
the headers of a load committed by one job and its details missing because another did not run.

A load owns its partition (``origin``, ``stream_id``, ``batch_id``) and replaces it when it is
run again. Loads never touch each other's rows: running the historical job again keeps the live
ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from basketflow import schemas
from basketflow.functions import parse_local_time
from basketflow.session import temporary_settings
from basketflow.sinks import generations
from basketflow.sinks.generations import Unit
from basketflow.sinks.sketches import drop_sketch, write_sketch
from basketflow.workspace import path_exists

_NO_ITEM = "named_struct('sku', cast(null as string), 'quantity', cast(null as int))"


def fact_rows(records: DataFrame) -> DataFrame:
    """Records to the rows of all fact tables, tagged with ``table``.

    Position 0 of the fan-out stands for the header (or the refused line), the others are items.
    """
    kept = F.col("tx.transaction_id").isNotNull()
    fan_out = F.expr(f"concat(array({_NO_ITEM}), coalesce(tx.items, array()))")
    spread = records.withColumn(
        "transaction_date", parse_local_time(F.col("tx.transaction_date"))
    ).select("*", F.posexplode_outer(fan_out).alias("position", "item"))
    on_header = F.col("position") == 0
    return spread.where(on_header | F.col("item").isNotNull()).select(
        F.when(~kept, "rejects").when(on_header, "headers").otherwise("details").alias("table"),
        "tx_key",
        # The place of an item in its record, from 1.
        F.when(~on_header, F.col("position")).alias("position"),
        F.col("tx.transaction_id").alias("transaction_id"),
        F.when(on_header, F.col("tx.supermarket_id")).alias("supermarket_id"),
        "transaction_date",
        F.col("item.sku").alias("sku"),
        F.col("item.quantity").alias("quantity"),
        F.when(on_header, F.col("flags")).alias("flags"),
        "raw",
        "reason",
        # Details find their lineage through their header.
        F.when(on_header, F.col("source_file")).alias("source_file"),
        F.when(on_header, F.col("arrived_at")).alias("arrived_at"),
    )


def write_batch(rows: DataFrame, path: str, origin: str, stream_id: str, batch_id: int) -> None:
    """Write tagged fact rows as one load, replacing the rows of the same load if any."""
    drop_sketch(rows.sparkSession, path, Unit(origin, stream_id, batch_id, batch_id, "", 0).name)
    placed = (
        rows.withColumn("origin", F.lit(origin))
        .withColumn("stream_id", F.lit(stream_id))
        .withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    )
    # With a writer per table a task keeps its files open and need not sort its rows by table.
    writers = {"spark.sql.maxConcurrentOutputFileWriters": len(schemas.FACT_SCHEMAS)}
    with temporary_settings(rows.sparkSession, writers):
        (
            placed.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*schemas.PARTITION_COLUMNS)
            .parquet(path)
        )


def _empty_partition(spark: SparkSession, folder: str, table: str) -> None:
    """Overwrite a partition folder with no rows, if it is there."""
    if not path_exists(spark, folder):
        return
    columns = [f.split() for f in schemas.FACT_SCHEMAS[table].split(", ")]
    stored = [f"cast(null as {kind}) as {name}" for name, kind in columns if name not in schemas.PARTITION_COLUMNS]
    spark.range(0, 0, 1, 1).selectExpr(*stored).write.mode("overwrite").parquet(folder)


def _replace_load(records: DataFrame, path: str, origin: str, load_id: str, sketch: bool) -> dict[str, int]:
    """Write a whole load and empty the tables it no longer has rows for.

    A dynamic overwrite leaves a partition alone when the new rows have none for it, so refused
    lines of an earlier run would outlive their correction. The row counts come out of the write
    itself.
    """
    counts = Observation()
    rows = fact_rows(records).observe(
        counts, *[F.count_if(F.col("table") == name).alias(name) for name in schemas.FACT_SCHEMAS]
    )
    write_batch(rows, path, origin, load_id, 0)
    written = {name: counts.get.get(name) or 0 for name in schemas.FACT_SCHEMAS}
    for name, count in written.items():
        if count == 0:
            folder = f"{path}/table={name}/origin={origin}/stream_id={load_id}/batch_id=0"
            _empty_partition(records.sparkSession, folder, name)
    spark, load = records.sparkSession, Unit(origin, load_id, 0, 0, "", 0)
    # Rows laid out by date stand for the load as it was; from here on it is the new one, in one step.
    generations.release(spark, path, origin, load_id, 0)
    keys = generations.read_parts(spark, path, "headers", [load]) if sketch else None
    if keys is not None:
        write_sketch(spark, path, load.name, keys)
    return written


def overwrite_historical(records: DataFrame, path: str) -> dict[str, int]:
    """Replace the historical rows of all fact tables; returns the rows written to each."""
    return _replace_load(records, path, "historical", "batch", False)


def append_load(
    records: DataFrame, path: str, load_id: str, origin: str = "realtime", *, sketch: bool = False
) -> dict[str, int]:
    """Add a load to the fact tables; the same ``load_id`` again replaces it, not doubles it. ``sketch`` stores a sketch of its keys."""
    return _replace_load(records, path, origin, load_id, sketch)


def write_transactions_csv(transactions: DataFrame, path: str, compression: str = "none") -> None:
    """Export transactions with a nested ``items`` column; the list becomes JSON text."""
    (
        transactions.select(
            "transaction_id", "supermarket_id", "transaction_date", F.to_json("items").alias("items")
        )
        .write.option("compression", compression).option("header", True).option("quote", '"').option("escape", '"').csv(path)
    )


def write_skus_csv(skus: DataFrame, path: str) -> None:
    (
        skus.select("sku", F.col("article_name").alias("name of article"), F.col("price").cast("string"))
        .write.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    )


def write_supermarkets_csv(supermarkets: DataFrame, path: str) -> None:
    (
        supermarkets.select("supermarket_id", "supermarket_name")
        .write.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    )

"""Merging the many small folders of a stream into few.

A micro-batch writes a folder for each table, so a stream that runs for days leaves more folders than a
reader should list. ``merge_batches`` puts units of many batches in their place. Only batches that the checkpoint
has committed are merged: the stream never writes those again.

Units are merged by size. A tier holds sizes up to ``fan`` times those of the tier below; neighbours are merged when
``fan`` of them are in one tier, smaller ones between them included. The result is at least one tier higher, so a byte
is written again at most once for each tier: a logarithm of the stream's size, not once for each merge.

Rows of a unit are dealt by ranges of their date, so each file covers a narrow span and a report's dates
skip files by their statistics; with ``period`` they also lie in a folder for each day, week or month. A unit becomes
visible in one step, for all tables (see ``generations``); rows keep their batch number.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass, replace

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from basketflow import schemas
from basketflow.files import Files
from basketflow.sinks import generations
from basketflow.sinks.generations import Unit
from basketflow.sinks.sketches import drop_sketch, write_sketch

FILE_BYTES = 128 << 20
FAN = 4
#: The lowest tier ends here: smaller units are alike.
BASE_BYTES = 16 << 20
KEEP_SECONDS = 3600.0


@dataclass(frozen=True)
class Merged:
    """What a merge did: loads and units that went into others, and bytes read for it."""

    folders: int
    size: int


def tier(size: int, base: int, fan: int) -> int:
    return 0 if size <= base else 1 + int(math.log(size / base, fan))


def runs_to_merge(sizes: list[int], base: int, fan: int) -> list[tuple[int, int]]:
    """Which neighbours become one, as ranges of places, end exclusive.

    From the lowest tier up: a run of units of at most that tier with ``fan`` of it becomes one unit, which counts in the
    tiers above; so a range is written once, however many tiers it climbs."""
    units = [(at, at + 1, size) for at, size in enumerate(sizes)]
    level = 0
    while units and level <= max(tier(size, base, fan) for *_, size in units):
        out: list[tuple[int, int, int]] = []
        run: list[tuple[int, int, int]] = []
        for unit in [*units, None]:
            if unit is not None and tier(unit[2], base, fan) <= level:
                run.append(unit)
                continue
            if sum(tier(size, base, fan) == level for *_, size in run) >= fan:
                run = [(run[0][0], run[-1][1], sum(size for *_, size in run))]
            out += run + ([unit] if unit is not None else [])
            run = []
        units = out
        level += 1
    return [(a, b) for a, b, _ in units if b - a > 1]


def day_of(period: str) -> Column:
    """First day of the period a row's date is in."""
    return F.date_trunc(period, F.col("transaction_date")).cast("date")


def write_unit(spark: SparkSession, facts_path: str, parts: list[Unit], file_bytes: int, period: str | None) -> Unit:
    """Write the rows of parts as one unit, not visible yet."""
    run, tables = uuid.uuid4().hex, []
    for table in schemas.FACT_SCHEMAS:
        rows = generations.read_parts(spark, facts_path, table, parts)
        if rows is None:
            continue
        tables.append(table)
        size = sum(Files(spark, facts_path).size(generations.part_folder(facts_path, part, table)) for part in parts)
        # The key splits a time that a third of all rows may have.
        order = ["arrived_at", "raw"] if table == "rejects" else ["transaction_date", "tx_key"]
        count = max(1, -(-size // file_bytes))
        by_day = period is not None and table != "rejects"
        if by_day:
            rows = rows.withColumn("day", day_of(period))
            order = ["day", *order]
        dealt = rows.repartitionByRange(count, *order).sortWithinPartitions(*order)
        writer = dealt.write.partitionBy("day") if by_day else dealt.write
        writer.parquet(f"{generations.merged_root(facts_path)}/run={run}/table={table}")
    size = Files(spark, facts_path).size(f"{generations.merged_root(facts_path)}/run={run}")
    unit = Unit(parts[0].origin, parts[0].stream_id, parts[0].low, parts[-1].high, run, size, tables, period)
    if "headers" in tables:
        write_sketch(spark, facts_path, unit.name, spark.read.parquet(generations.unit_folder(facts_path, unit, "headers")))
    return unit


def _parts(spark: SparkSession, facts_path: str, origin: str, stream_id: str, up_to: int) -> list[Unit]:
    """Units and loads of a stream in order, with their sizes."""
    files, tables = Files(spark, facts_path), list(schemas.FACT_SCHEMAS)
    mine = [
        part for part in generations.parts(spark, facts_path, tables)
        if (part.origin, part.stream_id) == (origin, stream_id) and part.high <= up_to
    ]
    return [
        part if part.run else replace(part, size=sum(files.size(generations.part_folder(facts_path, part, table)) for table in tables))
        for part in mine
    ]


def _publish(spark: SparkSession, facts_path: str, groups: list[list[Unit]], file_bytes: int, period: str | None) -> Merged:
    now = generations.current(spark, facts_path)
    written = [write_unit(spark, facts_path, parts, file_bytes, period) for parts in groups]
    gone = {part.run for parts in groups for part in parts if part.run}
    generations.publish(spark, facts_path, now, [unit for unit in now.units if unit.run not in gone] + written)
    return Merged(sum(len(parts) for parts in groups), sum(part.size for parts in groups for part in parts))


def merge_batches(
    spark: SparkSession,
    facts_path: str,
    checkpoint: str,
    stream_id: str,
    *,
    file_bytes: int = FILE_BYTES,
    fan: int = FAN,
    base_bytes: int = BASE_BYTES,
    period: str | None = None,
    keep_seconds: float = KEEP_SECONDS,
) -> Merged:
    """Merge the folders of the stream's committed batches where a tier is full."""
    _tidy(spark, facts_path, keep_seconds)
    committed = [int(name) for name in Files(spark, checkpoint).names(f"{checkpoint}/commits") if name.isdigit()]
    if not committed:
        return Merged(0, 0)
    parts = _parts(spark, facts_path, "realtime", stream_id, max(committed))
    groups = [parts[a:b] for a, b in runs_to_merge([part.size for part in parts], base_bytes, fan)]
    return _publish(spark, facts_path, groups, file_bytes, period) if groups else Merged(0, 0)


def arrange_load(
    spark: SparkSession,
    facts_path: str,
    origin: str = "historical",
    load_id: str = "batch",
    *,
    period: str | None = "day",
    file_bytes: int = FILE_BYTES,
    keep_seconds: float = KEEP_SECONDS,
) -> Merged:
    """Lay the rows of one load out by date. Running the load again puts its new rows in their place."""
    _tidy(spark, facts_path, keep_seconds)
    parts = [part for part in _parts(spark, facts_path, origin, load_id, 0) if not part.run]
    return _publish(spark, facts_path, [parts], file_bytes, period) if parts else Merged(0, 0)


def _tidy(spark: SparkSession, facts_path: str, keep_seconds: float) -> None:
    """Remove what earlier merges replaced, and sketches of what is gone."""
    generations.drop_replaced(spark, facts_path, list(schemas.FACT_SCHEMAS), keep_seconds)
    drop_sketch(spark, facts_path, None)

"""Which folders hold the rows of the fact tables.

A load is visible as soon as its folder is: readers list the folders. A merge puts a *unit* in the place of
several loads; it is written under ``_merged``, which listings pass over, and becomes visible with the next *generation*:
a small numbered file that names all units. A generation appears by one rename, and readers take the one with the
highest number, so every reader sees either the loads or the unit, never neither or both. Two merges at a
time cannot both win: the second finds the number taken.

Folders that a generation replaces stay until ``drop_replaced`` finds it old enough, so a report that began before
it can finish.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession

from basketflow import schemas
from basketflow.files import Files

_GENERATIONS = "_generations"
_MERGED = "_merged"


@dataclass(frozen=True)
class Unit:
    """The rows of loads ``low`` to ``high`` of a stream, all tables of them."""

    origin: str
    stream_id: str
    low: int
    high: int
    run: str
    size: int
    tables: list[str] = field(default_factory=list)
    #: Length of the days the unit's rows are laid out by, None if they are not.
    period: str | None = None

    @property
    def name(self) -> str:
        """What the unit's sketch is called; a load is a unit of its own that no run wrote."""
        return f"run~{self.run}" if self.run else f"{self.origin}~{self.stream_id}~{self.low}"

    def covers(self, origin: str, stream_id: str, batch_id: int) -> bool:
        return (self.origin, self.stream_id) == (origin, stream_id) and self.low <= batch_id <= self.high


@dataclass(frozen=True)
class Generation:
    number: int
    units: list[Unit]


class GenerationTaken(RuntimeError):
    """Another merge has published in the meantime."""


def _numbers(files: Files, facts_path: str) -> list[int]:
    return sorted(int(name) for name in files.names(f"{facts_path}/{_GENERATIONS}") if name.isdigit())


def current(spark: SparkSession, facts_path: str) -> Generation:
    files = Files(spark, facts_path)
    numbers = _numbers(files, facts_path)
    if not numbers:
        return Generation(0, [])
    text = files.read(f"{facts_path}/{_GENERATIONS}/{numbers[-1]:012d}")
    return Generation(numbers[-1], [Unit(**unit) for unit in json.loads(text)])


def publish(spark: SparkSession, facts_path: str, after: Generation, units: list[Unit]) -> Generation:
    """Make these the units, in one step, if ``after`` is still the current generation."""
    files = Files(spark, facts_path)
    target = f"{facts_path}/{_GENERATIONS}/{after.number + 1:012d}"
    draft = f"{facts_path}/{_GENERATIONS}/.{uuid.uuid4().hex}"
    files.write(draft, json.dumps([asdict(unit) for unit in units]))
    if files.exists(target) or not files.move(draft, target):
        files.remove(draft)
        raise GenerationTaken(f"generation {after.number + 1} of {facts_path} is another merge's")
    return Generation(after.number + 1, units)


def unit_folder(facts_path: str, unit: Unit, table: str) -> str:
    return f"{facts_path}/{_MERGED}/run={unit.run}/table={table}"


def merged_root(facts_path: str) -> str:
    return f"{facts_path}/{_MERGED}"


def load_folder(facts_path: str, table: str, origin: str, stream_id: str, batch_id: int) -> str:
    return f"{facts_path}/table={table}/origin={origin}/stream_id={stream_id}/batch_id={batch_id}"


def loads(spark: SparkSession, facts_path: str, table: str) -> list[tuple[str, str, int]]:
    """Origin, stream and number of each load that has a folder of the table, merged ones included while they lie there."""
    files, found = Files(spark, facts_path), []
    root = f"{facts_path}/table={table}"
    for origin in files.names(root):
        for stream in files.names(f"{root}/{origin}") if origin.startswith("origin=") else []:
            for batch in files.names(f"{root}/{origin}/{stream}") if stream.startswith("stream_id=") else []:
                if batch.startswith("batch_id="):
                    found.append((origin.split("=", 1)[1], stream.split("=", 1)[1], int(batch.split("=", 1)[1])))
    return found


def part_folder(facts_path: str, part: Unit, table: str) -> str:
    if part.run:
        return unit_folder(facts_path, part, table)
    return load_folder(facts_path, table, part.origin, part.stream_id, part.low)


def parts(spark: SparkSession, facts_path: str, tables: list[str]) -> list[Unit]:
    """All that is stored now, by stream and number: units, and the loads that none covers."""
    now = current(spark, facts_path)
    found = {load for table in tables for load in loads(spark, facts_path, table)}
    alone = [Unit(*load, load[2], "", 0) for load in found if not any(unit.covers(*load) for unit in now.units)]
    return sorted([*now.units, *alone], key=lambda unit: (unit.origin, unit.stream_id, unit.low))


def read_parts(spark: SparkSession, facts_path: str, table: str, chosen: list[Unit], schema: str | None = None) -> DataFrame | None:
    """Rows of these loads and units with their load columns; nothing else is listed or read. None without folders."""
    files, schema = Files(spark, facts_path), schema or schemas.FACT_SCHEMAS[table]
    columns = [column.split()[0] for column in schema.split(", ")]
    rows = None
    kinds = (
        (f"{facts_path}/table={table}", [part for part in chosen if not part.run]),
        (merged_root(facts_path), [part for part in chosen if part.run and not part.period]),
        (merged_root(facts_path), [part for part in chosen if part.run and part.period]),
    )
    for root, kind in kinds:
        found = [folder for folder in (part_folder(facts_path, part, table) for part in kind) if files.exists(folder)]
        if found:
            read = spark.read.schema(schema).option("basePath", root).parquet(*found).select(columns)
            rows = read if rows is None else rows.unionByName(read)
    return rows


def release(spark: SparkSession, facts_path: str, origin: str, stream_id: str, batch_id: int) -> None:
    """Let a load's own folder count again, after it was written anew under a unit that covered it."""
    now = current(spark, facts_path)
    covering = [unit for unit in now.units if unit.covers(origin, stream_id, batch_id)]
    if any(unit.low != unit.high for unit in covering):
        raise ValueError(f"load {batch_id} of {stream_id} is merged with others and cannot be written again")
    if covering:
        publish(spark, facts_path, now, [unit for unit in now.units if unit not in covering])


def drop_replaced(spark: SparkSession, facts_path: str, tables: list[str], keep_seconds: float) -> int:
    """Remove folders that the current generation replaces, if it is older than ``keep_seconds``; also what merges
    that broke off have left. Returns how many."""
    files, now = Files(spark, facts_path), current(spark, facts_path)
    if not now.number or time.time() - files.modified(f"{facts_path}/{_GENERATIONS}/{now.number:012d}") < keep_seconds:
        return 0
    dropped = 0
    for table in tables:
        for origin, stream, batch in loads(spark, facts_path, table):
            if any(unit.covers(origin, stream, batch) for unit in now.units):
                files.remove(load_folder(facts_path, table, origin, stream, batch))
                dropped += 1
    kept = {f"run={unit.run}" for unit in now.units}
    for name in files.names(merged_root(facts_path)):
        if name not in kept:
            files.remove(f"{merged_root(facts_path)}/{name}")
            dropped += 1
    for number in _numbers(files, facts_path)[:-1]:
        files.remove(f"{facts_path}/{_GENERATIONS}/{number:012d}")
    return dropped

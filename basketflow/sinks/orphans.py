"""Items without a header, kept up to date load by load.

The audit of whole tables joins all items with all headers each time. Here its state is the items that are open: those
whose header has not come yet. A step reads the loads that are new since the last one, closes what their headers
answer, and looks in older loads only for new items that are still open, and there only where a sketch says that the
header may be. A step is written aside and becomes the state by its number, so one that breaks off is run again.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow import schemas
from basketflow.files import Files
from basketflow.operators.audit import without_parent
from basketflow.sinks import generations
from basketflow.sinks.generations import Unit
from basketflow.sinks.sketches import sketched_units, units_that_may_hold

_OPEN = "tx_key binary, position int, transaction_id string, sku string, quantity int"


def _steps(files: Files, state: str) -> list[int]:
    return sorted(int(name) for name in files.names(state) if name.isdigit() and files.exists(f"{state}/{name}/loads.json"))


def _columns() -> list[str]:
    return [column.split()[0] for column in _OPEN.split(", ")]


def open_items(spark: SparkSession, state: str) -> DataFrame:
    """Items without a header as of the last step."""
    files = Files(spark, state)
    steps = _steps(files, state)
    if not steps:
        return spark.createDataFrame([], _OPEN)
    return spark.read.schema(_OPEN).parquet(f"{state}/{steps[-1]:012d}/open")


def _audited(spark: SparkSession, state: str) -> list[tuple[str, str, int, int]]:
    files = Files(spark, state)
    steps = _steps(files, state)
    return [tuple(load) for load in json.loads(files.read(f"{state}/{steps[-1]:012d}/loads.json"))] if steps else []


def _only_new(rows: DataFrame | None, seen: list[tuple[str, str, int, int]]) -> DataFrame | None:
    """A merged unit may hold loads of earlier steps beside new ones."""
    if rows is None:
        return None
    for origin, stream, low, high in seen:
        old = (F.col("origin") == origin) & (F.col("stream_id") == stream) & F.col("batch_id").between(low, high)
        rows = rows.where(~F.coalesce(old, F.lit(False)))
    return rows


def audit_new_loads(spark: SparkSession, facts_path: str, state: str) -> DataFrame:
    """Take the loads that are new since the last step into the state; returns the items that are open now."""
    files, seen = Files(spark, state), _audited(spark, state)
    parts = generations.parts(spark, facts_path, list(schemas.FACT_SCHEMAS))

    def known(part: Unit) -> bool:
        return any((o, s) == (part.origin, part.stream_id) and low <= part.low and part.high <= high for o, s, low, high in seen)

    def overlaps(part: Unit) -> bool:
        return any((o, s) == (part.origin, part.stream_id) and low <= part.high and part.low <= high for o, s, low, high in seen)

    # A unit merged since may hold old loads and new ones: it is both.
    new, old = [p for p in parts if not known(p)], [p for p in parts if overlaps(p)]
    if not new:
        return open_items(spark, state)
    items = _only_new(generations.read_parts(spark, facts_path, "details", new), seen)
    headers = _only_new(generations.read_parts(spark, facts_path, "headers", new), seen)
    number = max(_steps(files, state), default=0) + 1
    folder = f"{state}/{number:012d}"
    if files.exists(folder):
        files.remove(folder)  # a step that broke off
    arrived = spark.createDataFrame([], _OPEN) if items is None else items.select(_columns())
    carried = open_items(spark, state)
    if headers is not None:
        arrived, carried = (without_parent(rows, headers.select("tx_key"), "tx_key") for rows in (arrived, carried))
    # Stored, as its keys are looked up in the sketches; few, where items come with or after their headers.
    arrived.write.parquet(f"{folder}/arrived")
    arrived = spark.read.schema(_OPEN).parquet(f"{folder}/arrived")
    sketched = sketched_units(spark, facts_path)
    may_hold = units_that_may_hold(spark, facts_path, arrived) if old and sketched else set()
    read = [p for p in old if p.name not in sketched or p.name in may_hold]
    earlier = generations.read_parts(spark, facts_path, "headers", read) if read else None
    if earlier is not None:
        arrived = without_parent(arrived, earlier.select("tx_key"), "tx_key")
    carried.unionByName(arrived).write.parquet(f"{folder}/open")
    loads = [(part.origin, part.stream_id, part.low, part.high) for part in parts]
    files.write(f"{folder}/loads.draft", json.dumps(loads))
    files.move(f"{folder}/loads.draft", f"{folder}/loads.json")
    return open_items(spark, state)

"""CSV files with line breaks inside fields, read by many tasks.

Spark reads such a file in one task, as only a reader from its start knows whether a line break lies in a field. Here
lines are read by splits like any text. A line begins a record where the number of quotes before it in the file is even:
each split counts its own quotes, a running sum over the splits of a file tells how each begins, and within its
split a line needs only those before it. Lines that belong to one record are put together in their task; a record that
crosses splits comes as fragments, two a split at most, which are joined afterwards.

Quotes inside quoted fields must be doubled, as the exports here write them. A single quote within an unquoted field
would turn the rest of its file around; a reader from the start would take it as text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_RECORDS = "value string, source_file string, block long, fragment int, head boolean, tail boolean"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Physical lines in the order of their split, which ``source_file`` and ``block`` name."""
    return spark.read.option("lineSep", "\n").text(path).select(
        "value",
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block"),
        ((F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))) % 2 == 1).alias("odd"),
    )


def _begins(lines: DataFrame) -> DataFrame:
    """Whether each split begins inside a field. One row for each split, so that a file's are summed in one task."""
    turns = lines.groupBy("source_file", "block").agg((F.count_if("odd") % 2).alias("turns"))
    before = Window.partitionBy("source_file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = (F.coalesce(F.sum("turns").over(before), F.lit(0)) % 2 == 1).alias("inside")
    return turns.select(F.col("source_file").alias("of_file"), F.col("block").alias("of_block"), inside)


def _glued(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines to records and, at the ends of a split, fragments: ``head`` ends a record begun before, ``tail`` does not end.

    A batch's lines are cut into lists where records end, and the lists joined, as whole columns; single strings are
    handled only for a record that crosses batches."""
    split, open_lines, in_head, parity = None, [], False, False
    schema = pa.schema([("value", pa.string()), ("source_file", pa.string()), ("block", pa.int64()), ("fragment", pa.int32()), ("head", pa.bool_()), ("tail", pa.bool_())])

    def rows(values: pa.Array, head: bool = False, tail: bool = False) -> pa.RecordBatch:
        n = len(values)
        columns = [
            values, pa.repeat(pa.scalar(split[0]), n), pa.repeat(pa.scalar(split[1], pa.int64()), n),
            # A split has one of each at most, the head first.
            pa.repeat(pa.scalar(2 if tail else 1, pa.int32()), n), pa.repeat(pa.scalar(head), n), pa.repeat(pa.scalar(tail), n),
        ]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    def glued_lines(tail: bool = False) -> pa.RecordBatch:
        return rows(pa.array(["\n".join(open_lines)], pa.string()), in_head, tail)

    for batch in batches:
        if not batch.num_rows:
            continue
        files, blocks = batch["source_file"], batch["block"]
        changed = pc.or_(pc.not_equal(files[1:], files[:-1]), pc.not_equal(blocks[1:], blocks[:-1])).to_numpy(zero_copy_only=False)
        bounds = [0, *(np.flatnonzero(changed) + 1).tolist(), batch.num_rows]
        for start, end in zip(bounds, bounds[1:]):
            here = (files[start].as_py(), blocks[start].as_py())
            if here != split:
                if open_lines:
                    yield glued_lines(tail=True)
                split, open_lines = here, []
                in_head = parity = batch["inside"][start].as_py()
            values = batch["value"].slice(start, end - start)
            odd = batch["odd"].slice(start, end - start).to_numpy(zero_copy_only=False).astype(np.int64)
            inside = (parity + np.cumsum(odd)) % 2
            parity = bool(inside[-1])
            ends = np.flatnonzero(inside == 0) + 1
            at = 0
            if len(ends) and (open_lines or in_head):
                open_lines.extend(values[: ends[0]].to_pylist())
                yield glued_lines()
                at, ends, open_lines, in_head = int(ends[0]), ends[1:], [], False
            if len(ends):
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[at], ends]), pa.int32()), values)
                yield rows(pc.binary_join(lists, "\n"))
                at = int(ends[-1])
            open_lines.extend(values[at:].to_pylist())
    if open_lines:
        yield glued_lines(tail=True)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Text of each record (``value``) with its ``source_file``; blank lines between records are left out."""
    lines = _lines(spark, path)
    begins = _begins(lines)
    # A row for each split of the input.
    placed = lines.join(F.broadcast(begins), (F.col("source_file") == F.col("of_file")) & (F.col("block") == F.col("of_block")))
    rows = placed.select("value", "source_file", "block", "odd", "inside").mapInArrow(_glued, _RECORDS)
    whole = rows.where(~F.col("head") & ~F.col("tail")).select("value", "source_file")
    # A tail without a head opens a record; the fragments up to the next one belong to it.
    in_file = Window.partitionBy("source_file").orderBy("block", "fragment")
    pieces = rows.where(F.col("head") | F.col("tail")).withColumn("record", F.sum((~F.col("head")).cast("int")).over(in_file))
    crossing = (
        pieces.groupBy("source_file", "record")
        .agg(F.array_sort(F.collect_list(F.struct("block", "fragment", "value"))).alias("pieces"))
        .select(F.array_join(F.transform("pieces", lambda p: p["value"]), "\n").alias("value"), "source_file")
    )
    return whole.unionByName(crossing).where(F.col("value") != "")

"""Compressed log files, each whole or not at all.

A file cut off while it was sent, or damaged, would stop the reader of a stream at the same place again and again, or
give the lines before the fault as if they were all. Here a compressed file is unpacked once to its end before its
first line is given; one that cannot be is a single row with the reason in ``unreadable``, so it is set
aside with the refused lines, the other files load, and a good copy that comes later is new in every line.
"""

from __future__ import annotations

import gzip
import io
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Names of compressed files, and of all others.
PACKED = "*.gz"
PLAIN = "{*[!z],*[!g]z,*[!.]gz,z,gz}"
BINARY = "path string, modificationTime timestamp, length long, content binary"
LINES = "value string, source_file string, unreadable string"
_CHUNK = 1 << 20
_LINES_IN_BATCH = 10_000


def _fault(content: bytes) -> str | None:
    """Why a file cannot be unpacked; read to its end, nothing kept."""
    try:
        with gzip.open(io.BytesIO(content)) as stream:
            while stream.read(_CHUNK):
                pass
    except (OSError, EOFError, zlib.error) as error:
        return f"{type(error).__name__}: {error}"
    return None


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["value", "source_file", "unreadable"]

    def rows(values: list, path: str, why: str | None) -> pa.RecordBatch:
        n = len(values)
        return pa.RecordBatch.from_arrays([pa.array(values, pa.string()), pa.array([path] * n), pa.array([why] * n, pa.string())], names=names)

    for batch in batches:
        for path, content in zip(batch["path"].to_pylist(), batch["content"]):
            data = content.as_py()
            if why := _fault(data):
                yield rows([None], path, why)
                continue
            lines: list[str] = []
            with gzip.open(io.BytesIO(data)) as stream:
                for line in stream:
                    lines.append(line.rstrip(b"\n").decode("utf-8", "replace"))
                    if len(lines) == _LINES_IN_BATCH:
                        yield rows(lines, path, None)
                        lines = []
            if lines:
                yield rows(lines, path, None)


def unpacked(files: DataFrame) -> DataFrame:
    """Binary files (``path``, ``content``) to their lines, or one row each with the reason that there are none."""
    return files.select("path", "content").mapInArrow(_unpacked, LINES)


def with_no_fault(lines: DataFrame) -> DataFrame:
    return lines.withColumn("unreadable", F.lit(None).cast("string"))

"""Moving the files of committed batches to the archive.

While a stream runs, Spark moves the files of a batch when a later one starts, so those of the last batch stay. The
closing pass moves what is left of committed batches once the stream has stopped. It looks at files that still lie in
the incoming folder only, so it can break off at any point and be run again.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote, urlparse

from pyspark.sql import SparkSession

from basketflow.files import Files


def committed_files(spark: SparkSession, checkpoint: str) -> set[str]:
    """Paths of the files that committed batches have read, from the checkpoint's own log."""
    files = Files(spark, checkpoint)
    commits = [int(name) for name in files.names(f"{checkpoint}/commits") if name.isdigit()]
    found: set[str] = set()
    for source in files.names(f"{checkpoint}/sources"):
        for entry in files.names(f"{checkpoint}/sources/{source}"):
            if not entry.removesuffix(".compact").isdigit():
                continue
            version, *lines = files.read(f"{checkpoint}/sources/{source}/{entry}").splitlines()
            found |= {
                unquote(urlparse(record["path"]).path)
                for record in map(json.loads, lines)
                if record["batchId"] <= max(commits, default=-1)
            }
    return found


def close_archive(spark: SparkSession, input_dir: str, checkpoint: str, archive_dir: str, threads: int = 8) -> int:
    """Move files of committed batches that are still in ``input_dir`` to the places that the running stream
    would give them; returns how many. The stream must not run meanwhile."""
    files, committed = Files(spark, input_dir), committed_files(spark, checkpoint)
    here = [path for path in files.below(input_dir) if path in committed]

    def move(path: str) -> bool:
        return files.move(path, archive_dir.rstrip("/") + path)

    with ThreadPoolExecutor(threads) as pool:
        moved = list(pool.map(move, here))
    if not all(moved):
        raise OSError(f"{moved.count(False)} files could not be moved to {archive_dir}; run the pass again")
    return len(moved)

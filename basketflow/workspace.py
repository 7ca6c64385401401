"""Where jobs put tables that several executors must see."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_local_roots: dict[str, str] = {}
_own_roots: set[str] = set()


def shared_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a session on one machine may do without it; it then gets a fresh temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="basketflow-")
    return _local_roots[app]


def _own_root(spark: SparkSession) -> str:
    """The application's folder below the shared root; it goes when the driver's JVM ends."""
    root = f"{shared_root(spark)}/basketflow-{spark.sparkContext.applicationId}"
    if root not in _own_roots:
        hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(root)
        files = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(hadoop_path)
        files.deleteOnExit(hadoop_path)
        _own_roots.add(root)
    return root


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared root that no other call will get.

    For tables that live as long as the application; results are written elsewhere.
    """
    return f"{_own_root(spark)}/{label}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder or file is there, on whatever file system the path names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)

"""Session settings for the jobs."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

JOB_SETTINGS = {
    # Times are zoneless; UTC keeps the arrival time free of clock changes too.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A load writes a file per table and task; larger splits mean larger files.
    "spark.sql.files.maxPartitionBytes": "256m",
    # Keys of a long horizon do not fit an executor's heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def job_session(name: str, **settings: str) -> SparkSession:
    """A session for spark-submit: master and sizes come from the cluster."""
    builder = SparkSession.builder.appName(name)
    for key, value in {**JOB_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def temporary_settings(spark: SparkSession, settings: dict[str, str | int | None]) -> Iterator[None]:
    """Change session settings for the length of a block; a value of None changes nothing."""
    changed = {key: value for key, value in settings.items() if value is not None}
    before = {key: spark.conf.get(key, None) for key in changed}
    for key, value in changed.items():
        spark.conf.set(key, str(value))
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


#: What a command or batch shuffled goes when it ends, not when the driver next collects garbage.
SHUFFLES_GO = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def stream_settings(state_partitions: int | None, count_state: bool = True) -> dict[str, str | int | None]:
    """Settings a stream takes over from the session when it starts.

    Old keys are dropped from the state along with the next rows. Spark would otherwise run a
    batch without rows after every batch just for that, and a file that lands meanwhile waits.
    The state is on disk whatever the session says: in the heap it fails as keys grow. A checkpoint that began with
    another store keeps it. ``count_state=False`` saves a lookup for each write, and progress does not tell how many
    rows the state has.
    """
    provider = "spark.sql.streaming.stateStore.providerClass"
    return {
        **SHUFFLES_GO,
        provider: JOB_SETTINGS[provider],
        "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": None if count_state else "false",
        "spark.sql.shuffle.partitions": state_partitions,
        "spark.sql.streaming.noDataMicroBatches.enabled": "false",
        # Rows that go to Python here are whole files.
        "spark.sql.execution.arrow.maxRecordsPerBatch": 4,
    }

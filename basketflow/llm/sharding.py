"""Two-pass external shuffle of a table into shards.

Pass one scatters the rows by seeded hashes into buckets small enough for one task's memory; pass two
shuffles each bucket (Fisher-Yates) and writes it. A shard is the concatenation of its buckets.

The law of the shards is ``key``: a row's key and the number of shards decide (rendezvous hashing),
so one more shard takes rows only into itself. Within its shard a row goes to a bucket by a hash of
its whole content and a seeded random salt, so that neither a key nor a copy that holds a large part
of the table overfills a bucket.

Defined results: null keys are one key; a null text has no bytes; repeated rows are rows like any
other, each with its own slot; an empty table gives no rows and empty files. Extra columns travel
inside the struct ``record`` and cannot clash with the columns of this module.

The input must come in the same order when a task is run again, as a scan of stored files does; a
table that comes straight out of a shuffle should be stored first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from basketflow.llm.base import table, text_of
from basketflow.workspace import new_folder

SHARDS = 16
SEED = 20_240_501
#: Bytes of text in a bucket, about: it grows with the table beyond so many buckets, up to what one task shuffles in memory.
BUCKET_BYTES = 8 << 20
BUCKETS = 8192
LARGEST_BUCKET = 128 << 20
#: What a row has besides its text, about.
ROW_BYTES = 64
#: More offsets than this are joined by a shuffle.
BROADCAST_BUCKETS = 1 << 16


def shard_of(key: Column, shards: int, seed: int = SEED) -> Column:
    """The shard whose seeded hash of the key is the largest."""
    draws = [F.struct(F.xxhash64(F.lit(seed), F.lit(i), key).alias("h"), F.lit(i).alias("i")) for i in range(shards)]
    return (F.greatest(*draws) if shards > 1 else draws[0])["i"]


def scatter(docs: DataFrame, *, key: str, shards: int, seed: int, bucket_bytes: int | None) -> tuple[DataFrame, int]:
    """Rows as ``(bucket, order, record)`` and the number of buckets; bucket b belongs to shard b % shards."""
    texts = F.octet_length(text_of()) if "text" in docs.columns else F.lit(0)
    (total,) = docs.agg(F.coalesce(F.sum(texts + ROW_BYTES), F.lit(0))).first()
    bucket_bytes = bucket_bytes or min(LARGEST_BUCKET, max(BUCKET_BYTES, total // BUCKETS))
    per_shard = max(1, -(-total // (shards * bucket_bytes)))
    content = F.xxhash64(F.lit(seed), *[F.col(f"`{name}`") for name in docs.columns])
    sub = F.pmod(F.xxhash64(content, F.rand(seed)), F.lit(per_shard)).cast("int")
    rows = docs.select(
        (sub * shards + shard_of(F.col(f"`{key}`"), shards, seed)).alias("bucket"),
        content.alias("order"),
        F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("record"),
    )
    return rows, per_shard * shards


def _shuffle_bucket(seed: int, shards: int):
    def shuffled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held)
        order = rows["order"].to_numpy()
        bucket = rows["bucket"][0].as_py()
        # Rows arrive in any order; from a fixed one the same seed gives the same permutation again.
        places = np.argsort(order, kind="stable")
        np.random.Generator(np.random.PCG64([seed, bucket])).shuffle(places)  # Fisher-Yates
        size = max(1, len(places) * (1 << 22) // max(1, rows.nbytes))
        for start in range(0, len(places), size):
            taken = rows.take(pa.array(places[start : start + size])).combine_chunks()
            n = taken.num_rows
            columns = [
                pa.array(np.full(n, bucket % shards, np.int32)),
                pa.array(np.full(n, bucket // shards, np.int32)),
                pa.array(np.arange(start, start + n, dtype=np.int64)),
                taken["record"].combine_chunks(),
            ]
            columns[-1] = columns[-1].chunk(0) if isinstance(columns[-1], pa.ChunkedArray) else columns[-1]
            yield pa.RecordBatch.from_arrays(columns, names=["shard", "bucket", "place", "record"])

    return shuffled


def write_shards(
    docs: DataFrame, path: str, *, key: str = "doc_id", shards: int = SHARDS, seed: int = SEED, bucket_bytes: int | None = None
) -> int:
    """Write ``docs`` as shards in random order under ``path/shard=N``; returns the number of buckets."""
    rows, buckets = scatter(docs, key=key, shards=shards, seed=seed, bucket_bytes=bucket_bytes)
    schema = T.StructType([
        T.StructField("shard", T.IntegerType()),
        T.StructField("bucket", T.IntegerType()),
        T.StructField("place", T.LongType()),
        T.StructField("record", docs.schema),
    ])
    (
        rows.repartitionById(buckets, F.col("bucket"))
        .mapInArrow(_shuffle_bucket(seed, shards), schema)
        .sortWithinPartitions("shard", "place")
        .write.partitionBy("shard")
        .parquet(path)
    )
    return buckets


def read_shards(spark: SparkSession, path: str, schema: T.StructType, buckets: int) -> DataFrame:
    """The written rows as ``(shard, slot, record)``; slots of a shard run from 0 without a gap."""
    files = T.StructType([
        T.StructField("bucket", T.IntegerType()),
        T.StructField("place", T.LongType()),
        T.StructField("record", schema),
        T.StructField("shard", T.IntegerType()),
    ])
    rows = spark.read.schema(files).parquet(path)
    sizes = rows.groupBy(F.col("shard").alias("s"), F.col("bucket").alias("b")).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("s").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("s", "b", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    starts = F.broadcast(starts) if buckets <= BROADCAST_BUCKETS else starts
    return rows.join(starts, (rows["shard"] == starts["s"]) & (rows["bucket"] == starts["b"])).select(
        "shard", (F.col("start") + F.col("place")).alias("slot"), "record"
    )


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = new_folder(spark, "shards")
    buckets = write_shards(docs, path)
    text = F.coalesce(F.col("record.text"), F.lit(""))
    return read_shards(spark, path, docs.schema, buckets).select(
        F.col("record.doc_id").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard",
        "slot",
        shard_of(F.col("record.doc_id"), SHARDS + 1).alias("grown_shard"),
    )

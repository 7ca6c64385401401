import zlib
from collections import Counter, defaultdict

import xxhash
from llm_tables import SMALL, nothing, odd, small  # noqa: F401
from pyspark.sql import functions as F

from basketflow.llm import sharding
from basketflow.workspace import new_folder


def written(spark, docs, **options):
    path = new_folder(spark, "test-shards")
    buckets = sharding.write_shards(docs, path, **options)
    return sharding.read_shards(spark, path, docs.schema, buckets), path


def test_query(spark):
    rows = sharding.op2_sharding(spark, SMALL).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.size == len(docs[r.doc_id].encode()) + 1
        assert r.grown_shard in (r.shard, 16)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert any(r.grown_shard == 16 for r in rows)


def rendezvous(key, shards):
    """The shard whose chained hash of seed, number and key is the largest; a null key leaves the hash as it is."""
    draws = []
    for i in range(shards):
        h = 42
        for raw in (sharding.SEED.to_bytes(4, "little"), i.to_bytes(4, "little"), b"" if key is None else key.to_bytes(8, "little", signed=True)):
            h = xxhash.xxh64_intdigest(raw, h) if raw else h
        draws.append((h - (1 << 64) if h >> 63 else h, i))
    return max(draws)[1]


def test_every_column_recomputed(spark, odd):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = {(r.doc_id, r.size, r.text_crc32, r.law, r.shard, r.grown_shard) for r in sharding.op2_sharding(spark, SMALL).collect()}
    want = set()
    for key, text in docs.items():
        raw = (text or "").encode()
        want.add((key, len(raw) + 1, zlib.crc32(raw), "key", rendezvous(key, 16), rendezvous(key, 17)))
    assert got == want
    rows, _ = written(spark, odd, shards=5, bucket_bytes=3000)
    assert all(r.shard == rendezvous(r.record.doc_id, 5) for r in rows.collect())


def test_rows_travel_whole(spark, odd):
    rows, _ = written(spark, odd, shards=3, bucket_bytes=2000)
    back = Counter(tuple(r.record) for r in rows.collect())
    assert back == Counter(tuple(r) for r in odd.collect())


def test_order_is_random_but_repeats(spark, small):
    def order(seed):
        rows, _ = written(spark, small, shards=2, seed=seed)
        return [r.record.doc_id for r in rows.orderBy("shard", "slot").collect()]

    first = order(1)
    assert first == order(1) != order(2)
    inversions = sum(a > b for a, b in zip(first, first[1:]))
    assert 0.35 < inversions / len(first) < 0.65


def test_hot_key_is_spread_over_buckets(spark):
    docs = spark.range(3000).select(F.lit(5).cast("long").alias("doc_id"), F.lit("the same text " * 20).alias("text"))
    rows, path = written(spark, docs, shards=4, bucket_bytes=50_000)
    stored = spark.read.parquet(path).groupBy("shard", "bucket").count().collect()
    assert len({r.shard for r in stored}) == 1 and max(r["count"] for r in stored) < 700
    slots = sorted(r.slot for r in rows.select("slot").collect())
    assert slots == list(range(3000))


def test_files_hold_the_shuffled_order(spark, small):
    _, path = written(spark, small, shards=1)
    for r in spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.collect_list("place").alias("p")).collect():
        assert r.p == sorted(r.p)


def test_buckets_grow_with_the_table(spark, small, monkeypatch):
    def buckets():
        return sharding.write_shards(small, new_folder(spark, "test-shards"), shards=2)

    monkeypatch.setattr(sharding, "BUCKET_BYTES", 1 << 10)
    many = buckets()
    monkeypatch.setattr(sharding, "BUCKETS", 16)
    assert 16 <= buckets() <= 20 < many
    monkeypatch.setattr(sharding, "LARGEST_BUCKET", 1 << 12)
    assert 16 < buckets() < many


def test_empty(spark, nothing):
    rows, _ = written(spark, nothing)
    assert rows.count() == 0

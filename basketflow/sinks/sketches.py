"""Sketches of the record keys of each load, to tell which loads a late copy may be in.

A sketch is a Bloom filter in segments: the hash of a key picks a segment and ``PROBES`` bits in it. Segments are rows
of 64-bit words, so filters of any size are built by a shuffle of the load's own keys and tested in parallel; a
test is a join of segments with the few new hashes that fall into them. At ``BITS_PER_KEY`` a key that is not there
passes with a probability of 3e-7, so a load is read only if it holds a copy, or by rare chance.

A sketch is written after its load and removed before the load is written again, so it never says less than what is
stored; a load without one is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.files import Files
from basketflow.sinks import generations

BITS_PER_KEY = 40
PROBES = 10
SEGMENT_BITS = 1 << 13
_WORDS = SEGMENT_BITS // 64
_ROOT = "_sketches"
_SCHEMA = "segments long, segment long, words array<long>, unit string"
#: New keys that are sent to every task of the test; more are joined by a shuffle.
BROADCAST_KEYS = 2_000_000


def _hash(key: Column) -> Column:
    return F.xxhash64(key)


def _places(hashed: Column) -> Column:
    """The bits of a key in its segment; the low bits of its hash pick the segment, others the bits."""
    step = F.shiftrightunsigned(F.xxhash64(hashed), 8).bitwiseOR(F.lit(1))
    start = F.shiftrightunsigned(hashed, 24)
    return F.transform(F.sequence(F.lit(0), F.lit(PROBES - 1)), lambda i: F.pmod(start + i * F.pmod(step, F.lit(SEGMENT_BITS)), F.lit(SEGMENT_BITS)).cast("int"))


def segments_of(keys: DataFrame, segments: int) -> DataFrame:
    """``segment, words`` of the column ``tx_key``. The keys are shuffled by segment, and the rest is done there."""
    hashed = keys.where(F.col("tx_key").isNotNull()).select(_hash(F.col("tx_key")).alias("h"))
    placed = hashed.withColumn("segment", F.pmod("h", F.lit(segments))).repartition("segment")
    bits = placed.select("segment", F.explode(_places(F.col("h"))).alias("bit"))
    words = bits.groupBy("segment", F.shiftright("bit", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, bit & 63)")).alias("bits"))
    lists = words.groupBy("segment").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("by_word"))
    every = F.transform(F.sequence(F.lit(0), F.lit(_WORDS - 1)), lambda w: F.coalesce(F.try_element_at("by_word", w), F.lit(0).cast("bigint")))
    return lists.select("segment", every.alias("words"))


def segments_for(keys: int) -> int:
    """A power of two, so that sketches come in few sizes."""
    need = max(1, -(-keys * BITS_PER_KEY // SEGMENT_BITS))
    return 1 << (need - 1).bit_length()


def write_sketch(spark: SparkSession, facts_path: str, unit: str, keys: DataFrame) -> None:
    """Store the sketch of a load or unit whose rows have the column ``tx_key``."""
    segments = segments_for(keys.select("tx_key").count())
    # A row that matches nothing marks the sketch of a load without keys.
    mark = spark.range(0, 1, 1, 1).select(F.lit(-1).cast("bigint").alias("segment"), F.array().cast("array<bigint>").alias("words"))
    rows = segments_of(keys, segments).unionByName(mark).select(F.lit(segments).cast("bigint").alias("segments"), "segment", "words")
    rows.coalesce(max(1, segments // 4096)).write.mode("overwrite").parquet(f"{facts_path}/{_ROOT}/unit={unit}")


def drop_sketch(spark: SparkSession, facts_path: str, unit: str | None) -> None:
    """Remove a unit's sketch; with None those of all units that are no longer current."""
    files = Files(spark, facts_path)
    if unit is not None:
        if files.exists(f"{facts_path}/{_ROOT}/unit={unit}"):
            files.remove(f"{facts_path}/{_ROOT}/unit={unit}")
        return
    names = files.names(f"{facts_path}/{_ROOT}")
    if names:
        stored = {f"unit={part.name}" for part in generations.parts(spark, facts_path, ["headers"])}
        for name in names:
            if name not in stored:
                files.remove(f"{facts_path}/{_ROOT}/{name}")


def units_that_may_hold(spark: SparkSession, facts_path: str, keys: DataFrame) -> set[str]:
    """Sketched units that may hold one of the keys. Their number is bounded by that of the units."""
    names = Files(spark, facts_path).names(f"{facts_path}/{_ROOT}")
    if not names:
        return set()
    sketches = spark.read.schema(_SCHEMA).parquet(f"{facts_path}/{_ROOT}")
    sizes = [row.segments for row in sketches.select("segments").distinct().collect()]
    hashed = keys.where(F.col("tx_key").isNotNull()).select(_hash(F.col("tx_key")).alias("h")).distinct()
    asked = (
        hashed.withColumn("of", F.explode(F.array(*[F.lit(size).cast("bigint") for size in sizes])))
        .groupBy("of", F.pmod("h", "of").alias("at"))
        .agg(F.collect_list("h").alias("hashes"))
    )
    if hashed.count() <= BROADCAST_KEYS:
        asked = F.broadcast(asked)
    met = sketches.join(asked, (F.col("segments") == F.col("of")) & (F.col("segment") == F.col("at")))

    def inside(hashed_key: Column) -> Column:
        return F.forall(
            _places(hashed_key),
            lambda bit: F.call_function("getbit", F.get("words", F.shiftright(bit, 6)), bit.bitwiseAND(F.lit(63))) == 1,
        )

    return {row.unit for row in met.where(F.exists("hashes", inside)).select("unit").distinct().collect()}


def sketched_units(spark: SparkSession, facts_path: str) -> set[str]:
    return {name.split("=", 1)[1] for name in Files(spark, facts_path).names(f"{facts_path}/{_ROOT}") if name.startswith("unit=")}

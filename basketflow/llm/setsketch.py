"""Near-duplicate documents by SetSketch registers.

A document's set holds the hashes of its word 4-shingles. Each of ``m`` registers keeps, over the set, the least of
exponential draws, stored as a truncated logarithm: ``floor(1 - log_b(least))`` within ``0..q+1``. Registers of a
union are the larger of two, value by value, so sketches merge; and two sketches agree in a register with a
probability that rises with the similarity of the sets. Equal sets are one node. Register values are banded;
the number of bands is the least that reaches the target recall at the threshold, for any two set sizes.

Nodes that share a band are compared by the joint likelihood of their registers: with the set sizes known, the
numbers of registers that are larger, smaller and equal have a likelihood for each similarity, and a pair is
dropped only if its best similarity lies below the threshold and explains the registers far better than the
threshold does. What is left is verified on the full sets, in whole numbers.

Only components are asked for, so a pair within one component needs no look. Buckets are resolved in two steps:

1. every node meets the smallest node of each of its buckets; of those that pass the likelihood, the smallest and the
   likeliest are verified. Copies of one text fall into few components here, at two pairs a node;
2. buckets that still hold several components are dealt into blocks, and every pair of a bucket that is in
   different components and passes the likelihood is verified within the task of its two blocks. Nothing is
   emitted but a spanning forest. Sets are sent only for nodes that have such a pair.

No task holds more than two blocks, cut by count and by bytes, whatever the size of a bucket.

Defined results: words end at ASCII white space, A to Z are lower-cased; fewer than ``N`` words make one shingle of
all of them; no words (null, empty, blanks) make an empty set, linked with nothing, copies included. Repeated rows
are copies. Ids that are null are not the smallest of a component unless all are; ``kept`` compares them as
equal. An empty table gives no rows. Only id and text are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketflow.llm.base import small_batches, stored, table, text_of
from basketflow.llm.bytehash import LOWER, U64, flat, mixed, parts, token_hashes, words
from basketflow.llm.components import components

N = 4
#: Similarity as a fraction of whole numbers.
THRESHOLD = (4, 5)
RECALL = 0.99999
#: Base of the register values, and the largest of them. Two unrelated sets agree in a register with a probability of
#: about (base - 1) / 4, so four registers hold 1 / 2.5e14 of all nodes together; a base of 1.2 holds 1 / 2.3e5, too many.
BASE = 1.001
LARGEST = 65_535
REGISTER = np.dtype("<u2")
ROWS = 4
#: Rate of the exponential draws: keeps registers of single shingles above zero.
RATE = 20.0
SEED = 2_027
#: Log-likelihood by which the best similarity must beat the threshold before a pair is dropped unverified.
MARGIN = 14.0
#: Nodes of a block, and bytes of their sets.
BLOCK = 256
BLOCK_BYTES = 16 << 20
SLICE_BYTES = 2 << 20
PAIRS_AT_ONCE = 100_000
#: Nodes whose texts are picked out by a broadcast (64 bytes each); beyond, by a shuffle.
BROADCAST = 200_000

_STEP = (BASE - 1) / BASE
_LOG = math.log(BASE)


def larger(x: np.ndarray | float) -> np.ndarray:
    """Probability that one sketch's register is the larger, where its set alone holds the share ``x`` of the union
    as seen from the other: ``-log_b(1 - x (b - 1) / b)``."""
    return -np.log1p(-np.asarray(x, float) * _STEP) / _LOG


def agreement(similarity: float) -> float:
    """The least probability that two sets of this similarity agree in a register, over all ratios of sizes."""
    share = np.linspace(similarity / (1 + similarity), 0.5, 200)
    return float((1 - larger(np.maximum(0, share - (1 - share) * similarity)) - larger(1 - share - share * similarity)).min())


def bands_for(similarity: float, rows: int = ROWS, recall: float = RECALL) -> int:
    """The fewest bands of ``rows`` registers that two such sets share one of with at least this probability."""
    return math.ceil(math.log(1 - recall) / math.log(1 - agreement(similarity) ** rows))


BANDS = bands_for(THRESHOLD[0] / THRESHOLD[1])
REGISTERS = BANDS * ROWS


def shingles(texts: pa.Array, n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted, text after text, and where each text's start."""
    data, offsets = flat(texts)
    data = LOWER[data]
    starts, ends, first = words(data, offsets)
    hashed = token_hashes(data, starts, ends)
    counts = np.diff(first)
    sizes = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    begin = np.concatenate([[0], np.cumsum(sizes)])
    owner = np.repeat(np.arange(len(counts)), sizes)
    at = np.repeat(first[:-1] - begin[:-1], sizes) + np.arange(begin[-1])
    out = np.zeros(len(at), U64)
    last = np.repeat(first[1:], sizes)
    for k in range(n):
        if len(hashed):
            inside = at + k < last  # only a short text has a shingle with fewer words
            out = mixed(out * U64(3) + np.where(inside, hashed[np.minimum(at + k, len(hashed) - 1)], U64(k)))
    order = np.lexsort((out, owner))
    out, owner = out[order], owner[order]
    new = np.ones(len(out), bool)
    new[1:] = (out[1:] != out[:-1]) | (owner[1:] != owner[:-1])
    out, owner = out[new], owner[new]
    return out, np.searchsorted(owner, np.arange(len(counts) + 1))


def _draws() -> np.ndarray:
    return np.random.Generator(np.random.PCG64(SEED)).integers(1, 1 << 63, REGISTERS, dtype=np.int64).astype(U64) | U64(1)


def registers(hashes: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Registers of the non-empty sets, a row each."""
    out = np.zeros((len(begin) - 1, REGISTERS), REGISTER)
    full = np.flatnonzero(np.diff(begin))
    if len(full):
        for k, draw in enumerate(_draws()):
            least = np.minimum.reduceat(mixed(hashes ^ draw), begin[full])
            # A uniform number as an exponential one; the logarithm of both is monotone, so the least comes first.
            drawn = -np.log1p(-(least.astype(np.float64) + 0.5) * 2.0**-64)
            out[full, k] = np.clip(np.floor(1 - np.log(drawn / RATE) / _LOG), 0, LARGEST)
    return out


def _fingerprints(hashes: np.ndarray, begin: np.ndarray) -> list[bytes | None]:
    """128 bits of each set; none for an empty one."""
    full = np.flatnonzero(np.diff(begin))
    out: list[bytes | None] = [None] * (len(begin) - 1)
    if len(full):
        one = np.add.reduceat(mixed(hashes ^ U64(0x5851F42D4C957F2D)), begin[full])
        two = np.add.reduceat(mixed(hashes + U64(0x14057B7EF767814F)), begin[full])
        for i, pair in zip(full, np.stack([one, two], axis=1)):
            out[i] = pair.astype(">u8").tobytes()
    return out


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in parts(batch, "t", SLICE_BYTES):
            hashes, begin = shingles(part["t"])
            nodes = _fingerprints(hashes, begin)
            sketch = [row.tobytes() for row in registers(hashes, begin)]
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"], part["of"], pa.array(nodes, pa.binary()), pa.array(np.diff(begin).astype(np.int64)), pa.array(sketch, pa.binary())],
                names=["doc_id", "of", "node", "size", "sketch"],
            )


def text_key() -> Column:
    return F.md5(F.encode(text_of(), "UTF-8"))


def sketches(docs: DataFrame) -> DataFrame:
    """``doc_id, of, node, size, sketch`` of every document: its text's key, its set's fingerprint, size and registers."""
    small_batches(docs.sparkSession)
    schema = T.StructType([
        docs.schema["doc_id"], T.StructField("of", T.StringType()), T.StructField("node", T.BinaryType()),
        T.StructField("size", T.LongType()), T.StructField("sketch", T.BinaryType()),
    ])
    return docs.select("doc_id", text_key().alias("of"), text_of().alias("t")).mapInArrow(_sketched, schema)


def merged(one: bytes, other: bytes) -> bytes:
    """The sketch of the union of two sets."""
    return np.maximum(np.frombuffer(one, REGISTER), np.frombuffer(other, REGISTER)).tobytes()


def plausible(size: np.ndarray, other_size: np.ndarray, more: np.ndarray, less: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs may reach the threshold, and their likeliest similarity.

    ``more`` and ``less`` count the registers in which the first sketch is the larger, the smaller. The likelihood is
    taken on a grid; the sizes are known, and allow no similarity above the smaller by the larger."""
    size, other_size = size.astype(float), other_size.astype(float)
    share = size / (size + other_size)
    most = np.minimum(size, other_size) / np.maximum(size, other_size)
    at = THRESHOLD[0] / THRESHOLD[1]

    def likelihood(similarity: np.ndarray) -> np.ndarray:
        up = np.clip(larger(np.maximum(0, share - (1 - share) * similarity)), 1e-9, 1)
        down = np.clip(larger(np.maximum(0, 1 - share - share * similarity)), 1e-9, 1)
        even = np.clip(1 - up - down, 1e-9, 1)
        return more * np.log(up) + less * np.log(down) + (REGISTERS - more - less) * np.log(even)

    best, likeliest = np.full(len(size), -np.inf), np.zeros(len(size))
    for point in np.linspace(0, 1, 41):
        value = likelihood(np.minimum(point, most))
        better = value > best
        best[better], likeliest[better] = value[better], np.minimum(point, most)[better]
    reachable = THRESHOLD[1] * np.minimum(size, other_size) >= THRESHOLD[0] * np.maximum(size, other_size)
    return reachable & ((likeliest >= at) | (best - likelihood(np.full(len(size), at)) < MARGIN)), likeliest


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sketch = np.frombuffer(b"".join(batch["sketch"].to_pylist()), REGISTER).reshape(batch.num_rows, BANDS, ROWS)
        keys = np.zeros((batch.num_rows, BANDS), U64)
        for k in range(ROWS):
            keys = mixed(keys * U64(5) + sketch[:, :, k].astype(U64))
        keys = mixed(keys + np.arange(1, BANDS + 1, dtype=U64)[None, :] * U64(0x9E3779B97F4A7C15))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * BANDS), pa.array(keys.reshape(-1).view(np.int64)))
        yield pa.RecordBatch.from_arrays([batch["node"], lists], names=["node", "keys"])


def buckets(nodes: DataFrame) -> DataFrame:
    """``(node, key)`` for each band of each node."""
    schema = T.StructType([T.StructField("node", T.BinaryType()), T.StructField("keys", T.ArrayType(T.LongType()))])
    return nodes.select("node", "sketch").mapInArrow(_banded, schema).select("node", F.explode("keys").alias("key"))


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs that pass the likelihood, with their likeliest similarity."""
    for batch in batches:
        one, two = (np.frombuffer(b"".join(batch[c].to_pylist()), REGISTER).reshape(batch.num_rows, REGISTERS) for c in ("a_sketch", "b_sketch"))
        passes, likeliest = plausible(batch["a_size"].to_numpy(), batch["b_size"].to_numpy(), (one > two).sum(axis=1), (one < two).sum(axis=1))
        kept = pa.array(np.flatnonzero(passes))
        yield pa.RecordBatch.from_arrays([batch["a"].take(kept), batch["b"].take(kept), pa.array(likeliest[passes])], names=["a", "b", "likeliest"])


_PAIRS = T.StructType([T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType()), T.StructField("likeliest", T.DoubleType())])


def leaders(nodes: DataFrame, shared: DataFrame) -> DataFrame:
    """``(a, b)``: for each node the smallest and the likeliest of its buckets' first nodes that pass."""
    pairs = shared.filter("node <> first").select(F.col("node").alias("a"), F.col("first").alias("b")).distinct()
    sized = nodes.select("node", "size", "sketch")
    side = {s: sized.select(F.col("node").alias(s), F.col("size").alias(f"{s}_size"), F.col("sketch").alias(f"{s}_sketch")) for s in "ab"}
    passed = pairs.join(side["a"], "a").join(side["b"], "b").mapInArrow(_judged, _PAIRS)
    chosen = passed.groupBy("a").agg(F.min("b").alias("smallest"), F.max_by("b", F.struct("likeliest", "b")).alias("nearest"))
    return chosen.select("a", F.explode(F.array_distinct(F.array("smallest", "nearest"))).alias("b"))


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in parts(batch, "t", SLICE_BYTES):
            hashes, begin = shingles(part["t"])
            lists = pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(hashes.view(np.int64)))
            yield pa.RecordBatch.from_arrays([part["node"], lists], names=["node", "shingles"])


def sets_of(docs: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(node, shingles)``: the full sets of the wanted nodes, from the text of one document each."""
    schema = T.StructType([T.StructField("node", T.BinaryType()), T.StructField("shingles", T.ArrayType(T.LongType()))])
    chosen = stored(
        nodes.join(wanted.select("node").distinct(), "node", "left_semi").select("node", F.col("sample.of").alias("text_of"), F.col("sample.doc_id").alias("of_id")),
        "chosen-texts",
    )
    if chosen.count() <= BROADCAST:
        chosen = F.broadcast(chosen)
    texts = docs.select("doc_id", text_key().alias("of"), text_of().alias("t"))
    met = texts.join(chosen, (F.col("of") == F.col("text_of")) & F.col("doc_id").eqNullSafe(F.col("of_id")))
    rows = met.select("node", "t").dropDuplicates(["node"])
    return stored(rows.mapInArrow(_listed, schema), "shingle-sets")


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets reach the threshold."""
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("a_set"))
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("b_set"))
    met = pairs.join(one, "a").join(two, "b")
    both = F.size(F.array_intersect("a_set", "b_set")).cast("long")
    union = F.size("a_set").cast("long") + F.size("b_set") - F.col("both")
    return met.withColumn("both", both).filter(THRESHOLD[1] * F.col("both") >= THRESHOLD[0] * union).select("a", "b")


def _open_buckets(shared: DataFrame, labels: DataFrame, nodes: DataFrame) -> DataFrame:
    """Members of buckets that hold several components: ``key, node, label, size, sketch, blocks``."""
    labelled = shared.select("node", "key").join(labels, "node")
    found = labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high")
    members = labelled.join(found.select("key"), "key").join(nodes.select("node", "size", "sketch"), "node")
    members = stored(members, "open-buckets")
    sizes = members.groupBy("key").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("size") * 8 / BLOCK_BYTES)).cast("int").alias("blocks")
    )
    return members.join(sizes, "key")


def _dealt(members: DataFrame) -> DataFrame:
    """Each member to every pair of blocks that its block is in; a pair's members lie together in one task."""
    return (
        members.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .drop("other")
        .repartition("key", "low", "high")
        .sortWithinPartitions("key", "low", "high")
    )


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups (rows of one key, low and high) and where each group starts and the last ends."""
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        rows = rows if rest is None else pa.concat_tables([rest, rows])
        starts = _group_starts(rows)
        if starts[-1]:
            yield rows.slice(0, starts[-1]).combine_chunks(), starts
        rest = rows.slice(starts[-1])
    if rest is not None:
        yield rest.combine_chunks(), np.array([0, rest.num_rows])


def _group_starts(rows: pa.Table) -> np.ndarray:
    of = np.stack([rows[c].to_numpy().astype(np.int64) for c in ("key", "low", "high")])
    return np.append(0, np.flatnonzero((of[:, 1:] != of[:, :-1]).any(axis=0)) + 1)


def _open_pairs(group: pa.Table, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of a group that must be compared: of different components, of both blocks if there are two, in
    no earlier band together, and passing the likelihood. A few at a time."""
    count = group.num_rows
    sketch = np.frombuffer(b"".join(group["sketch"].to_pylist()), REGISTER).reshape(count, REGISTERS)
    block, size, low, high = (group[c].to_numpy() for c in ("block", "size", "low", "high"))
    label = np.unique(np.array(group["label"].to_pylist(), "S16"), return_inverse=True)[1]
    banded = sketch.reshape(count, BANDS, ROWS)
    of = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    # The first band that a whole group agrees in is its own, or an earlier one; then pairs are looked at twice.
    alike = (banded == banded[starts[:-1]][of]).all(axis=2)
    own = np.logical_and.reduceat(alike, starts[:-1], axis=0).argmax(axis=1)[of]
    later = starts[1:][of] - np.arange(count) - 1
    upto, begin = np.cumsum(later), 0
    while begin < count:
        before = upto[begin] - later[begin]
        end = max(begin + 1, int(np.searchsorted(upto, before + PAIRS_AT_ONCE, "right")))
        i = np.repeat(np.arange(begin, end), later[begin:end])
        j = i + 1 + np.arange(len(i)) - np.repeat(upto[begin:end] - later[begin:end] - before, later[begin:end])
        asked = (label[i] != label[j]) & ((low[i] == high[i]) | (block[i] != block[j]))
        i, j = i[asked], j[asked]
        earlier = ((banded[i] == banded[j]).all(axis=2) & (np.arange(BANDS)[None, :] < own[i][:, None])).any(axis=1)
        i, j = i[~earlier], j[~earlier]
        passes, _ = plausible(size[i], size[j], (sketch[i] > sketch[j]).sum(axis=1), (sketch[i] < sketch[j]).sum(axis=1))
        yield i[passes], j[passes]
        begin = end


def _needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The members that have a pair to be verified."""
    for group, starts in _whole_groups(batches):
        marked = np.zeros(group.num_rows, bool)
        for i, j in _open_pairs(group, starts):
            marked[i] = marked[j] = True
        yield from group.select(["node", "key"]).filter(pa.array(marked)).to_batches()


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A spanning forest of the pairs whose full sets reach the threshold."""
    for group, starts in _whole_groups(batches):
        label = np.unique(np.array(group["label"].to_pylist(), "S16"), return_inverse=True)[1]
        parent = list(range(int(label.max()) + 1))

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        lists = group["shingles"].combine_chunks()
        values, at = lists.flatten().to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
        names, edges = group["node"].to_pylist(), []
        for firsts, seconds in _open_pairs(group, starts):
            for i, j in zip(firsts.tolist(), seconds.tolist()):
                one, two = root(label[i]), root(label[j])
                if one != two:
                    a, b = values[at[i] : at[i + 1]], values[at[j] : at[j + 1]]
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    if THRESHOLD[1] * both >= THRESHOLD[0] * (len(a) + len(b) - both):
                        parent[max(one, two)] = min(one, two)
                        edges.append((names[i], names[j]))
        yield pa.RecordBatch.from_arrays([pa.array([e[k] for e in edges], pa.binary()) for k in (0, 1)], names=["a", "b"])


def _labels(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``(node, label)``: the component of every node under these edges."""
    roots = components(edges).select(F.col("node").alias("of"), "root")
    return nodes.select("node").join(roots, F.col("node") == F.col("of"), "left").select("node", F.coalesce("root", "node").alias("label"))


def links(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``(a, b)``: verified links that span the components."""
    keyed = buckets(nodes)
    often = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("first")).filter("n > 1")
    shared = stored(keyed.join(often.select("key", "first"), "key"), "shared-bands")
    pairs = stored(leaders(nodes, shared), "leader-pairs")
    ends = pairs.select(F.col("a").alias("node")).unionAll(pairs.select(F.col("b").alias("node")))
    sets = sets_of(docs, nodes, ends)
    found = stored(linked(pairs, sets), "leader-links")
    labels = stored(_labels(shared.select("node").distinct(), found), "labels")

    members = stored(_open_buckets(shared, labels, nodes), "open-members")
    needed_schema = T.StructType([T.StructField("node", T.BinaryType()), T.StructField("key", T.LongType())])
    needed = stored(_dealt(members).mapInArrow(_needed, needed_schema).distinct(), "open-nodes")
    left = sets_of(docs, nodes, needed)
    again = members.join(needed, ["node", "key"], "left_semi").join(left, "node")
    edge_schema = T.StructType([T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType())])
    rest = _dealt(again).mapInArrow(_joined, edge_schema)
    return found.unionAll(rest)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per document ``doc_id, n_shingles, component_id, kept``."""
    docs = docs.select("doc_id", "text")
    known = stored(sketches(docs), "sketches")
    sample = F.min(F.struct("doc_id", "of")).alias("sample")
    nodes = known.filter("node is not null").groupBy("node").agg(
        sample, F.min("doc_id").alias("first_id"), F.first("size").alias("size"), F.first("sketch").alias("sketch")
    )
    nodes = stored(nodes, "nodes")
    labels = stored(_labels(nodes, links(docs, nodes)).join(nodes.select("node", "first_id"), "node"), "components")
    heads = labels.groupBy(F.col("label").alias("of")).agg(F.min("first_id").alias("head"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    heads = stored(heads.select("of", "head", F.lit(True).alias("several")), "component-heads")
    if heads.count() <= BROADCAST:
        heads = F.broadcast(heads)
    head = F.when(F.col("several"), F.col("head")).otherwise(F.col("first_id"))
    component_of = labels.join(heads, F.col("label") == F.col("of"), "left").select(F.col("node").alias("of_node"), head.alias("head"))
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("head"))
    return known.select("doc_id", "node", "size").join(component_of, F.col("node") == F.col("of_node"), "left").select(
        "doc_id", F.col("size").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def op12_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))

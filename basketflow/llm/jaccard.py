"""Join of documents on the Jaccard similarity of their word n-grams, by MinHash banding.

Equal texts are one node of the graph, so copies are never paired. Each node has ``bands`` hashes over
``rows`` minima; the counts are the fewest hashes that reach the target recall at the threshold. Nodes
are shuffled on their band hashes; a bucket's nodes are joined to its smallest (a star, not all pairs),
and the components of the stars are the candidate groups. Groups are dealt into blocks, by count and by
bytes, and a task counts the links within one block or between two as a matrix product over the full
n-gram sets. Pairs are counted, not emitted: a task returns each node's number of links and a
spanning forest, and the components of the forests are the classes. No link found is lost, whatever the
size of a group, and no task holds more than two blocks.

A group of several blocks is compared in one of two ways, whichever sends fewer rows; both look at all pairs
that share a band. A dense group is dealt by hash, and all its blocks meet. Half-similar texts chain together
into large, loose groups; their blocks are neighbourhoods (nodes with the same smallest node in their
buckets), and only blocks that share a band meet.

A link is a similarity of at least ``THRESHOLD`` between different texts, compared in whole numbers.

Defined results: n-grams are runs of ``N`` words as they stand; a text of fewer words is one n-gram of
all of them; a text without words (null, empty, blanks) has no links, and equal ones are still copies.
Repeated rows are copies. Null ids are ids; a class whose ids are all null has the id null. An empty
table gives no rows. Only id and text are read, except by ``one_of_each``, which keeps all columns.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketflow.llm.base import fresh, small_batches, stored, table, text_of
from basketflow.llm.bytehash import U64, flat, mixed, parts, token_hashes, words
from basketflow.llm.components import components

N = 5
#: Similarity as a fraction of whole numbers.
THRESHOLD = (4, 5)
RECALL = 0.99999
MOST_HASHES = 128
SEED = 1_117
#: Nodes of a block, and bytes of their n-gram sets.
BLOCK = 128
BLOCK_BYTES = 8 << 20
SLICE_BYTES = 2 << 20
#: Candidate nodes beyond which their texts are fetched by a shuffle.
BROADCAST = 250_000


def banding(similarity: float, recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """Bands and rows: the most rows (fewest false candidates) that reach the recall within ``most`` hashes."""
    for rows in range(12, 0, -1):
        bands = max(1, math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows)))
        if bands * rows <= most:
            return bands, rows
    raise ValueError("no banding reaches the recall")


def grams(texts: pa.Array, n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of each text, text after text, and where each text's start."""
    data, offsets = flat(texts)
    starts, ends, first = words(data, offsets)
    hashed = token_hashes(data, starts, ends)
    counts = np.diff(first)
    sizes = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    begin = np.concatenate([[0], np.cumsum(sizes)])
    at = np.repeat(first[:-1] - begin[:-1], sizes) + np.arange(begin[-1])
    out = np.zeros(len(at), U64)
    last = np.repeat(first[1:], sizes)
    for k in range(n):
        inside = at + k < last  # only a short text has a gram with fewer words
        out = mixed(out * U64(3) + np.where(inside, hashed[np.minimum(at + k, max(0, len(hashed) - 1))], U64(k)) if len(hashed) else out)
    return out, begin


def _signer(bands: int, rows: int):
    draws = np.random.Generator(np.random.PCG64(SEED)).integers(1, 1 << 63, bands * rows, dtype=np.int64).astype(U64) | U64(1)

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, "t", SLICE_BYTES):
                hashes, begin = grams(part["t"])
                full = np.flatnonzero(np.diff(begin))
                keys = np.zeros((len(full), bands), U64)
                if len(full):
                    at = begin[full]
                    for band in range(bands):
                        key = np.full(len(full), band, U64)
                        for row in range(rows):
                            least = np.minimum.reduceat(hashes * draws[band * rows + row], at)
                            key = mixed(key * U64(5) + least)
                        keys[:, band] = key
                sizes = np.where(np.diff(begin) > 0, bands, 0)
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.reshape(-1).view(np.int64)))
                yield pa.RecordBatch.from_arrays([part["doc_id"], part["node"], pa.array(np.diff(begin)), lists], names=["doc_id", "node", "size", "bands"])

    return signed


def node_of(text: Column) -> Column:
    return F.md5(F.encode(text, "UTF-8"))


def nodes(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """One row per text: its hash, band hashes, number of n-grams and of copies, smallest id."""
    small_batches(docs.sparkSession)
    schema = T.StructType([
        docs.schema["doc_id"], T.StructField("node", T.StringType()),
        T.StructField("size", T.LongType()), T.StructField("bands", T.ArrayType(T.LongType())),
    ])
    texts = docs.select("doc_id", node_of(text_of()).alias("node"), text_of().alias("t"))
    return (
        texts.mapInArrow(_signer(bands, rows), schema)
        .groupBy("node")
        .agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies"), F.first("size").alias("size"), F.first("bands").alias("bands"))
    )


def stars(texts: DataFrame) -> DataFrame:
    """``(node, key, hub)`` for the buckets of several nodes, with the smallest of them."""
    keyed = texts.select("node", F.explode("bands").alias("key"))
    hubs = keyed.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("other")).filter("hub <> other")
    return keyed.join(hubs, "key").select("node", "key", "hub")


def candidates(texts: DataFrame) -> DataFrame:
    """``(node, root)`` of nodes that share a band hash with another, directly or in steps."""
    return components(stars(texts).select(F.col("node").alias("a"), F.col("hub").alias("b")))


def links_between(sets: list[np.ndarray], left: int | None) -> np.ndarray:
    """Which pairs of sets are linked; with ``left``, only those of one of the first ``left`` sets and a later one."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    values = np.concatenate(sets) if n else np.zeros(0, U64)
    owner = np.repeat(np.arange(n), sizes)
    _, code, often = np.unique(values, return_inverse=True, return_counts=True)
    shared = often[code] > 1
    owner, code = owner[shared], code[shared]
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    common = np.zeros((n, n), np.float64)
    _, code = np.unique(code, return_inverse=True)
    width = 4096
    for start in range(0, int(code[-1]) + 1 if len(code) else 0, width):
        a, b = np.searchsorted(code, [start, start + width])
        present = np.zeros((n, width), np.float32)
        present[owner[a:b], code[a:b] - start] = 1
        common += present @ present.T
    union = sizes[:, None] + sizes[None, :] - common
    linked = (THRESHOLD[1] * common >= THRESHOLD[0] * union) & (union > 0)
    np.fill_diagonal(linked, False)
    if left is not None:
        linked[:left, :left] = False
        linked[left:, left:] = False
    return linked


def _verify(group: pa.Table) -> pa.Table:
    """Links and a spanning forest of one block, or of two blocks with each other."""
    block = group["block"].to_numpy()
    order = np.argsort(block, kind="stable")
    low, high = group["low"][0].as_py(), group["high"][0].as_py()
    left = None if low == high else int((block == low).sum())
    sets = [group["grams"][int(i)].values.to_numpy() for i in order]
    group = group.drop_columns(["grams"]).take(pa.array(order))
    linked = links_between(sets, left)
    parent = list(range(len(sets)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, j in zip(*np.nonzero(np.triu(linked))):
        parent[max(root(i), root(j))] = min(root(i), root(j))
    names = group["node"].to_pylist()
    copies = group["copies"].to_numpy()
    return pa.table({
        "node": names,
        "to": [names[root(i)] for i in range(len(sets))],
        "text_links": linked.sum(axis=1).astype(np.int64),
        "doc_links": (linked * copies[None, :]).sum(axis=1).astype(np.int64),
        "single": group["single"],
    })


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to their n-gram sets."""
    for batch in batches:
        for part in parts(batch, "t", SLICE_BYTES):
            hashes, begin = grams(part["t"])
            sets = [np.unique(hashes[a:b]) for a, b in zip(begin, begin[1:])]
            upto = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(upto), pa.array(np.concatenate(sets).view(np.int64)))
            yield pa.RecordBatch.from_arrays([*(part[n] for n in part.schema.names if n != "t"), lists], names=[*(n for n in part.schema.names if n != "t"), "grams"])


def _cuts() -> Column:
    """Blocks for the nodes of a group."""
    return F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("size") * 8 / BLOCK_BYTES), F.lit(1)).cast("long")


def neighbourhoods(large: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For ``(node, root, size)`` of large groups: ``(node, near)``, the neighbourhood block of each node, and
    ``(low, high, side)``, the pairs of blocks that share a band. Only of groups that send fewer rows in this way."""
    bands = stored(stars(texts.join(large.select("node"), "node", "left_semi")), "large-bands")
    homes = large.join(bands.groupBy("node").agg(F.min("hub").alias("home")), "node")
    chunks = homes.groupBy(F.col("home").alias("of")).agg(_cuts().alias("chunks"))
    chunk = F.pmod(F.xxhash64("node"), F.col("chunks"))
    near = homes.join(chunks, F.col("home") == F.col("of")).select("node", "root", F.xxhash64("home", chunk).alias("near"))
    near = stored(near, "neighbourhoods")
    held = stored(near.groupBy("root", "near").agg(F.count(F.lit(1)).alias("n")), "block-sizes")
    everywhere = large.groupBy(F.col("root").alias("of")).agg((_cuts() * F.count(F.lit(1))).alias("all_rows"))
    # Pairs of blocks are listed only where they are no more than the rows that the other way sends.
    meeting = stored(bands.select("node", "key").join(near, "node").select("root", "key", "near").distinct(), "block-bands")
    listed = meeting.groupBy("root", "key").agg(F.count(F.lit(1)).alias("n")).groupBy("root").agg(F.sum(F.col("n") * F.col("n")).alias("pairs"))
    few = stored(listed.join(everywhere, F.col("root") == F.col("of")).filter("pairs <= all_rows").select("root", "all_rows"), "listed-groups")
    one = meeting.join(few, "root", "left_semi").select("root", "key", F.col("near").alias("low"))
    two = one.select(F.col("key").alias("k"), F.col("low").alias("high"))
    meets = one.join(two, (F.col("key") == F.col("k")) & (F.col("low") <= F.col("high"))).select("root", "low", "high").distinct()
    meets = stored(meets.select("*", F.explode(F.array_distinct(F.array("low", "high"))).alias("side")), "block-meetings")
    sent = meets.join(held.select(F.col("near").alias("side"), "n"), "side").groupBy("root").agg(F.sum("n").alias("rows"))
    loose = stored(sent.join(few, "root").filter("rows < all_rows").select("root"), "loose-groups")
    return near.join(loose, "root", "left_semi").select("node", "near"), meets.join(loose, "root", "left_semi").select("low", "high", "side")


def verified(docs: DataFrame, texts: DataFrame) -> DataFrame:
    """Per block task and node of a candidate group: a node it is joined to, and its links there."""
    groups = stored(candidates(texts), "candidates")
    known = texts.select(F.col("node").alias("n"), "first_id", "copies", "size")
    sized = stored(groups.join(known, F.col("node") == F.col("n")).drop("n"), "group-nodes")
    sizes = stored(sized.groupBy(F.col("root").alias("of")).agg(_cuts().alias("blocks")), "group-sizes")
    members = sized.join(sizes, F.col("root") == F.col("of")).select("node", "root", "first_id", "copies", "size", "blocks")
    members = stored(members.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks"))), "members")
    meets = None
    if not sizes.filter("blocks > 1").isEmpty():
        near, meets = neighbourhoods(members.filter("blocks > 1").select("node", "root", "size"), texts)
        near, meets = stored(near, "near-blocks"), stored(meets, "block-pairs")
        members = stored(members.join(near.select(F.col("node").alias("n"), "near"), F.col("node") == F.col("n"), "left").drop("n"), "members")
    else:
        members = members.withColumn("near", F.lit(None).cast("long"))
    met = F.broadcast(members) if members.count() <= BROADCAST else members
    source = docs.select("doc_id", node_of(text_of()).alias("text_node"), text_of().alias("t"))
    fetched = (
        source.join(met, (F.col("text_node") == F.col("node")) & F.col("doc_id").eqNullSafe(F.col("first_id")))
        .select("node", "root", "copies", "blocks", "block", "near", "t")
        .dropDuplicates(["node"])
    )
    listed = T.StructType([*fetched.drop("t").schema.fields, T.StructField("grams", T.ArrayType(T.LongType()))])
    dealt = fetched.mapInArrow(_listed, listed)
    by_hash = F.when(F.col("near").isNull(), F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).otherwise(F.array(F.lit(0).cast("long")))
    if meets is None:
        dealt = dealt.withColumn("other", F.explode(by_hash))
        low, high, block = F.least("block", "other"), F.greatest("block", "other"), F.col("block")
    else:
        # Nodes without a neighbourhood meet nothing here; a hash of their own keeps them apart in the shuffle.
        place = F.coalesce("near", F.xxhash64("node"))
        pairs = meets.select(F.col("low").alias("near_low"), F.col("high").alias("near_high"), "side")
        dealt = dealt.join(pairs, (place == F.col("side")) & F.col("near").isNotNull(), "left").withColumn("other", F.explode(by_hash))
        low = F.coalesce("near_low", F.least("block", "other"))
        high = F.coalesce("near_high", F.greatest("block", "other"))
        block = F.coalesce("near", "block")
    dealt = dealt.select("node", "root", "copies", "grams", block.alias("block"), (F.col("blocks") == 1).alias("single"), low.alias("low"), high.alias("high"))
    schema = T.StructType([
        T.StructField("node", T.StringType()), T.StructField("to", T.StringType()),
        T.StructField("text_links", T.LongType()), T.StructField("doc_links", T.LongType()), T.StructField("single", T.BooleanType()),
    ])
    return dealt.groupBy("root", "low", "high").applyInArrow(_verify, schema)


def classes(docs: DataFrame) -> DataFrame:
    """One row per text: ``node, copies, class_id, class_node, text_links, doc_links``."""
    bands, rows = banding(THRESHOLD[0] / THRESHOLD[1])
    texts = stored(nodes(docs, bands, rows), "texts")
    found = stored(verified(docs, texts), "links")
    links = found.groupBy("node").agg(F.sum("text_links").alias("text_links"), F.sum("doc_links").alias("doc_links"))
    # A group of one block is settled by its task; the forests of several blocks are joined.
    single = found.filter("single").select("node", F.col("to").alias("root"))
    roots = components(found.filter("not single").select(F.col("node").alias("a"), F.col("to").alias("b"))).unionAll(single)
    known = (
        texts.select("node", "first_id", "copies")
        .join(links, "node", "left")
        .join(roots, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    known = stored(known, "classes")
    first = F.min(F.struct(F.col("first_id").isNull(), "first_id", "node")).alias("first")
    heads = known.groupBy("root").agg(first).select(
        "root", F.col("first.first_id").alias("class_id"), F.col("first.node").alias("class_node")
    )
    return known.join(heads, "root").select(
        "node", "first_id", "copies", "class_id", "class_node",
        F.coalesce("text_links", F.lit(0)).alias("text_links"), F.coalesce("doc_links", F.lit(0)).alias("doc_links"),
    )


def join_classes(docs: DataFrame) -> DataFrame:
    """Per document its class and its links: to different texts, and to other documents (copies included)."""
    known = classes(docs)
    rows = docs.select("doc_id", node_of(text_of()).alias("of"))
    return rows.join(known, F.col("of") == F.col("node")).select(
        "doc_id", "class_id",
        (F.col("doc_links") + F.col("copies") - 1).alias("n_links"),
        F.col("text_links").alias("n_text_links"),
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, less all but one document of each class."""
    known = classes(docs)
    rows = docs.select("doc_id", node_of(text_of()).alias("of"))
    stays = (F.col("doc_id").eqNullSafe(F.col("class_id"))) & (F.col("node") == F.col("class_node"))
    judged = rows.join(known, F.col("of") == F.col("node")).groupBy("doc_id", "of").agg(
        F.first(stays).alias("stays"), F.count(F.lit(1)).alias("rows")
    )
    marks = stored(judged.filter("not stays or rows > 1"), "class-marks")
    if marks.count() <= BROADCAST:
        marks = F.broadcast(marks)
    marks = marks.select(F.col("doc_id").alias("mark_id"), F.col("of").alias("mark_of"), "stays")
    names = {n: fresh(docs, n) for n in ("mark_id", "mark_of", "stays")}
    marks = marks.select(*[F.col(n).alias(free) for n, free in names.items()])
    same = F.col("doc_id").eqNullSafe(F.col(names["mark_id"])) & (node_of(text_of()) == F.col(names["mark_of"]))
    marked = docs.join(marks, same, "left")
    columns = [F.col(f"`{n}`") for n in docs.columns]
    alone = marked.filter(F.col(names["stays"]).isNull()).select(*columns)
    # Repeated rows of a document that stays: one of them.
    repeated = marked.filter(F.col(names["stays"])).select(*columns).dropDuplicates(["doc_id", "text"])
    return alone.unionAll(repeated)


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_classes(table(spark, sf_dir, "documents"))

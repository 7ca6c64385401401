"""Ranked lexical search: exact inner products found by ball trees over sparse document vectors.

``index`` reads every text once and stores its terms (64-bit hashes) with their counts. ``search`` scores a
document for an item as the inner product of two vectors of whole numbers: the item's term weights and the
document's damped term counts. Items are taken in blocks of bounded size; only coordinates that a block has can
change its scores, so documents are cut to these and those without any are never candidates.

The vectors of a block form a tree: cells around centroids fitted on a bounded sample, cells dealt into groups
of bounded size, and in each group's task a ball tree of halves down to leaves. For a ball with centroid ``c`` and
radius ``r`` no document in it scores more than ``q.c + |q| r``; the bound is rounded up by more than
floating point can lose. Subtrees are searched best-first for each item and left when their bound lies below
the item's 20th score so far, or below that of the sample, which is a lower bound for all documents. At the
leaves scores are exact 64-bit integers. Every document with hits is in a leaf, so the result is that of scoring all.

A cell of any size is dealt over as many tasks as it needs. What reaches the driver is bounded: a block of items, its
terms and their counts, the sample, and one count for each cell.

Defined results: a null text has no terms, and neither item nor document without terms is in the result; repeated
documents are documents, each with a rank of its own; null ids rank after others; repeated items count once, while
different texts under one item id are ranked apart; empty tables give no rows. Only id and text are read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketflow.llm.base import small_batches, stored, table, text_of
from basketflow.llm.bytehash import LOWER, flat, parts, runs, token_hashes

TOP = 20
#: Characters of item text in a block; an item larger than that is a block of its own.
BLOCK_CHARS = 1 << 18
#: Documents of the sample that cells and first thresholds are fitted on.
SAMPLE = 1024
CELLS = 32
#: Numbers in the matrix of a group, and documents in a leaf.
GROUP_NUMBERS = 6_000_000
LEAF = 64
SLICE_BYTES = 2 << 20

TERM = np.ones(256, bool)
TERM[:0x30] = TERM[0x3A:0x41] = TERM[0x5B:0x61] = TERM[0x7B:0x80] = False


def terms_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the terms of each text, text after text, and where each text's start."""
    data, offsets = flat(texts)
    data = LOWER[data]
    starts, ends, first = runs(TERM[data], offsets)
    return token_hashes(data, starts, ends), first


def _counted(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct terms of each text, their counts, and where each text's start."""
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    return hashes[at], np.diff(np.append(at, len(hashes))), np.searchsorted(owner[at], np.arange(len(first)))


def _lists(values: np.ndarray, begin: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(values))


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in parts(batch, "t", SLICE_BYTES):
            hashes, first = terms_of(part["t"])
            terms, counts, begin = _counted(hashes, first)
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"], pa.array(np.diff(first).astype(np.int64)), _lists(terms.view(np.int64), begin), _lists(counts.astype(np.int32), begin)],
                names=["doc_id", "n", "terms", "counts"],
            )


def index(docs: DataFrame) -> DataFrame:
    """``doc_id, n, terms, counts`` of every document, stored: its number of terms, and its distinct terms with
    their counts. It knows nothing of the items and serves any."""
    small_batches(docs.sparkSession)
    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("n", T.LongType()),
        T.StructField("terms", T.ArrayType(T.LongType())), T.StructField("counts", T.ArrayType(T.IntegerType())),
    ])
    return stored(docs.select("doc_id", text_of().alias("t")).mapInArrow(_indexed, schema), "search-index")


class Block:
    """Items of bounded size: their vocabulary, and after ``weigh`` their vectors."""

    def __init__(self, texts: list[str]) -> None:
        hashes, first = terms_of(pa.array(texts, pa.string()))
        self.terms, places = np.unique(hashes.view(np.int64), return_inverse=True)
        self.tokens = [places[a:b] for a, b in zip(first, first[1:])]

    def weigh(self, n_docs: int, n_terms: int, holders: dict[int, int]) -> None:
        weights = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holders.get(c, 0) + 1))) for c in range(len(self.terms))]
        weights = np.array(weights, np.int64)
        self.n_docs, self.n_terms, self.columns, self.weights = n_docs, n_terms, [], []
        for tokens in self.tokens:
            columns, often = np.unique(tokens, return_counts=True)
            self.columns.append(columns)
            self.weights.append(weights[columns] * often)

    def values(self, n: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Damped counts of documents of ``n`` terms."""
        if 25 * int(n.max(initial=0)) * self.n_docs < 1 << 63:
            m = 75 + (25 * n * self.n_docs) // self.n_terms
        else:
            m = np.array([75 + 25 * int(x) * self.n_docs // self.n_terms for x in n], np.int64)
        return (1_000_000_000 * counts) // (1000 * counts + 12 * m)

    def matrix(self, rows: pa.Table | pa.RecordBatch, columns: np.ndarray | None = None) -> np.ndarray:
        """Whole-number vectors of the documents, a row each, over ``columns`` (all if not given)."""
        cells, begin = _flat_lists(rows["columns"])
        counts = _flat_lists(rows["counts"])[0].astype(np.int64)
        sizes = np.diff(begin)
        n = rows["n"].to_numpy(zero_copy_only=False) if isinstance(rows, pa.RecordBatch) else rows["n"].to_numpy()
        width = len(self.terms) if columns is None else len(columns)
        out = np.zeros((len(sizes), width), np.int64)
        at = cells if columns is None else np.searchsorted(columns, cells)
        out[np.repeat(np.arange(len(sizes)), sizes), at] = self.values(np.repeat(n, sizes), counts)
        return out


def _flat_lists(lists: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    offsets = lists.offsets.to_numpy()
    return lists.flatten().to_numpy(zero_copy_only=False), offsets - offsets[0]


def _matching(terms: np.ndarray):
    def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, begin = _flat_lists(batch["terms"])
            counts = _flat_lists(batch["counts"])[0]
            at = np.minimum(np.searchsorted(terms, found), max(0, len(terms) - 1))
            hit = terms[at] == found if len(terms) else np.zeros(len(found), bool)
            upto = np.concatenate([[0], np.cumsum(hit)])[begin]
            some = np.flatnonzero(np.diff(upto))
            kept = pa.array(some)
            begins = np.append(upto[some], upto[-1])
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(kept), batch["n"].take(kept), _lists(at[hit].astype(np.int32), begins), _lists(counts[hit], begins)],
                names=["doc_id", "n", "columns", "counts"],
            )

    return matched


def _halves(points: np.ndarray, centroid: np.ndarray) -> tuple[float, np.ndarray | None]:
    """Radius of a ball, and its points ordered along the line between two far ones; None if all are one point."""
    away = np.sqrt(np.maximum(0, ((points - centroid) ** 2).sum(axis=1)))
    radius = float(away.max()) * (1 + 1e-9)
    one = points[int(away.argmax())]
    other = points[int(((points - one) ** 2).sum(axis=1).argmax())]
    if (one == other).all():
        return radius, None
    return radius, np.argsort(points @ (other - one), kind="stable")


class BallTree:
    """Halves of halves of points; the points of a node are neighbours in ``order``."""

    def __init__(self, points: np.ndarray, leaf: int) -> None:
        self.order = np.arange(len(points))
        self.spans: list[tuple[int, int]] = []
        self.children: list[tuple[int, int] | None] = []
        centroids, radii, stack = [], [], [(0, len(points), None)]
        while stack:
            a, b, parent = stack.pop()
            number = len(self.spans)
            if parent is not None:
                self.children[parent] = (*(self.children[parent] or ()), number)
            inside = points[self.order[a:b]].astype(np.float64)
            centroid = inside.mean(axis=0)
            radius, along = _halves(inside, centroid)
            self.spans.append((a, b))
            self.children.append(None)
            centroids.append(centroid)
            radii.append(radius)
            if b - a > leaf and along is not None:
                self.order[a:b] = self.order[a:b][along]
                middle = (a + b) // 2
                stack += [(a, middle, number), (middle, b, number)]
        self.centroids, self.radii = np.array(centroids), np.array(radii)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """For each query and node, more than the inner product with any point of the node.

        Sums of n doubles lose less than n 2^-52 of the sum of their sizes; all terms are positive here, and a
        billionth covers any n below four million."""
        lengths = np.sqrt((queries**2).sum(axis=1))
        return (queries @ self.centroids.T + lengths[:, None] * self.radii[None, :]) * (1 + 1e-9) + 1


def _key(entry: tuple[int, object]) -> tuple:
    score, doc = entry
    return (-score, doc is None, doc if doc is not None else 0)


def best_of(block: Block, group: pa.Table, least: np.ndarray, leaf: int = LEAF) -> Iterator[tuple[int, object, int]]:
    """``(item, doc_id, score)``: each item's best documents of a group with a score of at least ``least``."""
    used = np.unique(_flat_lists(group["columns"])[0])
    vectors = block.matrix(group, used)
    tree = BallTree(vectors, leaf)
    ids = group["doc_id"].take(pa.array(tree.order)).to_pylist()
    by_term = np.ascontiguousarray(vectors[tree.order].T)
    queries = np.zeros((len(block.columns), len(used)))
    sparse = []
    for i, (columns, weights) in enumerate(zip(block.columns, block.weights)):
        here = np.isin(columns, used)
        at = np.searchsorted(used, columns[here])
        queries[i, at] = weights[here]
        sparse.append((at, weights[here]))
    bounds = tree.bounds(queries)
    for i, (at, weights) in enumerate(sparse):
        if not len(at):
            continue
        best: list[tuple[int, object]] = []
        floor = max(1, int(least[i]))
        heap = [(-bounds[i, 0], 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            if -bound < floor:
                break
            if tree.children[node]:
                for child in tree.children[node]:
                    if bounds[i, child] >= floor:
                        heapq.heappush(heap, (-bounds[i, child], child))
                continue
            a, b = tree.spans[node]
            scores = weights @ by_term[at, a:b]
            good = np.flatnonzero(scores >= floor)
            if len(good):
                best = sorted(best + [(int(scores[j]), ids[a + j]) for j in good], key=_key)[:TOP]
                if len(best) == TOP:
                    floor = max(floor, best[-1][0])
        for score, doc in best:
            yield i, doc, score


def _sample_fit(block: Block, sample: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Centroids of cells, and for each item a score that its 20th best document reaches."""
    points = block.matrix(sample).astype(np.float64)
    tree = BallTree(points, max(1, -(-len(points) // CELLS)))
    leaves = [k for k, below in enumerate(tree.children) if not below]
    least = np.zeros(len(block.columns), np.int64)
    if len(points) >= TOP:
        whole = points.astype(np.int64)
        for i, (columns, weights) in enumerate(zip(block.columns, block.weights)):
            least[i] = np.partition(whole[:, columns] @ weights, -TOP)[-TOP] if len(columns) else 0
    return tree.centroids[leaves], least


def _celling(block: Block, centroids: np.ndarray):
    step = max(1, GROUP_NUMBERS // max(1, len(block.terms)))
    sizes = (centroids**2).sum(axis=1)

    def celled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                nearest = (sizes[None, :] - 2 * (block.matrix(part).astype(np.float64) @ centroids.T)).argmin(axis=1)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(nearest.astype(np.int32))], names=[*part.schema.names, "cell"])

    return celled


def _search_block(known: DataFrame, items: list, item_type: T.DataType, n_docs: int, n_terms: int) -> DataFrame:
    """The best documents of a block's items: ``item, item_id, doc_id, score``, a few more than needed."""
    spark = known.sparkSession
    block = Block([row.t for row in items])
    doc_field = known.schema["doc_id"]
    hit_schema = T.StructType([
        doc_field, known.schema["n"], T.StructField("columns", T.ArrayType(T.IntegerType())), T.StructField("counts", T.ArrayType(T.IntegerType())),
    ])
    hits = stored(known.mapInArrow(_matching(block.terms), hit_schema), "search-hits")
    # A row for each term of the block.
    holders = hits.select(F.explode("columns").alias("c")).groupBy("c").agg(F.count(F.lit(1)).alias("docs")).collect()
    block.weigh(n_docs, n_terms, {r.c: r.docs for r in holders})
    draw = F.xxhash64("doc_id", "n", "columns")
    sample = hits.withColumn("_draw", draw).orderBy("_draw").limit(SAMPLE).drop("_draw").toArrow()
    out_schema = T.StructType([T.StructField("item", T.IntegerType()), doc_field, T.StructField("score", T.LongType())])
    if sample.num_rows == 0:
        found = spark.createDataFrame([], out_schema)
    else:
        centroids, least = _sample_fit(block, sample)
        cells = stored(hits.mapInArrow(_celling(block, centroids), hit_schema.add("cell", T.IntegerType())), "search-cells")
        size = max(LEAF, GROUP_NUMBERS // max(1, len(block.terms)))
        groups = {r.cell: -(-r["count"] // size) for r in cells.groupBy("cell").count().collect()}
        number = F.create_map(*[F.lit(x) for pair in groups.items() for x in pair])[F.col("cell")]
        # Stored rows keep their places, so a task that runs again deals them alike.
        dealt = cells.withColumn("part", F.pmod(F.xxhash64(F.monotonically_increasing_id()), number))

        def searched(group: pa.Table) -> pa.Table:
            rows = list(best_of(block, group, least))
            kind = group.schema.field("doc_id").type
            return pa.table({
                "item": pa.array([r[0] for r in rows], pa.int32()),
                "doc_id": pa.array([r[1] for r in rows], kind),
                "score": pa.array([r[2] for r in rows], pa.int64()),
            })

        found = dealt.groupBy("cell", "part").applyInArrow(searched, out_schema)
    names = spark.createDataFrame([(i, row.item_id) for i, row in enumerate(items)], T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", item_type)]))
    return found.join(F.broadcast(names), "item")


def search(known: DataFrame, items: DataFrame) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``TOP`` best documents of an index for each item."""
    spark = known.sparkSession
    asked = stored(items.select("item_id", text_of().alias("t")).distinct(), "search-items")
    n_docs, n_terms = known.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    chars = asked.agg(F.coalesce(F.sum(F.length("t")), F.lit(0))).first()[0]
    blocks = max(1, -(-chars // BLOCK_CHARS))
    results = []
    for number in range(blocks if n_docs else 0):
        # Bounded by BLOCK_CHARS, evenly dealt.
        rows = asked.filter(F.pmod(F.xxhash64("item_id", "t"), F.lit(blocks)) == number).collect()
        if rows:
            found = _search_block(known, rows, items.schema["item_id"].dataType, n_docs, n_terms)
            order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
            ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= TOP)
            results.append(ranked.select("item_id", "rank", "doc_id", "score"))
            if blocks > 1:
                results[-1] = stored(results[-1], "search-results")
    if not results:
        empty = T.StructType([T.StructField("item_id", items.schema["item_id"].dataType), T.StructField("rank", T.IntegerType()), known.schema["doc_id"], T.StructField("score", T.LongType())])
        return spark.createDataFrame([], empty)
    whole = results[0]
    for part in results[1:]:
        whole = whole.unionAll(part)
    return whole


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

OP13_SQL = f"""
with docs as (
  select row_number() over () as r, doc_id, {_TERMS} as ts from documents
), items as (
  select row_number() over () as i, item_id, {_TERMS} as ts from (select distinct item_id, coalesce(text, '') as text from benchmark)
), sizes as (
  select count(*) as n_docs, cast(sum(len(ts)) as bigint) as n_terms from docs where len(ts) > 0
), asked as (
  select i, t, count(*) as often from (select i, unnest(ts) as t from items) group by i, t
), counted as (
  select r, t, count(*) as tf from (select r, unnest(ts) as t from docs) where t in (select t from asked) group by r, t
), weights as (
  select t, cast(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) as bigint) as w
  from counted, sizes group by t, n_docs
), valued as (
  select r, t, (1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * len(ts) * n_docs) // n_terms)) as d
  from counted join docs using (r), sizes
), scored as (
  select i, r, cast(sum(often * w * d) as bigint) as score
  from asked join weights using (t) join valued using (t) group by i, r
), ranked as (
  select item_id, doc_id, score, row_number() over (partition by i order by score desc, doc_id nulls last) as rank
  from scored join docs using (r) join items using (i) where score > 0
)
select item_id, cast(rank as integer) as rank, doc_id, score from ranked where rank <= {TOP}
"""

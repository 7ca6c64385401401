"""Benchmark decontamination by spaced seeds. DataFrame functions only.

Tokens are the runs of letters and digits of the lower-cased text. A document leaks an item when some
``WINDOW`` neighbouring tokens of the item stand in the document with at most ``SUBSTITUTIONS`` of them
replaced. A shorter item of ``TOLERANT`` tokens or more leaks when it stands there with one of them replaced at most,
one of fewer when it stands there unchanged; items of fewer than ``LEAST`` tokens, a word or a phrase, say nothing
and leak nowhere.

Fixed masks pick token positions and ignore the others. Together they are lossless: whichever two
tokens of a window are replaced, one mask at one place picks only tokens that are not (a test tries
all). Hashes under the masks, with the token's place, are taken at each place of items and documents and
joined; a hit names a diagonal, and the tokens around it are compared one by one.

A benchmark's hashes are broadcast up to ``BROADCAST_SEEDS`` rows and joined by a shuffle beyond. Hits of one
document and diagonal are counted once before anything else; a document's row carries its own hits only.

Defined results: null texts are empty and leak nothing; null ids are ids like any other; repeated rows,
or different texts under one id, give one result per id and item, the longest overlap; equal items
under two ids both leak; empty tables give no rows. Only id and text are read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.llm.base import stored, table, text_of

WINDOW = 13
SUBSTITUTIONS = 2
LEAST = 5
TOLERANT = 8
MASKS = ((0, 1, 3, 5, 6, 7), (0, 1, 2, 5, 7, 8))
#: Seeds of the benchmark, and documents with hits, beyond which they are joined by a shuffle.
BROADCAST_SEEDS = 1_000_000
BROADCAST = 250_000


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    return F.transform(F.array(value), then)[0]


def tokens(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def seeds(words: Column, masks: list[tuple[int, ...]]) -> Column:
    """``(place, hash)`` of every mask at every place where it fits."""

    def under(w: Column, number: int, mask: tuple[int, ...]) -> Column:
        places = F.sequence(F.lit(0), F.size(w) - 1 - mask[-1])
        hashes = F.transform(places, lambda i: F.xxhash64(F.lit(number), *[F.get(w, i + k) for k in mask]))
        return F.when(F.size(w) > mask[-1], hashes).otherwise(F.array().cast("array<bigint>"))

    return _let(words, lambda w: F.array(*[under(w, n, mask) for n, mask in enumerate(masks)]))


def _placed(rows: DataFrame, *keep: str) -> DataFrame:
    """Seeds as rows: ``keep``, place, hash."""
    lists = rows.select(*keep, F.explode("seeds").alias("s"))
    return lists.select(*keep, F.posexplode("s").alias("place", "hash"))


def matched(words: Column, item: Column, diagonal: Column) -> Column:
    """The places of the item inside windows that stand in the document, in order."""
    n = F.size(item)
    width = F.least(n, F.lit(WINDOW))
    need = F.when(n < TOLERANT, n).when(n < WINDOW, n - 1).otherwise(WINDOW - SUBSTITUTIONS)
    same = F.transform(item, lambda token, j: F.coalesce(F.get(words, diagonal + j) == token, F.lit(False)).cast("int"))

    def places(hits: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), n - width),
            lambda a: F.aggregate(F.slice(hits, a + 1, width), F.lit(0), lambda total, hit: total + hit) >= need,
        )
        return _let(
            starts, lambda found: F.filter(
                F.sequence(F.lit(0), n - 1), lambda j: F.exists(found, lambda a: (a <= j) & (j < a + width))
            )
        )

    return F.when(n >= LEAST, _let(same, places)).otherwise(F.array().cast("array<int>"))


def short_masks(n: int) -> list[tuple[int, ...]]:
    """Masks for items of ``n`` tokens: all of them, or two halves, one of which a replaced token leaves alone."""
    return [tuple(range(n))] if n < TOLERANT else [tuple(range(n // 2)), tuple(range(n // 2, n))]


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document text and item it leaks: ``doc_id, copy, item_id, overlap, first_token``.

    ``copy`` is the hash of the text, ``overlap`` the number of item tokens inside matching windows on the
    best diagonal, ``first_token`` the document token where the first of them stands.
    """
    items = stored(
        benchmark.select("item_id", text_of().alias("t")).distinct()
        .select("item_id", tokens(F.col("t")).alias("item")).filter(F.size("item") >= LEAST),
        "benchmark-items",
    )
    short = sorted(r.n for r in items.filter(F.size("item") < WINDOW).select(F.size("item").alias("n")).distinct().collect())
    masks = [*MASKS, *[mask for n in short for mask in short_masks(n)]]
    marks = stored(
        _placed(items.select("item_id", seeds(F.col("item"), masks).alias("seeds")), "item_id")
        .select("item_id", F.col("place").alias("item_place"), "hash").distinct(),
        "benchmark-seeds",
    )
    small = marks.count() <= BROADCAST_SEEDS
    rows = docs.select("doc_id", F.xxhash64(text_of()).alias("copy"), tokens(text_of()).alias("words"))
    placed = _placed(rows.select("doc_id", "copy", seeds(F.col("words"), masks).alias("seeds")), "doc_id", "copy")
    hits = stored(
        placed.join(F.broadcast(marks) if small else marks, "hash")
        .select("doc_id", "copy", "item_id", (F.col("place") - F.col("item_place")).alias("diagonal"))
        .distinct()
        .groupBy("doc_id", "copy", "item_id")
        .agg(F.collect_set("diagonal").alias("diagonals")),
        "seed-hits",
    )
    near = hits.select(F.col("doc_id").alias("d"), F.col("copy").alias("c"), "item_id", "diagonals")
    # Diagonals, not rows: a repeated token of an item gives a document many.
    if hits.agg(F.coalesce(F.sum(F.size("diagonals")), F.lit(0))).first()[0] <= BROADCAST:
        near = F.broadcast(near)
    if small:
        items = F.broadcast(items)
    compared = (
        rows.join(near, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("copy") == F.col("c")))
        .join(items.withColumnRenamed("item_id", "of"), F.col("item_id").eqNullSafe(F.col("of")))
        .select("doc_id", "copy", "item_id", F.explode(F.transform("diagonals", lambda g: F.struct(
            g.alias("diagonal"), matched(F.col("words"), F.col("item"), g).alias("places")))).alias("m"))
        .filter(F.size("m.places") > 0)
    )
    best = F.max(F.struct(F.size("m.places"), -(F.col("m.diagonal") + F.get("m.places", F.lit(0))))).alias("best")
    return compared.groupBy("doc_id", "copy", "item_id").agg(best).select(
        "doc_id", "copy", "item_id", F.col("best.col1").alias("overlap"), (-F.col("best.col2")).alias("first_token")
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, that leak no item."""
    found = stored(leaks(docs, benchmark).select(F.col("doc_id").alias("d"), F.col("copy").alias("c")).distinct(), "leaks")
    if found.count() <= BROADCAST:
        found = F.broadcast(found)
    return docs.join(found, docs["doc_id"].eqNullSafe(found["d"]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == found["c"]), "left_anti")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per leaking document and item."""
    found = leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    best = F.max(F.struct("overlap", -F.col("first_token"))).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", F.col("best.overlap").cast("long").alias("overlap"), (-F.col("best.col2")).cast("long").alias("first_token")
    )


OP1_SQL = r"""
with i as (
  select distinct item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda z: z <> '') as x
  from benchmark
), d as (
  select doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda z: z <> '') as x
  from documents
), iw as (
  select item_id, len(x) as n, unnest(x) as w, generate_subscripts(x, 1) as p from i where len(x) >= 5
), dw as (
  select doc_id, unnest(x) as w, generate_subscripts(x, 1) as p from d
), ig as (
  select item_id, p, w || ' ' || lead(w) over s || ' ' || lead(w, 2) over s || ' ' || lead(w, 3) over s as g
  from iw window s as (partition by item_id order by p)
), dg as (
  select doc_id, p, w || ' ' || lead(w) over s || ' ' || lead(w, 2) over s || ' ' || lead(w, 3) over s as g
  from dw window s as (partition by doc_id order by p)
), diagonals as (
  -- at most two of thirteen tokens replaced, or one of eight: four unchanged neighbours are left
  select distinct doc_id, item_id, dg.p - ig.p as diagonal from dg join ig using (g)
), same as (
  select diagonals.doc_id, item_id, diagonal, iw.n, iw.p, (dw.w is not null)::int as hit
  from diagonals join iw using (item_id)
  left join dw on dw.doc_id = diagonals.doc_id and dw.p = iw.p + diagonal and dw.w = iw.w
), starts as (
  select *, sum(hit) over (partition by doc_id, item_id, diagonal order by p
                           rows between current row and 12 following) as hits from same
), covered as (
  select distinct s.doc_id, s.item_id, s.diagonal, s.p + k as p
  from starts s, range(13) as r(k)
  where s.p + least(s.n, 13) - 1 <= s.n and s.hits >= case when s.n < 8 then s.n when s.n < 13 then s.n - 1 else 11 end
    and k < least(s.n, 13)
), best as (
  select doc_id, item_id, count(*) as overlap, min(p) + diagonal - 1 as first_token
  from covered group by doc_id, item_id, diagonal
)
select doc_id, item_id, overlap, first_token from best
qualify row_number() over (partition by doc_id, item_id order by overlap desc, first_token) = 1
"""

"""Removal of repeated passages: a depth-limited radix sort of all suffixes.

Every byte of a text starts a suffix, ordered only by its first ``DEPTH`` bytes, its window. Passes over one
digit at a time split the suffixes into groups, keyed by the group so far and the next digit; a suffix alone in its
group is unique and drops out, and what is equal in all digits is a repeated window. All bytes of repeated
windows are removed, whoever comes first.

Rows are saved by anchors: the anchor of a window is the leftmost of its ``GRAM``-byte pieces with the least
hash. Runs of neighbouring windows have one anchor, so one row stands for a run (a *block*), and the first pass
is over anchors: blocks whose anchor is unique end here. The next passes take the bytes of a block's extent, the
union of its windows, in order, ``DIGIT`` of them at a time. Groups that agree in all digits left end early, with all of their
windows repeated. Blocks that are alone may still share some of their windows with others: the neighbourhoods of edits and of
passages shorter than a window. They are cut by the place of the anchor into ``WIDTHS`` windows and, at last, single windows,
which take the same passes. Groups are counted with map-side sums and rows are only joined to counts,
so a passage that stands in every document is no group that a task would hold.

A digit is the 64-bit hash of its bytes, a sum of mixed numbers for eight bytes and their place, which regular texts
(Thue-Morse strings) do not collide in as they do in polynomials; bytes are not compared again. Windows lie inside one text; the same text twice
repeats all of its windows, overlapping windows of one text repeat each other.

Defined results: a null text is empty, a text shorter than a window stays whole; rows repeated with
id and text repeat each other; null ids are ids. An empty table gives no rows. Only id and text are
read, so extra columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketflow.llm.base import small_batches, stored, table, text_of
from basketflow.llm.bytehash import U64, Ranges, flat, mixed, parts, range_hashes

DEPTH = 200
GRAM = 32
#: Bytes of a digit, and the digits of the longest extent.
DIGIT = 128
ORDER = ("d1", "d2", "d3")
#: Windows of a block after each further cut.
WIDTHS = (24, 4, 1)
SLICE_BYTES = 1 << 20
#: Longer texts are read in overlapping pieces of so many window starts.
PIECE = 1 << 20
#: Rows of passages by document beyond which they meet their documents by a shuffle.
BROADCAST = 250_000
BROADCAST_PASSAGES = 2_000_000


def anchors(data: np.ndarray, sums: np.ndarray, ranges: Ranges) -> tuple[np.ndarray, np.ndarray]:
    """The hash of the piece at each place, and for each window start the place of its anchor."""
    m, width = len(data) - GRAM + 1, DEPTH - GRAM + 1
    hashes = (sums[GRAM:] - sums[:-GRAM]) * ranges.inverses[:m]
    low = U64((1 << 24) - 1)
    order = (hashes * U64(0x9FB21C651E98DF25)) & ~low | np.arange(m, dtype=U64)
    padded = np.full(-(-m // width) * width, ~U64(0))
    padded[:m] = order
    padded = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(padded, axis=1).reshape(-1)
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    starts = m - width + 1
    return hashes, (np.minimum(behind[:starts], ahead[width - 1 : m]) & low).astype(np.int64)


def _runs(data: np.ndarray, offsets: np.ndarray, first: Ranges) -> tuple[np.ndarray, ...]:
    """Blocks of all texts: row of the text, first window, windows - 1, place of the anchor in the last, its hash, digits."""
    counts = np.maximum(0, np.diff(offsets) - DEPTH + 1)
    none = np.zeros(0, np.int64)
    if not counts.sum():
        return none, none, none, none, none, [none] * len(ORDER)
    sums = first.sums(data)
    hashes, anchor = anchors(data, sums, first)
    before = np.cumsum(counts) - counts
    starts = np.repeat(offsets[:-1] - before, counts) + np.arange(counts.sum())
    anchor = anchor[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)
    begin = np.flatnonzero(new)
    low, at = starts[begin], anchor[begin]
    high = starts[np.append(begin[1:], len(starts)) - 1]
    text = np.searchsorted(offsets, low, side="right") - 1
    core = mixed(hashes[at]).view(np.int64)
    return text, low - offsets[text], high - low, at - high, core, _digits(data, low, high, at - high)


def _digits(data: np.ndarray, low: np.ndarray, high: np.ndarray, offset: np.ndarray) -> list[np.ndarray]:
    """The bytes of the blocks' extents in order, as digits; the first tells the places of the windows, too.
    A digit beyond the extent is 0."""
    end = high + DEPTH
    digits = []
    for i in range(len(ORDER)):
        digit, begin = np.zeros(len(low), U64), low + i * DIGIT
        there = np.flatnonzero(begin < end)
        begin, end_of = begin[there], end[there]
        digit[there] = range_hashes(data, np.minimum(begin, end_of - 8), np.minimum(begin + DIGIT, end_of))
        digits.append(digit)
    digits[0] = mixed(digits[0] + mixed((offset * 1024 + high - low).astype(U64)))
    return [digit.view(np.int64) for digit in digits]


def _places(low: np.ndarray, span: np.ndarray, offset: np.ndarray) -> np.ndarray:
    return (low << 16) | (span << 8) | offset


BLOCK = T.StructType([T.StructField(n, T.LongType()) for n in ("core", *ORDER, "copy", "place")])


def _with_id(kind: T.DataType) -> T.StructType:
    return T.StructType([*BLOCK.fields, T.StructField("doc_id", kind)])


def _first_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    first = Ranges()
    for batch in batches:
        for part in parts(batch, "t", SLICE_BYTES):
            data, offsets = flat(part["t"])
            if len(data) <= 2 * PIECE:
                pieces = [(0, data, offsets, 0)]
            else:
                pieces = [
                    (i, data[a : min(a + PIECE + DEPTH - 1, z)], None, a - y)
                    for i, (y, z) in enumerate(zip(offsets.tolist(), offsets[1:].tolist()))
                    for a in range(y, max(y + 1, z - DEPTH + 1), PIECE)
                ]
            for row, piece, bounds, shift in pieces:
                bounds = np.array([0, len(piece)]) if bounds is None else bounds
                text, low, span, offset, core, digits = _runs(piece, bounds, first)
                rows = pa.array(text + row)
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, (core, *digits)), part["copy"].take(rows), pa.array(_places(low + shift, span, offset)), part["doc_id"].take(rows)],
                    names=["core", *ORDER, "copy", "place", "doc_id"],
                )


def _cut(width: int):
    """Blocks of the texts' unresolved blocks, cut to ``width`` windows by the place of the anchor."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = Ranges()
        for batch in batches:
            for part in parts(batch, "t", SLICE_BYTES):
                data, offsets = flat(part["t"])
                text = np.repeat(np.arange(part.num_rows), part["places"].value_lengths().to_numpy())
                place = part["places"].flatten().to_numpy()
                low, span, offset = place >> 16, (place >> 8) & 255, place & 255
                anchor = offsets[text] + low + span + offset
                cuts = (offset + span) // width - offset // width + 1
                of = np.repeat(np.arange(len(place)), cuts)
                start = (offset[of] // width + np.arange(len(of)) - np.repeat(np.cumsum(cuts) - cuts, cuts)) * width
                near, far = np.maximum(start, offset[of]), np.minimum(start + width - 1, offset[of] + span[of])
                at = anchor[of]
                core = first.hashes(first.sums(data), at - start, at - start - width + 1 + DEPTH)
                core = mixed(core + mixed((start * 256 + width).astype(U64))).view(np.int64)
                digits = _digits(data, at - far, at - near, near)
                rows = pa.array(text[of])
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, (core, *digits)), part["copy"].take(rows),
                     pa.array(_places(at - far - offsets[text[of]], far - near, near)), part["doc_id"].take(rows)],
                    names=["core", *ORDER, "copy", "place", "doc_id"],
                )

    return cut


def _groups(rows: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Groups of two and more: their keys (with ``_``), whether digits left differ (``differ``), and one of the rows."""
    left = F.xxhash64(*ORDER)
    groups = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min(left).alias("least"), F.max(left).alias("most"), F.min(_name()).alias("one")
    )
    # Stored, so that the join has two plain shuffles and a frequent anchor can be split.
    return stored(
        groups.filter("n > 1").select(*[F.col(key).alias(f"{key}_") for key in keys], (F.col("least") != F.col("most")).alias("differ"), "one"), label
    )


def _name() -> Column:
    """Stands for a block among equal ones; two that share it by chance would both be looked at further, no more."""
    return F.xxhash64("copy", "place", "doc_id")


def split_groups(blocks: DataFrame, digits: int) -> DataFrame:
    """Blocks that are not unique: ``doc_id, copy, place``, whether they are repeated as a whole (``done``),
    and whether the next cut takes them (``next``): those that are not, and one of each kind that others may share in part.
    """
    keys = ["core", *ORDER]
    anchors_of = _groups(blocks, ["core"], "anchors")
    shared = blocks.join(anchors_of, F.col("core") == F.col("core_"))
    passes = [
        stored(
            shared.select(
                "doc_id", "copy", "place", (~F.col("differ")).alias("done"), F.lit(False).alias("next"),
                *[F.when(F.col("differ"), F.col(key)).alias(key) for key in keys],
            ),
            "shared-blocks",
        )
    ]
    for n in range(1, digits + 1):
        rows = passes[-1].filter("core is not null")
        group = keys[: n + 1]
        judged = rows.join(_groups(rows, group, "groups"), [F.col(key) == F.col(f"{key}_") for key in group], "left")
        alone, more = F.col("core_").isNull(), F.coalesce(F.col("differ"), F.lit(False))
        passes.append(
            stored(
                judged.select(
                    "doc_id", "copy", "place", (~alone & ~more).alias("done"), (alone | (~more & (F.col("one") == _name()))).alias("next"),
                    *[F.when(more, F.col(key)).alias(key) for key in keys],
                ),
                "blocks",
            )
        )
    found = [rows.filter("core is null").select("doc_id", "copy", "place", "done", "next") for rows in passes]
    return reduce(DataFrame.unionAll, found)


def _rows(docs: DataFrame) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select("doc_id", F.xxhash64(text_of()).alias("copy"), text_of().alias("t"))


def _meet(rows: DataFrame, found: DataFrame, small: bool, how: str) -> DataFrame:
    """Documents with what was found about them; ``found`` has one row per id and text."""
    found = found.select(F.col("doc_id").alias("d"), F.col("copy").alias("c"), *[n for n in found.columns if n not in ("doc_id", "copy")])
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("copy") == F.col("c"))
    return rows.join(F.broadcast(found) if small else found, same, how)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of repeated blocks to removed runs, as starts and ends in turn."""
    for batch in batches:
        runs = []
        for places in batch["places"]:
            place = np.sort(places.values.to_numpy())
            low = place >> 16
            upto = np.maximum.accumulate(low + ((place >> 8) & 255) + DEPTH)
            apart = np.flatnonzero(low[1:] > upto[:-1])
            runs.append(np.stack([low[np.append(0, apart + 1)], upto[np.append(apart, len(low) - 1)]], axis=1).reshape(-1))
        lists = pa.array(runs, pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["copy"], lists], names=["doc_id", "copy", "runs"])


def _cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in parts(batch, "t", SLICE_BYTES):
            data, offsets = flat(part["t"])
            kept, spans = [], []
            for i, runs in enumerate(part["runs"].to_pylist()):
                raw = data[offsets[i] : offsets[i + 1]].tobytes()
                runs = runs or []
                bounds = [0, *runs, len(raw)]
                kept.append(b"".join(raw[a:b] for a, b in zip(bounds[::2], bounds[1::2])))
                spans.append([{"start": a, "end": b} for a, b in zip(runs[::2], runs[1::2])])
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"], pa.array(np.diff(offsets)), pa.array(kept, pa.binary()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                names=["doc_id", "n_bytes", "kept", "spans"],
            )


def repeated_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, copy, runs`` of the texts with repeated windows."""
    kind = docs.schema["doc_id"].dataType
    rows = _rows(docs)
    blocks, longest = rows.mapInArrow(_first_blocks, _with_id(kind)), DEPTH + DEPTH - GRAM
    done = []
    for width in (*WIDTHS, None):
        found = split_groups(blocks, -(-longest // DIGIT))
        done.append(found.filter("done"))
        if width is None:  # single windows: nothing is left to cut
            break
        left = stored(found.filter("next").groupBy("doc_id", "copy").agg(F.collect_set("place").alias("places")), "unresolved")
        n, places = left.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("places")), F.lit(0))).first()
        if not n:
            break
        small = n <= BROADCAST and places <= BROADCAST_PASSAGES
        blocks = _meet(rows, left, small, "inner").select("doc_id", "copy", "t", "places").mapInArrow(_cut(width), _with_id(kind))
        longest = DEPTH + width - 1
    repeated = reduce(DataFrame.unionAll, done)
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("copy", T.LongType()), T.StructField("runs", T.ArrayType(T.LongType()))])
    return repeated.groupBy("doc_id", "copy").agg(F.collect_set("place").alias("places")).mapInArrow(_merged, schema)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Per document: its bytes, what is kept of them, and the removed spans."""
    runs = stored(repeated_runs(docs), "repeated-runs")
    n, places = runs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("runs")), F.lit(0))).first()
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("n_bytes", T.LongType()),
        T.StructField("kept", T.BinaryType()), T.StructField("spans", T.ArrayType(span)),
    ])
    marked = _meet(_rows(docs), runs, n <= BROADCAST and places <= BROADCAST_PASSAGES, "left")
    return marked.select("doc_id", "t", "runs").mapInArrow(_cleaned, schema)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    def size(column: str) -> Column:
        return F.octet_length(column).cast("long")

    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - size("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )

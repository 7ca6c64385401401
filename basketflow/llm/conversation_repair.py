"""Repair of conversation structure by auction shortest paths.

A repaired conversation is empty, or an optional system message and then pairs of user and assistant. Rows
are kept (K, 0), given the role user or assistant (R, 3) or deleted (D, 4); messages without text are inserted
anywhere (I, 3); a row whose text is cut off costs 3 more unless it is deleted, and blank rows and copies of an
earlier row must be deleted. The cheapest edits are a shortest path through a lattice of (rows done, roles so far).

The path is found by auction. Every node has a price that is never above the length of an arc out of it plus the
price behind it. A path grows from its origin along an arc where the two are equal; where no arc is, the
price of its last node rises to the least that the arcs ask for, and the path falls back by that node. Origins are
taken from the last row to the first and prices are kept, so a path reaches settled nodes within a layer; a layer's
prices start at the least way on, a few steps below their end, and the work is linear in the rows. Converged prices
are the exact lengths to the end, hence the arcs that are tight are those of all shortest paths, and taking the least
letter at each node gives the least of them.

Rows are dealt by ranges of (conversation, turn, role, text), so a conversation of any size is spread over tasks; equal
rows travel as one with a count. A conversation inside one task is settled there. One that crosses tasks, or has
more than ``PIECE_ROWS`` rows, is cut into pieces: each piece's auction gives its lengths between all states, a pass
over these small numbers from the end sets the prices behind each piece, and each piece traces its edits for
each state it may be entered in. The last pass reads the pieces in order and picks the state; it holds one piece at a
time. The digest of one text can only be taken in order, which is why it is a pass.

Defined results: null roles and texts are one space; rows are taken by turn, null turns first, equal turns by role and text;
repeated rows are copies, deleted but the first; a null conv_id is a conversation like any other; an empty table
gives no rows. Only the four columns are read. The audit of a conversation is one string, as long as its rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketflow.llm.base import small_batches, stored, table

#: Rows and text bytes of a piece.
PIECE_ROWS = 4096
PIECE_CHARS = 8 << 20

REROLE, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3
#: Roles so far: none, system, user last, assistant last. What an inserted or reroled message leads to from each.
NEXT = (2, 2, 3, 2)
ROLE_AFTER = {2: "user", 3: "assistant"}
#: What a kept row leads to, by state and initial (s, u, a, other).
KEPT = ((1, 2, None, None), (None, 2, None, None), (None, None, 3, None), (None, 2, None, None))
#: Lengths from each state to the end once no row is left, and the letters.
AT_END = (0, 2 * INSERT, INSERT, 0)
LETTERS_AT_END = ("", "II", "I", "")
FAR = 1 << 40
_MUST_GO, _CUT = 4, 8
#: Neighbours that may stand together, by initials.
LEGAL = {(0, 1), (1, 2), (2, 1)}
BLANKS = " \t\n\x0b\f\r"


def onward(code: int, state: int) -> list[tuple[str, int, int]]:
    """Arcs that use up a row: letter, length, state behind; letters in order."""
    arcs = [("D", DELETE, state)]
    if not code & _MUST_GO:
        extra = CUT_OFF if code & _CUT else 0
        if KEPT[state][code & 3] is not None:
            arcs.append(("K", extra, KEPT[state][code & 3]))
        arcs.append(("R", REROLE + extra, NEXT[state]))
    return arcs


_ARCS = [[onward(code, state) for state in range(4)] for code in range(16)]


def auction(codes: bytes, behind: tuple[int, ...]) -> list[list[int]]:
    """Prices of all nodes, a list of four for each row and ``behind`` for the end: their exact distance to it."""
    prices = [list(behind)]
    for code in reversed(codes):
        ahead, arcs = prices[-1], _ARCS[code]
        row = [min(cost + ahead[to] for _, cost, to in arcs[state]) for state in range(4)]
        # As low as the cheapest way on, so no arc is longer than the difference of its prices; the steps up are few.
        price = [min(row)] * 4
        for origin in range(4):
            path = [origin]
            while True:
                node = path[-1]
                least = min(row[node], INSERT + price[NEXT[node]])
                if price[node] < least:
                    price[node] = min(least, FAR)  # contract
                    if price[node] == FAR:
                        break
                    if len(path) > 1:
                        path.pop()
                elif row[node] == least or least >= FAR:
                    break  # the settled layer: tight arcs lead on from here
                else:
                    path.append(NEXT[node])  # extend
        prices.append(price)
    prices.reverse()
    return prices


def trace(codes: bytes, prices: list[list[int]], state: int) -> tuple[str, int]:
    """The least letters along tight arcs from a state before the first row, and the state behind the last."""
    letters, i = [], 0
    while i < len(codes):
        price, ahead = prices[i][state], prices[i + 1]
        for letter, cost, to in _ARCS[codes[i]][state]:
            if letter > "I" and price == INSERT + prices[i][NEXT[state]]:
                letters.append("I")
                state = NEXT[state]
                break
            if price == cost + ahead[to]:
                letters.append(letter)
                state = to
                i += 1
                break
        else:
            letters.append("I")
            state = NEXT[state]
    return "".join(letters), state


@lru_cache(1 << 15)
def settled(codes: bytes) -> tuple[int, str]:
    """Cost and letters of a whole conversation."""
    prices = auction(codes, AT_END)
    letters, state = trace(codes, prices, 0)
    return prices[0][0], letters + LETTERS_AT_END[state]


def distances(codes: bytes) -> list[int]:
    """Lengths between the states before and behind a piece, 16 of them; ``FAR`` where no edits lead."""
    out = [FAR] * 16
    for end in range(4):
        # No edit leads back to the states before the first user message; nodes that would are left out.
        if end < 2:
            lengths = _early(codes, end)
        else:
            lengths = auction(codes, tuple(0 if s == end else FAR for s in range(4)))[0]
        for start in range(4):
            out[4 * start + end] = min(lengths[start], FAR)
    return out


def _early(codes: bytes, end: int) -> list[int]:
    """From nothing to nothing all rows go; to a system message one row is kept."""
    alone = DELETE * len(codes)
    system = [_ARCS[c][0][1][1] - DELETE for c in codes if not c & (_MUST_GO | 3)]
    if end == 0:
        return [alone, FAR, FAR, FAR]
    return [alone + min(system, default=FAR), alone, FAR, FAR]


def messages(codes: bytes, letters: str, state: int, kept: Iterator[tuple[str, str]]) -> list[tuple[str, str]]:
    """The repaired messages; ``kept`` gives role and text of the rows that need not go."""
    out, i = [], 0
    for letter in letters:
        if letter == "I":
            state = NEXT[state]
            out.append((ROLE_AFTER[state], ""))
            continue
        code = codes[i]
        i += 1
        row = None if code & _MUST_GO else next(kept)
        if letter == "K":
            state = KEPT[state][code & 3]
            out.append(row)
        elif letter == "R":
            state = NEXT[state]
            out.append((ROLE_AFTER[state], row[1]))
    return out


class _Piece:
    """Rows of a conversation that follow each other."""

    def __init__(self, conv, part: int, place: int) -> None:
        self.conv, self.place = conv, (part << 33) + place
        self.codes, self.roles, self.texts = bytearray(), [], []
        self.blank = self.duplicate = self.truncated = self.chars = self.turns = 0
        self.low = self.high = None

    def add(self, turn, role: str, text: str, code: int, blank: bool, first: bool, copies: int, new: bool) -> None:
        """``copies`` equal rows; ``new`` if the first of them is in this piece."""
        lost = blank or not first or not new
        self.codes += bytes([code | _MUST_GO if lost else code]) + bytes([code | _MUST_GO]) * (copies - 1)
        if blank:
            self.blank += copies
        else:
            self.duplicate += copies - (not lost)
            self.truncated += (not lost) and bool(code & _CUT)
        if not lost:
            self.roles.append(role)
            self.texts.append(text)
            self.chars += len(text)
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = turn

    def row(self, whole: bool) -> dict:
        codes = bytes(self.codes)
        initials = [c & 3 for c in codes]
        cost, audit = settled(codes) if whole else (None, None)
        return {
            "conv_id": self.conv, "place": self.place, "whole": whole, "codes": codes, "roles": self.roles, "texts": self.texts,
            "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated,
            "illegal": sum(pair not in LEGAL for pair in zip(initials, initials[1:])),
            "low": self.low, "high": self.high, "turns": self.turns,
            "cost": cost, "audit": audit, "lengths": None if whole else distances(codes),
        }


_FAULTS = ["blank", "duplicate", "truncated", "illegal"]


def _piece_schema(conv: T.StructField, turn: T.DataType) -> T.StructType:
    return T.StructType([
        conv, T.StructField("place", T.LongType()), T.StructField("whole", T.BooleanType()), T.StructField("codes", T.BinaryType()),
        T.StructField("roles", T.ArrayType(T.StringType())), T.StructField("texts", T.ArrayType(T.StringType())),
        *[T.StructField(name, T.LongType()) for name in _FAULTS],
        T.StructField("low", turn), T.StructField("high", turn), T.StructField("turns", T.LongType()),
        T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType()), T.StructField("lengths", T.ArrayType(T.LongType())),
    ])


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _cut(schema: pa.Schema):
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a task in order to conversations and pieces. The task's first and last conversation may go on in
        another task, so they are pieces."""
        open_piece: _Piece | None = None
        whole, place, held, out, chars = False, 0, None, [], 0
        for batch in batches:
            columns = [batch[name].to_pylist() for name in ("conv_id", "part", "turn", "role", "text", "code", "blank", "first", "copies")]
            for conv, part, turn, role, text, code, blank, first, copies in zip(*columns):
                if open_piece is None or open_piece.conv != conv:
                    if open_piece is not None:
                        out.append(open_piece.row(whole))
                        chars += open_piece.chars
                        whole = True
                    open_piece = _Piece(conv, part, place)
                new = True
                while copies:
                    if len(open_piece.codes) >= PIECE_ROWS or open_piece.chars >= PIECE_CHARS:
                        out.append(open_piece.row(False))
                        chars += open_piece.chars
                        whole, open_piece = False, _Piece(conv, part, place)
                    taken = min(copies, PIECE_ROWS - len(open_piece.codes))
                    open_piece.add(turn, role, text, code, blank, first, taken, new)
                    new, copies, place = False, copies - taken, place + 1
                if chars >= PIECE_CHARS or len(out) >= 4096:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out, chars = [], 0
        if open_piece is not None:
            out.append(open_piece.row(False))
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    return pieces


def _behind(schema: pa.Schema):
    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """From a conversation's last piece to its first: the prices behind each."""
        conv, prices, fresh = None, AT_END, True
        for batch in batches:
            out = []
            for key, place, lengths in zip(*[batch[n].to_pylist() for n in ("conv_id", "place", "lengths")]):
                last = fresh or key != conv
                if last:
                    conv, prices, fresh = key, AT_END, False
                out.append({"conv_id": key, "place": place, "last": last, "behind": list(prices)})
                prices = tuple(min(lengths[4 * s + e] + prices[e] for e in range(4)) for s in range(4))
            yield pa.RecordBatch.from_pylist(out, schema)

    return passed


def _traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each piece's edits for each state it may be entered in: lengths to the end, letters, states behind."""
    for batch in batches:
        lengths, letters, ends = [], [], []
        for codes, behind in zip(batch["codes"].to_pylist(), batch["behind"].to_pylist()):
            prices = auction(codes, tuple(behind))
            traces = [trace(codes, prices, state) if prices[0][state] < FAR else ("", state) for state in range(4)]
            lengths.append(prices[0])
            letters.append([t[0] for t in traces])
            ends.append([t[1] for t in traces])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(lengths, pa.list_(pa.int64())), pa.array(letters, pa.list_(pa.string())), pa.array(ends, pa.list_(pa.int32()))],
            names=[*batch.schema.names, "lengths", "letters", "ends"],
        )


_MESSAGES = T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]))


def _part_schema(conv: T.StructField) -> T.StructType:
    return T.StructType([
        conv, T.StructField("part", T.LongType()), T.StructField("last", T.BooleanType()), T.StructField("messages", _MESSAGES),
        T.StructField("audit", T.StringType()), T.StructField("cost", T.LongType()), T.StructField("gaps", T.LongType()),
        *[T.StructField(name, T.LongType()) for name in _FAULTS], T.StructField("sha256", T.StringType()),
    ])


class _Reading:
    """A conversation read piece by piece."""

    def __init__(self) -> None:
        self.state, self.part, self.digest, self.said = 0, 0, hashlib.sha256(), False
        self.low = self.high = self.initial = None
        self.turns = 0

    def read(self, row: dict, audit: str, cost: int | None, last: bool) -> dict:
        codes = row["codes"]
        said = messages(codes, audit, self.state, iter(zip(row["roles"], row["texts"])))
        for role, text in said:
            self.digest.update(("\n" if self.said else "").encode() + f"{role}:{text}".encode())
            self.said = True
        illegal = row["illegal"] + (self.initial is not None and (self.initial, codes[0] & 3) not in LEGAL)
        self.initial = codes[-1] & 3
        if row["turns"]:
            self.turns += row["turns"] - (row["low"] == self.high)
            self.low = row["low"] if self.low is None else self.low
            self.high = row["high"]
        out = {
            "conv_id": row["conv_id"], "part": self.part, "last": last, "messages": [{"role": r, "text": t} for r, t in said],
            "audit": audit, "cost": cost, "gaps": self.high - self.low + 1 - self.turns if last and self.turns else 0,
            **{name: row[name] for name in _FAULTS}, "illegal": illegal, "sha256": self.digest.hexdigest() if last else None,
        }
        self.part += 1
        return out


def _whole(schema: pa.Schema):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pylist([_Reading().read(row, row["audit"], row["cost"], True) for row in batch.to_pylist()], schema)

    return read


def _in_order(schema: pa.Schema):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pieces in order, each entered in the state that the one before leaves."""
        reading: _Reading | None = None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                reading = reading or _Reading()
                audit, end = row["letters"][reading.state], row["ends"][reading.state]
                if row["last"]:
                    audit += LETTERS_AT_END[end]
                # The whole cost is the first price of all.
                out.append(reading.read(row, audit, row["lengths"][0] if not reading.part else 0, row["last"]))
                reading.state = end
                if row["last"]:
                    reading = None
            yield pa.RecordBatch.from_pylist(out, schema)

    return read


def ordered(rows: DataFrame) -> DataFrame:
    """Rows in order within ranges, equal ones as one: ``conv_id, part, turn, role, text, code, blank, first, copies``."""
    spoken = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    distinct = spoken.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
    owner = F.coalesce(F.col("conv_id").cast("string"), F.lit("none"))
    said = F.unhex(F.md5(F.concat_ws(":", owner, F.length("role").cast("string"), F.concat("role", "text"))))
    distinct = distinct.withColumn("said", said)
    earliest = distinct.groupBy("said").agg(F.max(F.col("turn").isNull()).alias("untimed"), F.min("turn").alias("earliest"))
    first = F.col("turn").isNull() | (~F.col("untimed") & (F.col("turn") == F.col("earliest")))
    ended = F.rtrim(F.col("text"), F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    cut_off = F.when(F.substring(ended, -1, 1).isin(".", "!", "?"), 0).otherwise(_CUT)
    marked = distinct.join(earliest, "said").select(
        "conv_id", "turn", "role", "text", "copies", (ended == "").alias("blank"), first.alias("first"), (kind + cut_off).alias("code")
    )
    places = [F.col("conv_id"), F.col("turn"), F.col("role")]
    dealt = marked.repartitionByRange(*places, F.substring("text", 1, 200)).sortWithinPartitions(*places, "text")
    return dealt.select("*", F.spark_partition_id().alias("part"))


def repaired(rows: DataFrame) -> DataFrame:
    """Repaired conversations, in parts ``conv_id, part, last, messages, audit, cost, gaps, blank, duplicate, truncated,
    illegal, sha256``. Nearly all have one part; numbers add up over parts, and the last has the digest."""
    small_batches(rows.sparkSession)
    conv, turn = rows.schema["conv_id"], rows.schema["turn"].dataType
    piece_schema, part_schema = _piece_schema(conv, turn), _part_schema(conv)
    pieces = stored(ordered(rows).mapInArrow(_cut(_arrow(piece_schema)), piece_schema), "conversation-pieces")
    whole = pieces.filter("whole").mapInArrow(_whole(_arrow(part_schema)), part_schema)

    crossing = pieces.filter("not whole").drop("whole", "audit", "cost")
    behind_schema = T.StructType([conv, T.StructField("place", T.LongType()), T.StructField("last", T.BooleanType()), T.StructField("behind", T.ArrayType(T.LongType()))])
    backward = crossing.select("conv_id", "place", "lengths").repartition("conv_id").sortWithinPartitions("conv_id", F.desc("place"))
    behind = stored(backward.mapInArrow(_behind(_arrow(behind_schema)), behind_schema), "conversation-prices")
    known = crossing.drop("lengths").join(behind.withColumnRenamed("conv_id", "of"), "place").drop("of")
    traced_schema = T.StructType([
        *known.schema.fields, T.StructField("lengths", T.ArrayType(T.LongType())), T.StructField("letters", T.ArrayType(T.StringType())),
        T.StructField("ends", T.ArrayType(T.IntegerType())),
    ])
    forward = known.mapInArrow(_traced, traced_schema).repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return whole.unionAll(forward.mapInArrow(_in_order(_arrow(part_schema)), part_schema))


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with the faults that a checksum of conversation and turn picks: one in twenty each is dropped, emptied,
    stripped of sentence ends, repeated, or given the role user."""
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    fault = F.crc32(F.encode(F.concat(shown[0], F.lit(":"), shown[1]), "UTF-8")) % 20
    text, role = (F.coalesce(F.col(c), F.lit(" ")) for c in ("text", "role"))
    hurt = rows.select(
        "conv_id", "turn",
        F.when(fault == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(fault == 1, F.lit("")).when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("times"),
    )
    return hurt.filter("times > 0").select("conv_id", "turn", "role", "text", F.explode(F.sequence(F.lit(1), "times"))).drop("col")


_NUMBERS = ["gaps", *_FAULTS, "cost"]


def digests(conversations: DataFrame, parts: DataFrame) -> DataFrame:
    """One row for each conversation, also for those without a row left."""
    one = (F.col("part") == 0) & F.col("last")
    single = parts.filter(one).select(F.col("conv_id").alias("of"), *_NUMBERS, "audit", F.col("sha256").alias("repaired_sha256"))
    letters = F.array_sort(F.collect_list(F.struct("part", "audit")))
    several = (
        parts.filter(~one)
        .groupBy(F.col("conv_id").alias("of"))
        .agg(
            *[F.sum(name).alias(name) for name in _NUMBERS],
            F.array_join(F.transform(letters, lambda p: p["audit"]), "").alias("audit"),
            F.max("sha256").alias("repaired_sha256"),
        )
    )
    found = single.unionAll(several)
    every = conversations.select("conv_id").distinct()

    def or_else(name: str, value: Column) -> Column:
        return F.coalesce(name, value).alias(name)

    return every.join(found.withColumn("found", F.lit(True)), every["conv_id"].eqNullSafe(found["of"]), "left").select(
        "conv_id",
        *[or_else(name, F.lit(0).cast("bigint")) for name in ["gaps", *_FAULTS, "cost"]],
        or_else("audit", F.lit("")),
        or_else("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())),
    )


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return digests(conversations, stored(repaired(damaged(conversations)), "repaired-conversations"))

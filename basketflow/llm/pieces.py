"""SentencePiece encoding and decoding with a public vocabulary.

An Aho-Corasick automaton over the pieces reads a text once; at each position its output links name every piece
that ends there, and each relaxes that position (Viterbi). What it relaxes depends on the model's scores.

In a unigram model they are log probabilities: the best score of a position is the highest sum, and the result the
segmentation with the highest one; between equal sums the longest last piece wins.

In a BPE model they are ranks of merges, and the library's segmentation is the one that merging leads to, best rank and
leftmost first. Of all ways to cut a prefix only one is what merging gives, so each position has one best last piece: the
piece that ends there and is compatible with the best last piece of the prefix in front of it. Two pieces are compatible
if undoing the merges that made them, the latest first, meets no pair across their border that merging would have
joined earlier; each piece's last merge is kept in a table for that, and answers are memoised. So one pass gives the
model's own ids without merging anything, in time linear in the matches.

In both forms characters without a piece become byte pieces. No piece has a word mark after another
character, so a text falls apart before each run of marks and
the pieces of a run with its word are looked up once and kept in a bounded memo. A vocabulary without
that property is read as one run.

Decoding joins the pieces, turns marks into spaces and drops the one in front. ``decode(encode(t))``
is ``t`` for every text; a literal U+2581 becomes a space, as the format has no other sign for it.

Defined results: a null text is an empty one; an empty text has no pieces; a null list of ids decodes
to an empty text; repeated rows and empty tables need no care. Other columns pass through ``encode``
unread, and the new ones get a free name.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketflow.llm.base import small_batches, table, text_of
from basketflow.llm.bytehash import parts

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Runs kept per generation of the memo of a worker; there are two.
MEMO = 250_000
#: Pairs of pieces kept with whether they are compatible.
PAIRS = 1_000_000
#: In place of a piece: a character that has none.
NONE = -1
#: Texts of so many bytes are encoded at a time.
SLICE_BYTES = 4 << 20
IDS = T.ArrayType(T.IntegerType())


def vocabulary(path: str = VOCABULARY) -> dict:
    """Pieces, scores and byte pieces of a model file: plain values, a few hundred kB, for a broadcast."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as model_pb

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    proto = model_pb.ModelProto()
    proto.ParseFromString(model.serialized_model_proto())
    merges = proto.trainer_spec.model_type == model_pb.TrainerSpec.BPE
    odd = {model_pb.ModelProto.SentencePiece.USER_DEFINED, model_pb.ModelProto.SentencePiece.UNUSED}
    if merges and (any(piece.type in odd for piece in proto.pieces) or not any(map(model.is_byte, ids))):
        raise ValueError("a BPE model needs byte pieces and may have no user-defined or unused ones")
    special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in ids]
    return {
        "pieces": [model.id_to_piece(i) for i in ids],
        "scores": [model.get_score(i) for i in ids],
        "plain": [not special[i] and not model.is_byte(i) for i in ids],
        "bytes": {int(model.id_to_piece(i)[3:5], 16): i for i in ids if model.is_byte(i)},
        "unknown": model.unk_id(),
        "merges": merges,
    }


class Borders:
    """Which pieces of a BPE model may stand side by side."""

    def __init__(self, pieces: dict[str, int], scores: list[float]) -> None:
        self.ids = pieces
        self.texts = {i: piece for piece, i in pieces.items()}
        #: Rank of the merge that makes a piece; single characters are there from the start.
        self.rank = {i: -scores[i] if len(piece) > 1 else -1.0 for piece, i in pieces.items()}
        self.split: dict[int, tuple[int, int]] = {}
        self.known: dict[tuple[int, int], bool] = {}
        for piece, i in sorted(pieces.items(), key=lambda pair: (self.rank[pair[1]], len(pair[0]))):
            if len(piece) > 1:
                found = next((pair for pair in self._halves(piece, self.rank[i]) if self._open(*pair, self.rank[i])), None)
                if found:
                    self.split[i] = found

    def reachable(self, piece: int) -> bool:
        """Whether merging ever gives this piece."""
        return self.rank[piece] < 0 or piece in self.split

    def _halves(self, piece: str, rank: float) -> Iterator[tuple[int, int]]:
        for at in range(1, len(piece)):
            pair = self.ids.get(piece[:at]), self.ids.get(piece[at:])
            if None not in pair and all(self.rank[half] <= rank and self.reachable(half) for half in pair):
                yield pair

    def _open(self, left: int, right: int, limit: float) -> bool:
        """Whether no merge across the border of two pieces comes before ``limit`` and the merges that made them."""
        while True:
            union = self.ids.get(self.texts[left] + self.texts[right])
            if union is not None and self.rank[union] < limit:
                return False
            if self.rank[left] > self.rank[right]:
                limit, left = self.rank[left], self.split[left][1]
            elif right in self.split:
                # Of equal merges the one further left comes first.
                limit, right = np.nextafter(self.rank[right], np.inf), self.split[right][0]
            else:
                return True

    def compatible(self, left: int, right: int) -> bool:
        if left == NONE:
            return True
        found = self.known.get((left, right))
        if found is None:
            if len(self.known) >= PAIRS:
                self.known.clear()
            found = self.known[left, right] = self._open(left, right, np.inf)
        return found


class _Memo(dict):
    """Encoded runs by text; the older of two generations is dropped when the younger is full."""

    def __init__(self, encode) -> None:
        super().__init__()
        self.encode, self.older = encode, {}

    def __missing__(self, run: str) -> bytes:
        found = self.older.get(run)
        if found is None:
            found = self.encode(run)
        if len(self) >= MEMO:
            self.older = dict(self)
            self.clear()
        if len(run) <= 64:
            self[run] = found
        return found


class Codec:
    """One worker's automaton, memo and decoding table; ``merges`` tells that scores are ranks of merges."""

    def __init__(self, words: dict, merges: bool = False) -> None:
        self.automaton = ahocorasick.Automaton()
        self.single: set[str] = set()
        known = {p: i for i, (p, is_plain) in enumerate(zip(words["pieces"], words["plain"])) if is_plain}
        self.borders = Borders(known, words["scores"]) if merges else None
        for i, piece in enumerate(words["pieces"]):
            if words["plain"][i] and (not merges or self.borders.reachable(i)):
                self.automaton.add_word(piece, (i, len(piece), words["scores"][i]))
                if len(piece) == 1:
                    self.single.add(piece)
        self.automaton.make_automaton()
        plain = [piece for piece, is_plain in zip(words["pieces"], words["plain"]) if is_plain]
        self.apart = not any(MARK in piece.lstrip(MARK) for piece in plain)
        self.runs = re.compile(f"{MARK}+[^{MARK}]*" if self.apart else "(?s).+").findall
        self.unknown_score = min(s for s, is_plain in zip(words["scores"], words["plain"]) if is_plain) - 10
        self.bytes, self.unknown = words["bytes"], words["unknown"]
        segment = self.by_borders if merges else self.viterbi
        self.memo = _Memo(segment)
        self.by_word = _Memo(lambda word: segment(MARK + word))
        self.lengths_of = [len(p) for p in words["pieces"]]
        self.table = [p.encode() for p in words["pieces"]]
        for i, (piece, is_plain) in enumerate(zip(words["pieces"], words["plain"])):
            if not is_plain:
                self.table[i] = b""
        for value, i in self.bytes.items():
            self.table[i] = bytes([value])
        self.table = [piece.replace(MARK.encode(), b" ") for piece in self.table]
        self.lengths = np.array([len(piece) for piece in self.table])
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes_of = np.frombuffer(b"".join(self.table), np.uint8)

    def viterbi(self, run: str) -> bytes:
        """The ids of the best segmentation, as the bytes of 32-bit numbers."""
        n = len(run)
        best = [0.0] + [-np.inf] * n
        step = [None] * (n + 1)
        if self.single.issuperset(run):
            for last, found in self.automaton.iter(run):
                total = best[last + 1 - found[1]] + found[2]
                if total > best[last + 1]:
                    best[last + 1], step[last + 1] = total, found
        else:
            self._with_unknown(run, best, step)
        ids: list[int] = []
        while n:
            piece, length, _ = step[n]
            if piece >= 0:
                ids.append(piece)
            else:
                raw = run[n - 1].encode("utf-8", "surrogatepass")
                ids += [self.bytes.get(b, self.unknown) for b in reversed(raw)]
            n -= length
        ids.reverse()
        return array("i", ids).tobytes()

    def by_borders(self, run: str) -> bytes:
        """The ids that merging leads to: of the pieces that end at a place, the one that is compatible with the best last
        piece of the prefix in front of it. As the bytes of 32-bit numbers."""
        last: list[int | None] = [NONE] + [None] * len(run)
        compatible, known = self.borders.compatible, self.borders.known.get
        if not self.single.issuperset(run):
            for end, char in enumerate(run, 1):
                if char not in self.single:
                    last[end] = NONE
        settled = -1
        for at, (piece, length, _) in self.automaton.iter(run):
            if at == settled:
                continue
            before = last[at + 1 - length]
            if before is None:
                continue
            if before >= 0:
                fits = known((before, piece))
                if not (compatible(before, piece) if fits is None else fits):
                    continue
            last[at + 1], settled = piece, at
        ids: list[int] = []
        end = len(run)
        while end:
            piece = last[end]
            if piece == NONE:
                ids += [self.bytes[b] for b in reversed(run[end - 1].encode("utf-8", "surrogatepass"))]
                end -= 1
            else:
                ids.append(piece)
                end -= self.lengths_of[piece]
        ids.reverse()
        return array("i", ids).tobytes()

    def _with_unknown(self, run: str, best: list[float], step: list) -> None:
        """The same relaxation for a run with characters that are no pieces."""
        matches = self.automaton.iter(run)
        match = next(matches, None)
        for end in range(1, len(run) + 1):
            if run[end - 1] not in self.single:
                best[end], step[end] = best[end - 1] + self.unknown_score, (-1, 1, self.unknown_score)
            while match is not None and match[0] == end - 1:
                found = match[1]
                total = best[end - found[1]] + found[2]
                if total > best[end]:
                    best[end], step[end] = total, found
                match = next(matches, None)

    def encode(self, text: str) -> bytes:
        words = text.split(" ")
        if self.apart and "" not in words and MARK not in text:  # a mark before each word
            return b"".join(map(self.by_word.__getitem__, words))
        marked = MARK + text.replace(" ", MARK) if text else ""
        return b"".join(map(self.memo.__getitem__, self.runs(marked)))

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.table.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def codec_of(words) -> Codec:
    """The worker's codec, kept beside the broadcast vocabulary for the worker's next tasks."""
    held = words.value
    if "codec" not in held:
        held["codec"] = Codec(held, held["merges"])
    return held["codec"]


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places ``start, start + 1, ...`` of every run, one after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


def _encode_plain(codec: Codec, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids and offsets of texts whose words are apart by one space: each distinct word is looked up once."""
    lists = pc.split_pattern(texts, " ")
    coded = lists.flatten().dictionary_encode()
    word = coded.indices.to_numpy()
    found = list(map(codec.by_word.__getitem__, coded.dictionary.to_pylist()))
    sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
    pool = np.frombuffer(b"".join(found), np.int32)
    lengths = sizes[word]
    ids = pool[_spread((np.cumsum(sizes) - sizes)[word], lengths)]
    upto = np.concatenate([[0], np.cumsum(lengths)])
    words = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
    return ids, upto[words]


def encode_texts(codec: Codec, texts: pa.Array) -> pa.Array:
    """Lists of ids; offsets are 32-bit, so callers pass slices of a few MB."""
    texts = pc.fill_null(texts, "")
    odd = pc.match_substring_regex(texts, f"^$|^ |  | $|{MARK}").to_numpy(zero_copy_only=False)
    if not codec.apart:
        odd[:] = True
    ids, offsets = _encode_plain(codec, texts.filter(pa.array(~odd)))
    if odd.any():
        singly = {i: np.frombuffer(codec.encode(texts[i].as_py()), np.int32) for i in np.flatnonzero(odd).tolist()}
        plain = iter(zip(offsets, offsets[1:]))
        lists = [singly[i] if i in singly else ids[slice(*next(plain))] for i in range(len(texts))]
        ids, offsets = np.concatenate(lists), np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))


def decode_ids(codec: Codec, ids: pa.Array) -> pa.Array:
    """The texts of lists of ids; bytes that are no UTF-8 become replacement characters."""
    counts = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = ids.flatten().to_numpy()
    lengths = codec.lengths[flat]
    data = codec.bytes_of[_spread(codec.starts[flat], lengths)]
    upto = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(counts)])]
    # The space in front of a text stands for no character of it.
    front = upto[:-1][(counts > 0)]
    front = front[data[front] == 0x20] if len(data) else front[:0]
    keep = np.ones(len(data), bool)
    keep[front] = False
    offsets = upto - np.searchsorted(front, upto)
    texts = pa.StringArray.from_buffers(len(ids), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data[keep]))
    try:
        texts.validate(full=True)
    except pa.ArrowInvalid:
        return pa.array([codec.decode(row or []) for row in ids.to_pylist()], pa.string())
    return texts


def _encoder(words, text: str, names: list[str], check: bool):
    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(words)
        for batch in batches:
            for part in parts(batch, text, SLICE_BYTES):
                ids = encode_texts(codec, part[text])
                columns = [part[name] for name in names] + [ids]
                if check:
                    plain = pc.fill_null(pc.replace_substring(part[text], MARK, " "), "")
                    columns += [pc.list_value_length(ids).cast(pa.int64()), pc.equal(decode_ids(codec, ids), plain)]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "ids", *(["n", "same"] if check else [])])

    return encoded


def encode(docs: DataFrame, *, text: str = "text", path: str = VOCABULARY, into: str = "token_ids") -> DataFrame:
    """``docs`` with all its columns and the ids of the text's pieces."""
    if into.lower() in {name.lower() for name in docs.columns}:
        raise ValueError(f"choose another name than {into} for the ids")
    small_batches(docs.sparkSession)
    words = docs.sparkSession.sparkContext.broadcast(vocabulary(path))
    numbered = [F.col(f"`{name}`").alias(f"c{i}") for i, name in enumerate(docs.columns)]
    rows = docs.select(*numbered, text_of(text).alias("t"))
    names = [f"c{i}" for i in range(len(docs.columns))]
    schema = T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, docs.schema)]).add("ids", IDS)
    out = rows.mapInArrow(_encoder(words, "t", names, False), schema)
    return out.select(*[F.col(n).alias(name) for n, name in zip(names, docs.columns)], F.col("ids").alias(into))


def decode(rows: DataFrame, *, ids: str = "token_ids", path: str = VOCABULARY) -> DataFrame:
    """``(doc_id, text)`` of rows with ``doc_id`` and lists of ids."""
    words = rows.sparkSession.sparkContext.broadcast(vocabulary(path))

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(words)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                yield pa.RecordBatch.from_arrays([part["doc_id"], decode_ids(codec, part["ids"])], names=["doc_id", "text"])

    schema = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("text", T.StringType())])
    return rows.select("doc_id", F.col(ids).alias("ids")).mapInArrow(decoded, schema)


def round_trip(docs: DataFrame, *, text: str = "text", path: str = VOCABULARY) -> DataFrame:
    """Per document its ids, their number, and whether they decode to the text again."""
    small_batches(docs.sparkSession)
    words = docs.sparkSession.sparkContext.broadcast(vocabulary(path))
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType)])
    schema.add("token_ids", IDS).add("n_tokens", T.LongType()).add("round_trip", T.BooleanType())
    rows = docs.select("doc_id", text_of(text).alias("t"))
    return rows.mapInArrow(_round_tripper(words), schema)


def _round_tripper(words):
    inner = _encoder(words, "t", ["doc_id"], True)

    def tripped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in inner(batches):
            yield batch.rename_columns(["doc_id", "token_ids", "n_tokens", "round_trip"])

    return tripped


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))

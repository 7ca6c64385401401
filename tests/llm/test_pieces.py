import pytest
import sentencepiece

from basketflow.llm.pieces import MARK, VOCABULARY, Codec, decode, encode, op6_sentencepiece, vocabulary

TEXTS = [
    "", " ", "a", "The cat sat on the mat.", "Étion dans, çouelle un éonierç", "Nicht aulich für sch erüver",
    "line\nbreak\ttab", "  two  spaces  ", "emoji 😀 and 漢字 and \u0000", "x" * 3000, "word " * 2000, "a▁b", "é",
]


@pytest.fixture(scope="module")
def codec():
    return Codec(vocabulary())


def ids_of(codec, text):
    import numpy as np

    return np.frombuffer(codec.encode(text), np.int32).tolist()


@pytest.mark.parametrize("text", TEXTS)
def test_round_trip(codec, text):
    assert codec.decode(ids_of(codec, text)) == text.replace(MARK, " ")


def test_library_agrees(codec):
    """The library's own Viterbi on the same pieces and scores finds no better segmentation and reads ours."""
    from sentencepiece import sentencepiece_model_pb2 as model_pb

    proto = model_pb.ModelProto()
    with open(VOCABULARY, "rb") as source:
        proto.ParseFromString(source.read())
    proto.trainer_spec.model_type = 1
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    scores = vocabulary()["scores"]
    for text in ["The cat sat on the mat.", "Étion dans, çouelle un éonierç", "Nicht aulich für sch erüver enau", "thndont whre and thhehe"]:
        ours, theirs = ids_of(codec, text), library.encode(text)
        assert sum(scores[i] for i in ours) >= sum(scores[i] for i in theirs)
        assert library.decode(ours) == text


def test_brute_force(codec):
    """Every segmentation of short runs: none has a higher score."""
    words = vocabulary()
    known = {p: s for p, s, plain in zip(words["pieces"], words["scores"], words["plain"]) if plain}

    def best(run):
        return max(
            (known[run[:k]] + best(run[k:]) for k in range(1, len(run) + 1) if run[:k] in known), default=-1e18
        ) if run else 0

    for word in ["theand", "erstion", "ingth", "ouéa"]:
        score = sum(words["scores"][i] for i in ids_of(codec, word))
        assert score == pytest.approx(best(MARK + word))


def test_memo_is_bounded_and_exact(codec, monkeypatch):
    import basketflow.llm.pieces as module

    monkeypatch.setattr(module, "MEMO", 3)
    small = Codec(vocabulary())
    for text in ["a b c d e f g a b c", "f g h a"]:
        assert ids_of(small, text) == ids_of(codec, text)
    assert len(small.memo) <= 3


def test_tables(spark):
    rows = [(i, t, "kept", [7]) for i, t in enumerate(TEXTS)] + [(90, None, None, None), (None, "the end", "x", []), (1, " ", "x", [])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, c0 array<int>")
    out = encode(docs)
    assert out.columns == ["doc_id", "text", "ids", "c0", "token_ids"]
    back = {(r.doc_id, r.text) for r in decode(out).collect()}
    assert back == {(i, (t or "").replace(MARK, " ")) for i, t, _, _ in rows}
    assert out.filter("ids = 'kept'").count() == len(TEXTS)
    assert encode(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        encode(out)


def test_query(spark):
    rows = op6_sentencepiece(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 200 and all(r.round_trip and r.n_tokens == len(r.token_ids) for r in rows)


def test_batches_agree_with_single_texts(codec):
    """The batch forms, with odd and plain texts mixed, against one text at a time."""
    import pyarrow as pa

    from basketflow.llm.pieces import decode_ids, encode_texts

    lists = encode_texts(codec, pa.array([*TEXTS, None]))
    assert lists.to_pylist() == [ids_of(codec, t) for t in [*TEXTS, ""]]
    assert decode_ids(codec, lists).to_pylist() == [t.replace(MARK, " ") for t in [*TEXTS, ""]]
    broken = pa.array([[3 + 0xE2], [], None, [3 + 0x41]], pa.list_(pa.int32()))
    assert decode_ids(codec, broken).to_pylist() == ["�", "", "", "A"]
    assert encode_texts(codec, pa.array([], pa.string())).to_pylist() == []


def test_one_pass_gives_the_ids_of_the_library():
    """The unpatched library and ours on the BPE model as it is."""
    import random

    words = vocabulary()
    assert words["merges"]
    library, merging = sentencepiece.SentencePieceProcessor(model_file=VOCABULARY), Codec(words, merges=True)
    assert [library.id_to_piece(i) for i in ids_of(merging, "The cat sat")] == ["▁The", "▁cat", "▁sat"]
    draw = random.Random(7)
    parts = ["a", "b", "the", " ", "  ", "é", "漢", "😀", MARK, "\n", "\u0000", "x", "in", "er", "́", "1"]
    mixed = ["".join(draw.choices(parts, k=draw.choice([3, 20, 200]))) for _ in range(300)]
    letters = ["".join(draw.choices("aeinrst▁", k=draw.choice([5, 30]))) for _ in range(2000)]
    for text in [*TEXTS, *mixed, *letters, "ab" * 3000, " " * 100, "aaaa" * 20, "e" * 501]:
        assert ids_of(merging, text) == library.encode(text), text


def test_the_query_follows_output_links(spark, monkeypatch):
    """What a worker runs on a BPE model: each match of the automaton is looked at once, nothing is merged."""
    import basketflow.llm.pieces as module

    codec = module.Codec(vocabulary(), merges=True)
    run = MARK + "internationalisation"
    codec.by_borders(run)
    assert 0 < len(codec.borders.known) <= sum(1 for _ in codec.automaton.iter(run))
    assert codec.memo.encode == codec.by_borders and not [name for name in dir(codec) if "merge" in name]


def test_pairs_are_kept_within_bounds(monkeypatch):
    import basketflow.llm.pieces as module

    monkeypatch.setattr(module, "PAIRS", 5)
    small, large = module.Codec(vocabulary(), merges=True), module.Codec(vocabulary(), merges=True)
    text = "The cat sat on the mat while wizards mixed potions"
    assert ids_of(small, text) == sentencepiece.SentencePieceProcessor(model_file=VOCABULARY).encode(text)
    assert len(small.borders.known) <= 5 and large is not small


def test_ids_of_the_query_are_those_of_the_model(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=VOCABULARY)
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = op6_sentencepiece(spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id: list(r.token_ids) for r in rows} == {i: library.encode(t or "") for i, t in texts.items()}


def test_bpe_models_with_other_pieces_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as model_pb

    proto = model_pb.ModelProto()
    with open(VOCABULARY, "rb") as source:
        proto.ParseFromString(source.read())
    proto.pieces[-1].type = model_pb.ModelProto.SentencePiece.USER_DEFINED
    (tmp_path / "other.model").write_bytes(proto.SerializeToString())
    with pytest.raises(ValueError):
        vocabulary(str(tmp_path / "other.model"))

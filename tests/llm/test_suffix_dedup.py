import hashlib
import random
from collections import Counter

from conftest import SMALL
from llm_tables import nothing, odd, small  # noqa: F401

from basketflow.llm import suffix_dedup as s


def brute(rows, depth=200):
    """Every window of every text, counted."""
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i : i + depth] for t in texts for i in range(len(t) - depth + 1))
    out = []
    for (key, _), t in zip(rows, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - depth + 1):
            if seen[t[i : i + depth]] > 1:
                gone[i : i + depth] = b"\1" * depth
        kept = bytes(c for c, g in zip(t, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((key, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def ours(docs):
    return Counter(
        (r.doc_id, r.n_bytes, r.n_bytes - len(r.kept), len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in s.remove_repeats(docs).collect()
    )


def test_query(spark, small):
    rows = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in s.op5_suffix_dedup(spark, SMALL).collect())
    assert rows == brute([(r.doc_id, r.text) for r in small.collect()])


def cases():
    """Edits at every distance, passages just at and below a window, periods, shared beginnings and ends."""
    draw = random.Random(5)
    word = lambda: "".join(draw.choice("abcdefgé") for _ in range(draw.randint(1, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    base, passage = text(300), text(60)
    rows = [base, base, text(200) + passage + text(100), passage + text(50), text(50) + passage, passage[:199], passage[3:202], passage[:200]]
    for step in (5, 17, 31, 44, 90):
        words = base.split()
        words[step::step] = [word() for _ in words[step::step]]
        rows.append(" ".join(words))
    rows += ["ab" * 500, "a" * 900, "a" * 200, "a" * 199, "abc" * 67, text(30) * 4, "", None, base[:500] + base[250:900], base[:350], base[-350:]]
    hot = text(25)
    rows += [text(40) + hot + text(40) for _ in range(40)]
    return list(enumerate(rows))


def test_cases(spark):
    rows = cases()
    assert ours(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)) == brute(rows)


def thue_morse(n, letters):
    return "".join(letters[i.bit_count() & 1] for i in range(n))


def test_regular_texts(spark):
    """Texts whose polynomials modulo a power of two agree although the texts differ."""
    head, tail = "The same beginning of forty bytes or so, ", " and the same end for all."
    rows = [head + thue_morse(n, letters) + tail for n in (256, 1024, 2048) for letters in ("ab", "ba")]
    rows = list(enumerate([*rows, thue_morse(1500, "ab")[700:], thue_morse(4096, "xy")]))
    assert ours(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_hashes_of_ranges_tell_regular_texts_apart():
    import numpy as np

    from basketflow.llm.bytehash import Ranges, range_hashes

    draw = random.Random(3)
    pairs = [(thue_morse(2048, "ab"), thue_morse(2048, "ba"))]
    noise = "".join(draw.choice("ab ") for _ in range(300))
    for _ in range(20):
        a, b = draw.randrange(300), draw.randrange(300)
        swapped = list(noise)
        swapped[a], swapped[b] = swapped[b], swapped[a]
        pairs.append((noise, "".join(swapped)))
    for one, other in pairs:
        data = np.frombuffer((one + other + one).encode(), np.uint8)
        n = len(one)
        starts = np.array([0, n, 2 * n])
        first, second, third = range_hashes(data, starts, starts + n)
        assert first == third and (first == second) == (one == other)
    # The polynomials do not tell the first pair apart.
    data, ranges = np.frombuffer("".join(pairs[0]).encode(), np.uint8), Ranges()
    one, other = ranges.hashes(ranges.sums(data), np.array([0, 2048]), np.array([2048, 4096]))
    assert one == other
    data = np.frombuffer(noise.encode(), np.uint8)
    starts = np.arange(200)
    for width in (8, 9, 15, 16, 17, 100):
        texts = [noise[i : i + width] for i in starts]
        assert len(set(range_hashes(data, starts, starts + width))) == len(set(texts))


def test_passes_take_digits_in_order(spark):
    """Blocks by hand: a unique anchor, equal ones, and blocks that part at the first, second and third digit."""
    blocks = [
        (1, 1, 1, 1), (2, 1, 1, 1), (2, 1, 1, 1),
        (3, 1, 1, 1), (3, 1, 1, 1), (3, 1, 1, 2), (3, 1, 2, 1), (3, 1, 2, 2), (3, 2, 1, 1), (3, 1, 1, 1),
        (4, 1, 1, 1), (4, 1, 2, 1), (4, 1, 2, 1), (4, 5, 1, 1), (4, 5, 1, 1),
    ]
    rows = [(*block, 0, i, i) for i, block in enumerate(blocks)]
    found = s.split_groups(spark.createDataFrame(rows, s._with_id(s.T.LongType())), 3).collect()
    assert sorted(r.doc_id for r in found) == list(range(1, len(blocks)))
    times = Counter(blocks)
    assert all(r.done == (times[blocks[r.doc_id]] > 1) for r in found)
    going = Counter(blocks[r.doc_id] for r in found if r.next)
    assert going == Counter(set(blocks) - {(1, 1, 1, 1), (2, 1, 1, 1)})


def test_digits_cover_the_extent():
    """A change of any byte of the extent changes the digit that holds it, and no other."""
    import numpy as np

    draw = random.Random(2)
    for span in (0, 3, 23, 56, 57, 60, 63, 64, 168):
        size = s.DEPTH + span
        text = bytes(draw.randrange(256) for _ in range(size))
        place = np.array([0]), np.array([span]), np.array([1])
        was = s._digits(np.frombuffer(text, np.uint8), *place)
        for i in range(size):
            now = s._digits(np.frombuffer(text[:i] + bytes([text[i] ^ 1]) + text[i + 1 :], np.uint8), *place)
            changed = [k for k in range(3) if was[k] != now[k]]
            assert i // s.DIGIT in changed and (len(changed) == 1 or i >= size - 8)


def test_pieces_of_long_texts(spark, monkeypatch):
    rows = cases()
    monkeypatch.setattr(s, "PIECE", 150)
    monkeypatch.setattr(s, "SLICE_BYTES", 100)
    assert ours(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_shuffled_beyond_the_broadcast(spark, monkeypatch):
    rows = cases()
    monkeypatch.setattr(s, "BROADCAST", 0)
    assert ours(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_odd_tables(spark, odd, nothing):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert ours(odd) == brute(rows)
    assert s.remove_repeats(nothing).count() == 0

import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest import SMALL
from llm_tables import nothing, odd, small  # noqa: F401

from basketflow.llm import setsketch as s

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII))
    return frozenset(tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3))) if words else frozenset()


def brute(rows):
    """All pairs of sets."""
    sets = [shingles(t) for _, t in rows]
    different = list(dict.fromkeys(x for x in sets if x))
    root = {x: x for x in different}

    def find(x):
        while root[x] is not x:
            x = root[x]
        return x

    for a, one in enumerate(different):
        for two in different[:a]:
            both = len(one & two)
            if both and 100 * both >= 80 * len(one | two) and find(one) is not find(two):
                root[find(one)] = find(two)
    least = defaultdict(list)
    for (key, _), x in zip(rows, sets):
        if x and key is not None:
            least[find(x)].append(key)
    out = []
    for (key, _), x in zip(rows, sets):
        component = min(least[find(x)], default=None) if x else key
        out.append((key, len(x), component, key == component))
    return sorted(out, key=repr)


def ours(docs):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in s.near_duplicates(docs).collect()), key=repr)


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_query(spark, small):
    rows = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in s.op12_setsketch(spark, SMALL).collect()), key=repr)
    assert rows == brute([(r.doc_id, r.text) for r in small.collect()])
    assert any(not kept for _, _, _, kept in rows)


def near_copies(n, seed, most, words=120):
    """Copies of one text with up to ``most`` words replaced: some pairs are linked, others only in steps."""
    draw = random.Random(seed)
    base = [f"w{draw.randint(0, 400)}" for _ in range(words)]
    rows = []
    for _ in range(n):
        copy = list(base)
        for _ in range(draw.randint(0, most)):
            copy[draw.randrange(words)] = f"n{draw.randint(0, 9999)}"
        rows.append(" ".join(copy))
    return rows


def chain(n, seed, words=100):
    """Each text replaces a few more words of the one before: neighbours are linked, ends have nothing in common."""
    draw = random.Random(seed)
    text, out = [f"c{seed}x{i}" for i in range(words)], []
    for k in range(n):
        out.append(" ".join(text))
        place = 3 * k % (words - 2)
        text[place : place + 2] = [f"d{draw.randint(0, 99999)}", f"d{draw.randint(0, 99999)}"]
    return out


@pytest.mark.parametrize("most", [3, 8, 14])
def test_large_groups_over_many_blocks(spark, monkeypatch, most):
    monkeypatch.setattr(s, "BLOCK", 8)
    monkeypatch.setattr(s, "PAIRS_AT_ONCE", 50)
    texts = near_copies(90, most, most) + near_copies(6, 2, 2) + chain(40, 5) + [f"alone {i} in this table of texts here" for i in range(20)]
    rows = list(enumerate(texts))
    random.Random(4).shuffle(rows)
    assert ours(docs_of(spark, rows)) == brute(rows)


def test_second_step_alone_finds_all(spark, monkeypatch):
    """Without the first step, over blocks cut by bytes and texts fetched by a shuffle."""
    monkeypatch.setattr(s, "leaders", lambda nodes, shared: shared.select(s.F.col("node").alias("a"), s.F.col("first").alias("b")).filter("false"))
    monkeypatch.setattr(s, "BLOCK_BYTES", 4000)
    monkeypatch.setattr(s, "BROADCAST", 0)
    rows = list(enumerate(near_copies(60, 9, 9) + chain(30, 6)))
    assert ours(docs_of(spark, rows)) == brute(rows)


def test_threshold_is_exact(spark):
    words = [f"w{i}" for i in range(12)]  # nine shingles; one more makes 9 of 10, two more 9 of 11
    rows = [(1, " ".join(words)), (2, " ".join(words + ["a"])), (3, " ".join(words + ["b", "c", "d"])), (4, "A b C"), (5, "a B c"), (6, "a b"), (7, "\n \t")]
    assert ours(docs_of(spark, rows)) == brute(rows)


def test_odd_tables(spark, odd, nothing):
    assert ours(odd) == brute([(r.doc_id, r.text) for r in odd.collect()])
    assert s.near_duplicates(nothing).count() == 0


def test_very_long_texts(spark):
    draw = random.Random(3)
    long = [f"v{draw.randint(0, 10**6)}" for _ in range(200_000)]
    rows = [(2, " ".join(long)), (1, " ".join(long[:190_000])), (3, "x" * 2_000_000), (4, "x" * 2_000_000 + " y")]
    assert ours(docs_of(spark, rows)) == brute(rows)


def sets_with(similarity, size, draw):
    both = round(2 * size * similarity / (1 + similarity))
    pool = draw.integers(0, 1 << 63, 2 * size).astype(np.uint64)
    return np.unique(pool[:size]), np.unique(np.concatenate([pool[:both], pool[size : 2 * size - both]]))


def sketch(x):
    return s.registers(x, np.array([0, len(x)]))[0]


def test_sketches_merge():
    draw = np.random.default_rng(0)
    one, two = sets_with(0.4, 500, draw)
    assert s.merged(sketch(one).tobytes(), sketch(two).tobytes()) == sketch(np.union1d(one, two)).tobytes()
    assert 0 < sketch(one[:1]).min() and sketch(draw.integers(0, 1 << 63, 10**6).astype(np.uint64)).max() < s.LARGEST


def test_likelihood_estimates_and_agreement():
    """Registers agree as often as the formula says, and the joint estimate is near the similarity."""
    draw = np.random.default_rng(1)
    for similarity in (0.3, 0.6, 0.8, 0.95):
        equal, estimates = 0, []
        for _ in range(60):
            one, two = sets_with(similarity, 400, draw)
            a, b = sketch(one), sketch(two)
            equal += (a == b).sum()
            ok, best = s.plausible(np.array([len(one)]), np.array([len(two)]), np.array([(a > b).sum()]), np.array([(a < b).sum()]))
            estimates.append(best[0])
            assert similarity < 0.8 or ok[0]
        up = float(s.larger(0.5 - 0.5 * similarity))
        assert abs(equal / 60 / s.REGISTERS - (1 - 2 * up)) < 0.03
        assert abs(np.mean(estimates) - similarity) < 0.03
    far = s.plausible(np.array([400]), np.array([400]), np.array([40]), np.array([40]))
    assert not far[0][0]


def test_recall_of_the_bands():
    assert 1 - (1 - s.agreement(0.8) ** s.ROWS) ** s.BANDS >= s.RECALL


def test_shingles_of_slices():
    """Texts of a sliced array, and repeated shingles."""
    texts = pa.array(["z", "a b c d e", None, "a b c d a b c d a b c d", ""]).slice(1)
    _, begin = s.shingles(texts)
    assert np.diff(begin).tolist() == [2, 0, 4, 0]

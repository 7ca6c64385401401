import random
import re
from collections import Counter, defaultdict

import pytest
from conftest import SMALL
from llm_tables import nothing, odd, small  # noqa: F401

from basketflow.llm import jaccard as j
from basketflow.llm.components import components


def grams(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows):
    """All pairs of texts."""
    ids = defaultdict(list)
    for key, text in rows:
        ids[text or ""].append(key)
    texts = list(ids)
    sets = [grams(t) for t in texts]
    root = list(range(len(texts)))
    linked = defaultdict(set)

    def find(i):
        return i if root[i] == i else find(root[i])

    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 5 * both >= 4 * len(sets[a] | sets[b]):
                linked[a].add(b)
                linked[b].add(a)
                root[max(find(a), find(b))] = min(find(a), find(b))
    members = defaultdict(list)
    for i, t in enumerate(texts):
        members[find(i)] += [k for k in ids[t] if k is not None]
    return Counter(
        (key, min(members[find(i)], default=None), len(ids[t]) - 1 + sum(len(ids[texts[b]]) for b in linked[i]), len(linked[i]))
        for i, t in enumerate(texts) for key in ids[t]
    )


def ours(docs):
    return Counter((r.doc_id, r.class_id, r.n_links, r.n_text_links) for r in j.join_classes(docs).collect())


def test_query(spark, small):
    rows = Counter((r.doc_id, r.class_id, r.n_links, r.n_text_links) for r in j.op10_jaccard_join(spark, SMALL).collect())
    assert rows == brute([(r.doc_id, r.text) for r in small.collect()])
    assert any(n for _, _, n, _ in rows)


def near_copies(n, seed, words=120):
    draw = random.Random(seed)
    base = [f"w{draw.randint(0, 400)}" for _ in range(words)]
    rows = [" ".join(base)] * 3
    for _ in range(n):
        copy = list(base)
        for _ in range(draw.randint(0, 3)):
            copy[draw.randrange(words)] = f"n{draw.randint(0, 9999)}"
        rows.append(" ".join(copy))
    return rows


def test_large_group_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(j, "BLOCK", 8)
    texts = near_copies(90, 1) + near_copies(5, 2) + [f"alone {i} in this table of texts here" for i in range(20)]
    rows = list(enumerate(texts))
    random.Random(4).shuffle(rows)
    assert ours(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def chain(n, seed, words=60, step=9):
    """Texts that each share most of their words with the next, and little with those further on."""
    draw = random.Random(seed)
    tape = [f"c{seed}x{draw.randint(0, 10**6)}" for _ in range(words + n * step)]
    return [" ".join(tape[i * step : i * step + words]) for i in range(n)]


def test_loose_groups_meet_by_neighbourhood(spark, monkeypatch):
    monkeypatch.setattr(j, "BLOCK", 4)
    loose = [t for seed in (11, 12) for t in chain(60, seed)] + chain(50, 13, step=3)
    rows = list(enumerate(loose + loose[:20] + near_copies(40, 5) + chain(10, 14, step=20)))
    random.Random(6).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert ours(docs) == brute(rows)
    texts = j.nodes(docs, *j.banding(0.8)).cache()
    groups = j.candidates(texts).join(texts.select("node", "size"), "node")
    large = groups.join(groups.groupBy("root").count().filter("count > 4"), "root", "left_semi").select("node", "root", "size").cache()
    near, meets = j.neighbourhoods(large, texts)
    moved = near.count()
    assert 100 < moved < large.count()  # the chains, not the group of near copies
    # Far fewer pairs of blocks than all.
    blocks = near.select("near").distinct().count()
    assert meets.select("low", "high").distinct().count() < blocks * 8
    texts.unpersist(), large.unpersist()


def test_blocks_are_cut_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(j, "BLOCK_BYTES", 3000)
    rows = list(enumerate(near_copies(25, 8, words=150)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts = j.nodes(docs, *j.banding(0.8))
    sizes = j.verified(docs, texts).select("single").distinct().collect()
    assert [r.single for r in sizes] == [False]
    assert ours(docs) == brute(rows)


def test_regular_words_are_told_apart():
    """Words whose polynomials modulo a power of two are equal."""
    import pyarrow as pa

    one = "a"
    while len(one) < 2048:
        one += one.translate(str.maketrans("ab", "ba"))
    other = one.translate(str.maketrans("ab", "ba"))
    hashes, begin = j.grams(pa.array([one, other]))
    assert list(begin) == [0, 1, 2] and hashes[0] != hashes[1]


def test_shuffled_beyond_the_broadcast(spark, monkeypatch):
    monkeypatch.setattr(j, "BROADCAST", 0)
    rows = list(enumerate(near_copies(20, 7)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert ours(docs) == brute(rows)
    assert j.one_of_each(docs).count() == len({c for _, c, _, _ in brute(rows)})


def test_odd_tables(spark, odd, nothing):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert ours(odd) == brute(rows)
    left = j.one_of_each(odd)
    assert left.columns == odd.columns
    texts = [r.text or "" for r in left.collect()]
    assert sorted(texts) == sorted(set(texts))
    assert len(texts) == len({t or "" for _, t in rows}) - 2  # three near copies
    assert j.join_classes(nothing).count() == 0 and j.one_of_each(nothing).count() == 0


@pytest.mark.parametrize("similarity", [0.5, 0.8, 0.9])
def test_banding_reaches_the_recall(similarity):
    bands, rows = j.banding(similarity)
    assert 1 - (1 - similarity**rows) ** bands >= j.RECALL and bands * rows <= j.MOST_HASHES


def test_components(spark):
    draw = random.Random(9)
    edges = [(f"{i:03}", f"{i + 1:03}") for i in range(0, 60)] + [(f"{draw.randint(100, 400)}", f"{draw.randint(100, 400)}") for _ in range(120)]
    edges += [("999", f"{i}x") for i in range(50)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        return x if root[x] == x else find(root[x])

    for a, b in edges:
        root[max(find(a), find(b))] = min(find(a), find(b))
    want = {n: find(n) for e in edges for n in e if e[0] != e[1]}
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert got == want
    assert components(spark.createDataFrame([], "a string, b string")).count() == 0

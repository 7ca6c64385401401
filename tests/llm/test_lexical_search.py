import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from conftest import SMALL, database
from llm_tables import nothing, odd, small  # noqa: F401

from basketflow.llm import lexical_search as s

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(ASCII))


def brute(docs, items):
    """Every document scored for every item."""
    counted = [(key, Counter(terms(text))) for key, text in docs]
    n_docs = sum(1 for _, c in counted if c)
    n_terms = sum(sum(c.values()) for _, c in counted)
    holders = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in dict.fromkeys((i, t or "") for i, t in items):
        scores = []
        for key, c in counted:
            m = 75 + 25 * sum(c.values()) * n_docs // max(1, n_terms)
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holders[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                for t in terms(text) if c[t]
            )
            if score > 0:
                scores.append((-score, key is None, key or 0))
        out += [(item, rank, None if lost else key, -score) for rank, (score, lost, key) in enumerate(sorted(scores)[:20], 1)]
    return sorted(out, key=repr)


def ours(docs, items):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in s.search(s.index(docs), items).collect()), key=repr)


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_query_brute_force_and_sql(spark, small):
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    rows = sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in s.op13_lexical_search(spark, SMALL).collect()), key=repr)
    assert rows == brute([(r.doc_id, r.text) for r in small.collect()], [(r.item_id, r.text) for r in items.collect()])
    sql = database(SMALL).execute(s.OP13_SQL).fetchall()
    assert rows == sorted(((i, rank, d, score) for i, rank, d, score in sql), key=repr)


def random_docs(n, seed, copies=1):
    draw = random.Random(seed)
    return [(i, " ".join(f"t{min(draw.randint(0, 60), draw.randint(0, 60))}" for _ in range(draw.randint(0, 40)))) for i in range(n)] + [
        (1000 + k, "t1 t2 T3 t3") for k in range(copies)
    ]


def test_small_leaves_groups_and_blocks(spark, monkeypatch):
    """Many groups, deep trees, several blocks of items, ties over many copies."""
    monkeypatch.setattr(s, "GROUP_NUMBERS", 3000)
    monkeypatch.setattr(s, "LEAF", 4)
    monkeypatch.setattr(s, "SAMPLE", 40)
    monkeypatch.setattr(s, "BLOCK_CHARS", 60)
    docs, items = random_docs(400, 3, copies=60), [(i, text) for i, text in random_docs(12, 5)] + [(1, "t3 t2"), (1, "t3 t2")]
    assert ours(spark.createDataFrame(docs, "doc_id long, text string"), items_of(spark, items)) == brute(docs, items)


def test_bounds_hold_and_prune():
    draw = np.random.default_rng(1)
    points = (draw.random((500, 30)) < 0.1) * draw.integers(1, 10**6, (500, 30))
    tree = s.BallTree(points, 8)
    queries = draw.integers(0, 20_000, (20, 30)).astype(float)
    bounds, exact = tree.bounds(queries), queries.astype(np.int64) @ points.T
    leaves = 0
    for node, (a, b) in enumerate(tree.spans):
        assert (bounds[:, node] >= exact[:, tree.order[a:b]].max(axis=1)).all()
        if tree.children[node]:
            (c, d), (e, f) = (tree.spans[k] for k in sorted(tree.children[node], key=lambda k: tree.spans[k]))
            assert (c, d, f) == (a, e, b)
        else:
            leaves += b - a
    assert leaves == 500 and sorted(tree.order) == list(range(500))


def test_pruning_visits_fewer_leaves(monkeypatch):
    """Clustered vectors: a query near one cluster does not score the others."""
    import pyarrow as pa

    texts = [" ".join(f"c{k}w{j}" for j in range(8)) for k in range(16) for _ in range(64)]
    block = s.Block([" ".join(f"c3w{j}" for j in range(8))] + [t for t in dict.fromkeys(texts)])
    hashes, first = s.terms_of(pa.array(texts))
    found, counts, begin = s._counted(hashes, first)
    columns = np.searchsorted(block.terms, found.view(np.int64)).astype(np.int32)
    group = pa.table({"doc_id": list(range(len(texts))), "n": np.diff(first).astype(np.int64), "columns": s._lists(columns, begin), "counts": s._lists(counts.astype(np.int32), begin)})
    block.weigh(len(texts), len(hashes), dict(Counter(columns.tolist())))
    seen = []
    pop = s.heapq.heappop
    monkeypatch.setattr(s.heapq, "heappop", lambda heap: seen.append(1) or pop(heap))
    best = [r for r in s.best_of(block, group, np.zeros(17, np.int64)) if r[0] == 0]
    assert [d for _, d, _ in best] == list(range(192, 212))
    assert len(seen) / 17 < 16


@pytest.mark.parametrize("rows", [[(1, "bob mail"), (2, None), (None, "quick brown QUICK"), (3, ""), (3, "fox"), (4, "é漢 word 9")], []])
def test_odd_tables(spark, odd, nothing, rows):
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    assert ours(odd, items_of(spark, rows)) == brute(docs, rows)
    assert ours(nothing, items_of(spark, rows)) == []


def test_very_long_text(spark):
    docs = [(1, "alpha " * 300_000), (2, "alpha beta"), (3, "x" * 1_000_000)]
    items = [(1, "alpha beta"), (2, "x" * 1_000_000)]
    assert ours(spark.createDataFrame(docs, "doc_id long, text string"), items_of(spark, items)) == brute(docs, items)

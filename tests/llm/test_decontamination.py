from itertools import combinations

import pytest
from conftest import SMALL, database
from llm_tables import nothing, odd, small  # noqa: F401
from pyspark.sql import functions as F

from basketflow.llm import decontamination as d


def test_masks_are_lossless():
    for gone in combinations(range(d.WINDOW), d.SUBSTITUTIONS):
        assert any(
            not set(gone) & {at + k for k in mask} for mask in d.MASKS for at in range(d.WINDOW - mask[-1])
        ), gone


def test_query(spark):
    ours = {tuple(r) for r in d.op1_decontamination(spark, SMALL).select("doc_id", "item_id", "overlap", "first_token").collect()}
    assert ours and ours == set(database(SMALL).execute(d.OP1_SQL).fetchall())


ITEM = [f"tok{i}" for i in range(20)]


def changed(words, *places):
    return [f"new{i}" if i in places else w for i, w in enumerate(words)]


@pytest.mark.parametrize(
    "words, leaks",
    [
        (ITEM, True),
        (changed(ITEM, 3, 9, 15), True),
        (changed(ITEM[:13], 0, 12), True),
        (changed(ITEM[:13], 0, 5, 12), False),
        (ITEM[:11], True),
        (ITEM[:10], False),
        (ITEM[:6] + ["gap"] + ITEM[6:12], False),
        (changed(ITEM, *range(0, 20, 3)), False),
        ([w.upper() + "," for w in ITEM], True),
    ],
)
def test_substitutions(spark, words, leaks):
    docs = spark.createDataFrame([(1, "before it " + " ".join(words) + " after it"), (2, "clean text")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, " ".join(ITEM))], "item_id long, text string")
    found = d.leaks(docs, bench).collect()
    assert [r.doc_id for r in found] == ([1] if leaks else [])
    assert [r.doc_id for r in d.decontaminated(docs, bench).collect()] == ([2] if leaks else [1, 2])


def test_short_items(spark):
    docs = spark.createDataFrame([(1, "x one two three four five y"), (2, "one two three four"), (3, "five four three two one")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "one two three four five"), (2, "one two three four"), (3, None), (None, "one two three four five")], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in d.leaks(docs, bench).collect()} == {(1, 1), (1, None)}


@pytest.mark.parametrize("n", range(5, 13))
def test_short_items_with_replaced_tokens(spark, n):
    """Each token replaced in turn, and two at a time, against the SQL's rule."""
    item = [f"w{i}" for i in range(n)]
    texts = {(): item} | {(i,): changed(item, i) for i in range(n)} | {pair: changed(item, *pair) for pair in combinations(range(n), 2)}
    docs = spark.createDataFrame([(k, "x " + " ".join(words) + " y") for k, words in enumerate(texts.values())], "doc_id long, text string")
    bench = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    found = {r.doc_id for r in d.leaks(docs, bench).collect()}
    assert found == {k for k, gone in enumerate(texts) if len(gone) <= (n >= 8)}


def test_odd_tables(spark, odd, nothing):
    bench = spark.createDataFrame([(1, "quick brown fox jumps over the lazy dog while seven wizards quietly mix"), (2, "word " * 30)], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in d.leaks(odd, bench).collect()}
    assert found == {(1, 1), (2, 1), (3, 1), (None, 1), (9, 2)}
    left = d.decontaminated(odd, bench)
    assert left.columns == odd.columns and left.count() == odd.count() - 7
    assert d.leaks(nothing, bench).count() == 0
    assert d.leaks(odd, bench.limit(0)).count() == 0
    assert d.decontaminated(odd, bench.limit(0)).count() == odd.count()


def test_shuffled_beyond_the_broadcast(spark, small, monkeypatch):
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    broadcast = {tuple(r) for r in d.leaks(small, bench).collect()}
    monkeypatch.setattr(d, "BROADCAST", 0)
    monkeypatch.setattr(d, "BROADCAST_SEEDS", 0)
    assert {tuple(r) for r in d.leaks(small, bench).collect()} == broadcast
    assert d.decontaminated(small, bench).count() == small.count() - len({r[0] for r in broadcast})


def test_no_python_in_the_plan(spark, small):
    plan = d.leaks(small, spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", F.col("text")))
    assert "Python" not in plan._jdf.queryExecution().toString()

import re

import pytest
from conftest import SMALL
from llm_tables import nothing, odd  # noqa: F401
from test_jaccard import brute

import __spark_entry__ as contract
import corpus_pipeline
from basketflow.llm import classifier, decontamination
from basketflow.workspace import new_folder


def staged(spark, docs, sf_dir):
    """What each stage kept."""
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = new_folder(spark, f"test-{name}")
        stage(spark, kept[-1], sf_dir).write.parquet(path)
        kept.append(spark.read.parquet(path))
    return kept


def test_each_stage_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    first, quality, single, clean, redacted, encoded = staged(spark, docs, SMALL)
    assert quality.columns == single.columns == clean.columns == redacted.columns == docs.columns

    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    good = {r.doc_id for r in classifier.classify(first, labels).filter("predicted = 1").collect()}
    assert {r.doc_id for r in quality.collect()} == good

    heads = {c for _, c, _, _ in brute([(r.doc_id, r.text) for r in quality.collect()])}
    assert {r.doc_id for r in single.collect()} == heads

    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    items = [words(r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    runs = {tuple(i[k : k + 13]) for i in items for k in range(len(i) - 12)}
    exact = {r.doc_id for r in single.collect() if any(tuple(w[k : k + 13]) in runs for w in [words(r.text)] for k in range(len(w) - 12))}
    left = {r.doc_id for r in clean.collect()}
    found = {r.doc_id for r in decontamination.leaks(single, spark.read.parquet(f"{SMALL}/benchmark.parquet")).collect()}
    assert exact <= found and left == heads - found

    texts = {r.doc_id: r for r in redacted.collect()}
    assert set(texts) == left
    assert not any(re.search(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r.text) for r in texts.values())
    assert all(r.n_chars == len(r.text) for r in texts.values())

    rows = encoded.collect()
    assert {r.doc_id for r in rows} == left and all(r.round_trip and r.n_tokens == len(r.token_ids) for r in rows)


def test_registered(spark):
    assert contract.queries()["pipeline"] is corpus_pipeline.run
    names = [n for n in contract.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))


@pytest.mark.parametrize("table", ["odd", "nothing"])
def test_odd_tables(spark, request, table):
    docs = request.getfixturevalue(table)
    kept = staged(spark, docs, SMALL)
    assert all(k.columns == docs.columns for k in kept[:-1])
    assert kept[-1].count() == kept[-2].count()
    if table == "nothing":
        assert kept[-1].count() == 0

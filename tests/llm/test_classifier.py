import math
import zlib

import pytest
from conftest import SMALL
from llm_tables import nothing, odd  # noqa: F401

from basketflow.llm import classifier

LARGER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = classifier.op7_quality_classifier(spark, LARGER)
    labels = spark.read.parquet(f"{LARGER}/labels.parquet")
    judged = rows.join(labels, "doc_id").filter("held_out").collect()
    assert len(judged) > 80
    assert sum(r.predicted == r.quality for r in judged) >= 0.97 * len(judged)
    good, bad = ([r.score for r in judged if r.quality == k] for k in (1, 0))
    assert sum(g > b for g in good for b in bad) >= 0.99 * len(good) * len(bad)
    everyone = rows.collect()
    assert len(everyone) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in everyone)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in everyone)


def test_against_a_plain_discriminant(spark):
    """Means, shrunk covariances and scores by dense linear algebra, without factors or sums over cells."""
    import numpy as np

    docs, labels = (spark.read.parquet(f"{SMALL}/{n}.parquet") for n in ("documents", "labels"))
    x = {r.doc_id: classifier.statistics(r.text or "") for r in docs.collect()}
    marks = [(r.doc_id, r.quality) for r in labels.collect() if r.quality in (0, 1) and r.doc_id in x]
    train = [(x[key], k) for key, k in marks if zlib.crc32(str(key).encode()) % 3 != 1]
    of = [np.array([v for v, k in train if k == c]) for c in (0, 1)]
    d = len(classifier.STATISTICS)
    means = [m.mean(axis=0) for m in of]
    own = [np.cov(m, rowvar=False, bias=True) for m in of]
    pooled = sum(len(m) * c for m, c in zip(of, own)) / len(train)
    scale = np.diag(np.maximum(np.diag(pooled), 1e-8))
    density = []
    for m, mean, c in zip(of, means, own):
        weight = min(1.0, classifier.SHRINK_TO_POOLED + d / (len(m) + d))
        shrunk = (1 - weight) * c + weight * pooled
        shrunk = (1 - classifier.SHRINK_TO_IDENTITY) * shrunk + classifier.SHRINK_TO_IDENTITY * scale
        prior, (_, log_det) = np.log(len(m) / len(train)), np.linalg.slogdet(shrunk)

        def log_density(v, mean=mean, inverse=np.linalg.inv(shrunk), term=prior - 0.5 * log_det):
            return term - 0.5 * (v - mean) @ inverse @ (v - mean)

        density.append(log_density)
    rows = classifier.classify(docs, labels).collect()
    assert len(rows) == len(x) and len(train) > 20
    for r in rows:
        gap = np.clip((density[1](x[r.doc_id]) - density[0](x[r.doc_id])) / d, -30, 30)
        assert abs(r.score - 1 / (1 + np.exp(-gap))) < 1e-6


def test_statistics_by_hand():
    text = "One two, two two!\n#é 12|3"
    got = dict(zip(classifier.STATISTICS, classifier.statistics(text)))
    raw, n = text.encode(), 6
    assert len(raw.split()) == n
    want = {
        "log_bytes": math.log(1 + len(raw)), "log_words": math.log(1 + n), "word_bytes": math.log(1 + sum(map(len, raw.split())) / n),
        "upper": (1 / 12) ** 0.5, "symbols": (1 / len(raw)) ** 0.5, "shouts": (1 / n) ** 0.5, "bars": (1 / n) ** 0.5,
        "digits": (3 / len(raw)) ** 0.5, "stops": (1 / n) ** 0.5, "line_ends": (1 / n) ** 0.5, "non_ascii": (2 / len(raw)) ** 0.5,
        "new_words": 6 / n, "new_pairs": 5 / n,
    }
    assert {k: round(got[k], 12) for k in want} == {k: round(v, 12) for k, v in want.items()}


def test_held_out_labels_change_nothing(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{n}.parquet") for n in ("documents", "labels"))
    turned = labels.selectExpr("doc_id", "case when crc32(cast(doc_id as string)) % 3 = 1 then 1 - quality else quality end as quality")
    before = {r.doc_id: r.score for r in classifier.classify(docs, labels).collect()}
    after = {r.doc_id: r.score for r in classifier.classify(docs, turned).collect()}
    assert before == after


def test_odd_tables(spark, odd, nothing):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    assert classifier.classify(odd, labels).count() == odd.count()
    kept = classifier.accepted(odd, labels)
    assert kept.columns == odd.columns
    assert classifier.classify(nothing, labels).count() == 0
    none = labels.limit(0)
    assert {r.score for r in classifier.classify(odd, none).collect()} == {0.5}
    assert classifier.accepted(odd, none).count() == odd.count()
    one = labels.selectExpr("doc_id", "1 as quality")
    assert {r.predicted for r in classifier.classify(odd, one).collect()} == {1}


@pytest.mark.parametrize("most", [0, classifier.BROADCAST])
def test_accepted_are_those_predicted_good(spark, monkeypatch, most):
    monkeypatch.setattr(classifier, "BROADCAST", most)
    docs, labels = (spark.read.parquet(f"{SMALL}/{n}.parquet") for n in ("documents", "labels"))
    good = {r.doc_id for r in classifier.classify(docs, labels).filter("predicted = 1").collect()}
    kept = classifier.accepted(docs, labels)
    assert {r.doc_id for r in kept.collect()} == good and kept.columns == docs.columns


def test_statistics_are_finite():
    import numpy as np

    for text in ["", " ", "a", "\n" * 1000, "é" * 10, "A" * 100_000, "1 2 3 !!! ###"]:
        assert np.isfinite(classifier.statistics(text)).all()

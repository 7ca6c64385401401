"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Each text becomes a vector of statistics of its whole bytes and words. Class means and covariances come
from sums over all labelled training rows (one aggregation; only the sums reach the driver). Each
covariance is shrunk towards the pooled one and a multiple of the identity; its Cholesky factor is kept
and the score is the logistic of the Mahalanobis log-density difference, per dimension.

Neither labels nor language, source or id enter a score. Rows whose ``crc32(id as text) % 3`` is 1 are
held out of training.

Defined results: a null text scores as an empty one; an empty text is scored like any other; repeated
labels count as often as they come, null labels and labels without a document not at all; without a
label of both classes every score is 0.5. An empty table gives no rows. Only id and text are read.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketflow.llm.base import fresh, small_batches, stored, table, text_of

SHRINK_TO_POOLED = 0.1
SHRINK_TO_IDENTITY = 0.02
FOLDS, HELD_OUT = 3, 1
#: Labels up to which they are sent to the texts.
BROADCAST = 1_000_000
STATISTICS = (
    "log_bytes", "log_words", "word_bytes", "word_bytes_spread", "upper", "symbols", "shouts", "bars", "digits",
    "stops", "line_ends", "non_ascii", "new_words", "new_pairs", "packed",
)


def statistics(text: str) -> np.ndarray:
    """The transformed statistics of one whole text."""
    raw = text.encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) if raw else np.zeros(256)
    words = raw.split()
    n, size = max(1, len(words)), max(1, len(raw))
    lengths = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    of = lambda chars: float(counts[list(chars)].sum())
    root = lambda part, whole: np.sqrt(part / whole)
    letters = max(1.0, counts[65:91].sum() + counts[97:123].sum())
    return np.array([
        np.log1p(len(raw)),
        np.log1p(len(words)),
        np.log1p(lengths.mean()),
        np.log1p(lengths.std()),
        root(counts[65:91].sum(), letters),
        root(of(b"#*$%&<>=_{}[]~^\\@"), size),
        root(of(b"!?"), n),
        root(of(b"|"), n),
        root(counts[48:58].sum(), size),
        root(of(b".,;:"), n),
        root(of(b"\n"), n),
        root(counts[128:].sum(), size),
        len(set(words)) / n,
        len(set(zip(words, words[1:]))) / n,
        len(zlib.compress(raw, 1)) / (size + 12),
    ])


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def statistics_of(texts: pd.Series) -> pd.Series:
    return texts.map(statistics)


@dataclass(frozen=True)
class Discriminant:
    """Means, inverse Cholesky factors and log terms of the two classes; None where a class has no rows."""

    means: np.ndarray | None
    factors: np.ndarray | None
    offsets: np.ndarray | None

    def scores(self, x: np.ndarray) -> np.ndarray:
        """In 0..1, higher where class 1 is likelier."""
        if self.means is None or not len(x):
            return np.full(len(x), 0.5)
        logs = [
            self.offsets[k] - 0.5 * np.square((x - self.means[k]) @ self.factors[k].T).sum(axis=1) for k in (0, 1)
        ]
        gap = np.clip((logs[1] - logs[0]) / x.shape[1], -30, 30)
        return 1.0 / (1.0 + np.exp(-gap))


def held_out(key: Column) -> Column:
    return F.crc32(F.encode(F.coalesce(key.cast("string"), F.lit("")), "UTF-8")) % FOLDS == HELD_OUT


def labelled(rows: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """Rows that are not held out, with their label as ``k``, once for each label."""
    marks = labels.filter(F.col(label).isin(0, 1)).select(F.col("doc_id").alias("of"), F.col(label).cast("int").alias("k"))
    return rows.filter(~held_out(F.col("doc_id"))).join(marks, F.col("doc_id") == F.col("of"))


def fit(rows: DataFrame, *, to_pooled: float = SHRINK_TO_POOLED, to_identity: float = SHRINK_TO_IDENTITY) -> Discriminant:
    """Fit on labelled statistics (x, k)."""
    d = len(STATISTICS)
    # Sums of x, and of x times x: one row for each class and cell, combined on the map side.
    cells = F.flatten(F.transform(F.concat(F.array(F.lit(1.0)), "x"), lambda a: F.transform(F.concat(F.array(F.lit(1.0)), "x"), lambda b: a * b)))
    sums = rows.select("k", F.posexplode(cells).alias("cell", "v")).groupBy("k", "cell").agg(F.sum("v").alias("v")).collect()
    moments = np.zeros((2, (d + 1) ** 2))
    for row in sums:
        moments[row.k, row.cell] = row.v
    moments = moments.reshape(2, d + 1, d + 1)
    n = moments[:, 0, 0]
    if n.min() < 1:
        return Discriminant(None, None, None)
    means = moments[:, 0, 1:] / n[:, None]
    scatter = np.stack([moments[k, 1:, 1:] - n[k] * np.outer(means[k], means[k]) for k in (0, 1)])
    pooled = scatter.sum(axis=0) / n.sum()
    # A common scale for the identity, so that no statistic's unit decides.
    scale = np.diag(np.maximum(np.diag(pooled), 1e-8))
    factors, offsets = [], []
    for k in (0, 1):
        weight = min(1.0, to_pooled + d / (n[k] + d))
        own = (1 - weight) * scatter[k] / n[k] + weight * pooled
        cholesky = np.linalg.cholesky((1 - to_identity) * own + to_identity * scale)
        factors.append(np.linalg.inv(cholesky))
        offsets.append(np.log(n[k] / n.sum()) - np.log(np.diag(cholesky)).sum())
    return Discriminant(means, np.stack(factors), np.array(offsets))


def score_with(model: Discriminant):
    """A column function from statistics to scores."""

    @F.pandas_udf(T.DoubleType())
    def scores(x: pd.Series) -> pd.Series:
        return pd.Series(model.scores(np.array(x.tolist(), dtype=np.float64).reshape(len(x), -1)))

    return scores


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: held_out, score, predicted. Statistics are stored once and used twice."""
    small_batches(docs.sparkSession)
    features = stored(docs.select("doc_id", statistics_of(text_of()).alias("x")), "statistics")
    scores = score_with(fit(labelled(features, labels)))
    return features.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), scores("x").alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, that the classifier does not reject."""
    small_batches(docs.sparkSession)
    texts = docs.select("doc_id", text_of().alias("t"))
    if labels.count() <= BROADCAST:  # statistics of labelled rows only
        train = labelled(texts, F.broadcast(labels)).select("k", statistics_of("t").alias("x"))
    else:  # statistics are sent, never texts
        train = labelled(texts.select("doc_id", statistics_of("t").alias("x")), labels)
    scores = score_with(fit(train))
    mark = fresh(docs, "score")
    return docs.withColumn(mark, scores(statistics_of(text_of()))).filter(F.col(mark) >= 0.5).drop(mark)


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))

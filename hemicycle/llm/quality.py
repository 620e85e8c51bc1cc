"""Quality classifier: regularised quadratic discriminant over statistics of a document.

Every class has a mean and a covariance, drawn towards the pooled covariance and its diagonal. The
score compares the log densities, each a Mahalanobis distance through a Cholesky factor that is
computed once.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hemicycle.llm.common import as_bytes, small_batches
from hemicycle.session import stored

THRESHOLD = 0.7
#: Share of the pooled covariance in a class's, and of the diagonal in the result.
POOLED, DIAGONAL = 0.2, 0.1
FEATURES = 12

_UPPER = bytes(range(0x41, 0x5B))
_LOWER = bytes(range(0x61, 0x7B))
_DIGITS = b"0123456789"
_SPACE = b" \t\n\v\f\r"
_STOPS = b".,;:"
_MARKS = bytes(b for b in range(0x21, 0x7F) if b not in _UPPER + _LOWER + _DIGITS + _STOPS)


def _count(text: bytes, kinds: bytes) -> int:
    return len(text) - len(text.translate(None, kinds))


def statistics(text: bytes | None) -> list[float]:
    """Transformed statistics of a whole text; those of an empty one are those of no words."""
    text = text or b""
    words = text.split()
    n = len(words)
    size = max(len(text), 1)
    lines = text.split(b"\n")
    upper, lower = _count(text, _UPPER), _count(text, _LOWER)
    again = sum(map(operator.eq, words, words[1:])) if n > 1 else 0
    root = lambda part, of: (part / max(of, 1)) ** 0.5  # noqa: E731  spreads small shares
    return [
        np.log1p(n),
        np.log1p((size - _count(text, _SPACE)) / max(n, 1)),
        root(upper, upper + lower),
        root(_count(text, _MARKS), size),
        root(_count(text, _STOPS), size),
        root(_count(text, _DIGITS), size),
        root(len(set(words)), n),
        root(again, n),
        np.log1p(n / len(lines)),
        root(len(lines) - len(set(lines)), len(lines)),
        root(sum(map(bytes.isalnum, words)), n),
        root(text.count(b"|") + text.count(b"!"), n),
    ]


def described(docs: DataFrame) -> DataFrame:
    """``key, features`` of every row: the only pass over the texts."""

    @F.arrow_udf("array<double>")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([statistics(t) for t in as_bytes(texts)], pa.list_(pa.float64()))

    small_batches(docs.sparkSession)
    return docs.select("doc_id", run("text").alias("features"))


def held_out(doc_id: Column) -> Column:
    """The rows that are never learnt from; a null id has the remainder of an empty text."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % 4 == 2


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums = {0: np.zeros(1 + FEATURES + FEATURES**2), 1: np.zeros(1 + FEATURES + FEATURES**2)}
    for batch in batches:
        x = np.array(batch.column("features").to_pylist(), float).reshape(-1, FEATURES)
        y = np.array(batch.column("quality").to_pylist())
        for label, total in sums.items():
            own = x[y == label]
            total += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.int32()), pa.array(list(sums.values()), pa.list_(pa.float64()))], ["label", "sums"]
    )


@dataclass(frozen=True)
class Discriminant:
    """Log odds of label 1; ``parts`` has mean, inverse Cholesky factor and constant of labels 0 and 1."""

    parts: tuple[tuple[np.ndarray, np.ndarray, float], ...]
    prior: float

    @staticmethod
    def of(moments: dict[int, np.ndarray], pooled: float = POOLED, diagonal: float = DIAGONAL) -> Discriminant:
        n = {k: moments[k][0] for k in (0, 1)}
        total = n[0] + n[1]
        prior = float(np.log((n[1] + 1) / (n[0] + 1)))
        if min(n.values()) < 2:  # nothing to tell apart: the share of label 1 is the score of all
            return Discriminant((), prior)
        mean = {k: moments[k][1 : 1 + FEATURES] / n[k] for k in n}
        scatter = {k: moments[k][1 + FEATURES :].reshape(FEATURES, FEATURES) - n[k] * np.outer(mean[k], mean[k]) for k in n}
        both = (scatter[0] + scatter[1]) / total
        floor = 1e-4 + 1e-3 * np.diag(both)
        parts = []
        for k in (0, 1):
            cov = (1 - pooled) * scatter[k] / n[k] + pooled * both
            cov = (1 - diagonal) * cov + diagonal * np.diag(np.diag(cov)) + np.diag(floor)
            factor = np.linalg.cholesky(cov)
            parts.append((mean[k], np.linalg.inv(factor), float(-np.log(np.diag(factor)).sum())))
        return Discriminant(tuple(parts), prior)

    def score(self, x: np.ndarray) -> np.ndarray:
        odds = np.full(len(x), self.prior)
        for sign, (mean, inverse, constant) in zip((-1, 1), self.parts, strict=False):
            odds += sign * (constant - 0.5 * (((x - mean) @ inverse.T) ** 2).sum(axis=1))
        return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


def learn(features: DataFrame, labels: DataFrame) -> Discriminant:
    """Fits on all labelled rows that are not held out; what comes to the driver is their moments."""
    known = labels.filter("quality in (0, 1)").select(F.col("doc_id").alias("id"), "quality")
    rows = features.filter(~held_out(F.col("doc_id"))).join(known, F.col("doc_id") == F.col("id"))
    sums = rows.select("features", "quality").mapInArrow(_moments, "label int, sums array<double>")
    flat = sums.select("label", F.posexplode("sums").alias("place", "value")).groupBy("label", "place").agg(F.sum("value").alias("value"))
    moments = {k: np.zeros(1 + FEATURES + FEATURES**2) for k in (0, 1)}
    for label, place, value in flat.collect():  # two rows for each moment
        moments[label][place] = value
    return Discriminant.of(moments)


def scorer(model: Discriminant):
    @F.arrow_udf("double")
    def run(features: pa.Array) -> pa.Array:
        return pa.array(model.score(np.array(features.to_pylist(), float).reshape(-1, FEATURES)))

    return run


def scored(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs`` (``doc_id``, ``text``).

    ``labels`` has ``doc_id`` and ``quality``; other values than 0 and 1 are not learnt from. Without
    labels of both kinds all scores are the smoothed share of label 1. Null texts count as empty.
    An empty table gives an empty table.
    """
    features = stored(described(docs), "quality_features")
    score = scorer(learn(features, labels))
    out = features.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score("features").alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier predicts as label 1, with all their columns."""
    features = stored(described(docs), "quality_features")
    model = learn(features, labels)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(model.score(np.array([statistics(t) for t in as_bytes(texts)], float).reshape(-1, FEATURES)))

    return docs.filter(score("text") >= threshold)

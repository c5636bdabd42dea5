"""Quality: regularised quadratic discriminant on transformed document statistics.

Each class has a Gaussian over the statistics. Its covariance is shrunk towards
the diagonal of the pooled one and kept as a Cholesky factor; a document's score
is the logistic function of the difference of the two log densities (a squared
Mahalanobis distance and a log determinant each) plus the log prior odds.

Moments come from all labelled rows outside the held-out fold, as sums. Defined
cases: null and empty texts have statistics like any other; a document labelled
twice counts once, as good if one label says so; null labels teach nothing;
without rows of both classes every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltbed.llm.common import mapped, pieces, row_bounds, stored, tokens, utf8_buffer

#: Fixed by the contract of the query: held-out remainder of crc32(doc_id as text) and the threshold.
FOLDS, HELD_OUT, THRESHOLD = 4, 2, 0.7

NAMES = (
    "log_chars", "log_words", "word_length", "variety", "top_word", "stutter", "upper", "digits", "signs",
    "stops", "shouts", "bars", "lines", "foreign",
)


@dataclass(frozen=True)
class QualityParameters:
    #: Weight of the pooled diagonal in a class covariance, and what is added to its diagonal.
    shrinkage: float = 0.05
    ridge: float = 1e-3


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(chars)] = True
    return out


_UPPER = _table(bytes(range(65, 91)))
_LETTER = _table(bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256)))
_DIGITS = _table(b"0123456789")
_SIGNS = _table(b"#$%&*@^~<>{}[]\\/=+_")
_STOPS = _table(b".,;:?")
_SHOUT, _BAR, _LINE = _table(b"!"), _table(b"|"), _table(b"\n")
_FOREIGN = _table(bytes(range(128, 256)))


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of ``NAMES`` for each text."""
    buf, offs = utf8_buffer(texts)
    n = len(texts)

    def per_row(table: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(table[buf])])
        return (sums[offs[1:]] - sums[offs[:-1]]).astype(np.float64)

    size = np.diff(offs).astype(np.float64)
    _, _, row, h = tokens(buf, offs)
    bounds = row_bounds(row, n)
    words = np.diff(bounds).astype(np.float64)
    order = np.lexsort((h, row))
    r, s = row[order], h[order]
    new = np.ones(len(r), dtype=bool)
    new[1:] = (r[1:] != r[:-1]) | (s[1:] != s[:-1])
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(r)))
    distinct = np.bincount(r[at], minlength=n).astype(np.float64)
    top = np.zeros(n)
    np.maximum.at(top, r[at], count)
    same = np.zeros(len(h), dtype=bool)
    same[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    stutter = np.bincount(row[same], minlength=n).astype(np.float64)
    letters, one = per_row(_LETTER), np.maximum(words, 1)
    share = lambda x, of: np.log(x / np.maximum(of, 1) + 1e-3)
    return np.stack(
        [
            np.log1p(size),
            np.log1p(words),
            np.log((letters + 1) / (words + 1)),
            np.log1p(distinct) / np.log1p(one),
            np.log((top + 1) / (words + 2)),
            share(stutter, words),
            share(per_row(_UPPER), letters),
            share(per_row(_DIGITS), size),
            share(per_row(_SIGNS), size),
            share(per_row(_STOPS), words),
            share(per_row(_SHOUT), words),
            share(per_row(_BAR), words),
            share(per_row(_LINE), words),
            share(per_row(_FOREIGN), size),
        ],
        axis=1,
    )


def measured(documents: DataFrame) -> DataFrame:
    """doc_id and statistics x of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            x = pa.array(list(statistics(batch.column("text"))), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), x], ["doc_id", "x"])

    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").transform(mapped, run, "doc_id bigint, x array<double>"
    )


@dataclass(frozen=True)
class QualityModel:
    means: np.ndarray
    #: Inverse Cholesky factors of the class covariances, and log densities' constants with priors.
    whiten: np.ndarray
    constants: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        density = []
        for mean, whiten, constant in zip(self.means, self.whiten, self.constants, strict=True):
            z = (x - mean) @ whiten.T
            density.append(constant - 0.5 * (z * z).sum(axis=1))
        return 1.0 / (1.0 + np.exp(-np.clip(density[1] - density[0], -500, 500)))


def fit(statistics_of: DataFrame, labels: DataFrame, p: QualityParameters = QualityParameters()) -> QualityModel | None:
    """From doc_id, x and labels; None if the labels do not have both classes."""
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(FOLDS))
    known = (
        labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
        .where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & (fold != HELD_OUT))
        .groupBy("doc_id")
        .agg(F.max("quality").alias("quality"))
    )
    m = len(NAMES)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 + m + m * m))
        for batch in batches:
            x = np.array(batch.column("x").flatten().to_numpy()).reshape(-1, m)
            y = batch.column("quality").to_numpy()
            for k in (0, 1):
                part = x[y == k]
                total[k] += np.concatenate([[len(part)], part.sum(axis=0), (part.T @ part).ravel()])
        kind = pa.list_(pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array([0, 1], pa.int32()), pa.array(list(total), kind)], ["quality", "sums"])

    parts = statistics_of.join(known, "doc_id").select("quality", "x").transform(mapped, sums, "quality int, sums array<double>")
    rows = (
        parts.select("quality", F.posexplode("sums").alias("place", "value"))
        .groupBy("quality", "place")
        .agg(F.sum("value").alias("value"))
        .collect()  # two classes, a few hundred places
    )
    total = np.zeros((2, 1 + m + m * m))
    for r in rows:
        total[r["quality"], r["place"]] = r["value"]
    n = total[:, 0]
    if not n.all():
        return None
    means = total[:, 1 : 1 + m] / n[:, None]
    covariances = [total[k, 1 + m :].reshape(m, m) / n[k] - np.outer(means[k], means[k]) for k in (0, 1)]
    pooled = np.diag(np.diag((n[0] * covariances[0] + n[1] * covariances[1]) / n.sum()))
    whiten, constants = [], []
    for k in (0, 1):
        shrunk = (1 - p.shrinkage) * covariances[k] + p.shrinkage * pooled + p.ridge * np.eye(m)
        factor = np.linalg.cholesky(shrunk)
        whiten.append(np.linalg.inv(factor))
        constants.append(np.log(n[k] / n.sum()) - np.log(np.diag(factor)).sum())
    return QualityModel(means, np.array(whiten), np.array(constants))


def quality(documents: DataFrame, labels: DataFrame, p: QualityParameters = QualityParameters()) -> DataFrame:
    """doc_id, held_out, score and predicted (1 if score >= 0.7) of every document."""
    rows = stored(measured(documents), "statistics")
    model = fit(rows, labels, p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column("x").flatten().to_numpy()).reshape(-1, len(NAMES))
            scores = model.score(x) if model is not None else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(FOLDS))
    return rows.transform(mapped, run, "doc_id bigint, score double").select(
        "doc_id",
        F.coalesce(fold == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )

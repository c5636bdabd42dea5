"""Toxicity: character n-grams, scaled by naive Bayes log-count ratios, in a linear classifier.

The model is a logistic regression on presence of hashed character n-grams,
each worth its class log-count ratio (Laplace smoothing), as in the public
"NB-SVM" baseline of Wang and Manning, 2012. Fitting uses a bounded sample of
labelled rows (``sample_rows``); scoring reads every whole text.

Null and empty texts have no n-grams and get the model's base score. Rows
without label teach nothing; a document labelled twice is toxic if one label
says so; of several rows of a labelled id, one teaches. A table without labels of both classes scores every text 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.llm.common import free_name, mapped, mix, pieces, stored, utf8_buffer

#: Fixed by the contract of the query: held-out remainder of crc32(doc_id as text) and the threshold.
FOLDS, HELD_OUT, THRESHOLD = 3, 1, 0.7


@dataclass(frozen=True)
class ToxicityParameters:
    widths: tuple[int, ...] = (4, 5, 6)
    bits: int = 20
    #: At most so many labelled rows are used to fit, half of either class at most.
    sample_rows: int = 6000
    #: n-grams that remain after ranking by |log ratio| x sqrt(documents that have it).
    features: int = 4096
    min_documents: int = 3
    l2: float = 1.0
    steps: int = 300


@dataclass(frozen=True)
class ToxicityModel:
    #: Slot of each hashed n-gram among the weights, or -1; then the weights and the bias.
    slots: np.ndarray
    weights: np.ndarray
    bias: float
    widths: tuple[int, ...]
    bits: int


def _lower(buf: np.ndarray) -> np.ndarray:
    out = buf.astype(np.uint64)
    return np.where((buf >= 65) & (buf <= 90), out + np.uint64(32), out)


def ngram_ids(buf: np.ndarray, offs: np.ndarray, widths: tuple[int, ...], bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each width the row and bucket of every n-gram of UTF-8 bytes (ASCII letters in lower case)."""
    text = _lower(buf)
    row = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
    for width in widths:
        n = len(text) - width + 1
        if n <= 0:
            continue
        h = np.zeros(n, dtype=np.uint64)
        for k in range(width):
            h = h * np.uint64(257) + text[k : k + n]
        inside = row[:n] == row[width - 1 :]
        ids = (mix(h + np.uint64(width << 56)) >> np.uint64(64 - bits)).astype(np.int32)
        yield row[:n][inside], ids[inside]


def _presence(texts: pa.Array, widths: tuple[int, ...], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, bucket) pairs."""
    seen = []
    for row, ids in ngram_ids(*utf8_buffer(texts), widths, bits):
        seen.append(np.unique((row.astype(np.int64) << bits) | ids))
    pairs = np.unique(np.concatenate(seen)) if seen else np.zeros(0, dtype=np.int64)
    return pairs >> bits, (pairs & ((1 << bits) - 1)).astype(np.int32)


def labelled_sample(documents: DataFrame, labels: DataFrame, p: ToxicityParameters) -> DataFrame:
    """(toxic, text) of at most ``sample_rows`` labelled documents outside the held-out fold, chosen by hash order."""
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(FOLDS))
    known = (
        labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (fold != HELD_OUT))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    chosen = None
    for value in (0, 1):
        part = known.where(F.col("toxic") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(p.sample_rows // 2)
        chosen = part if chosen is None else chosen.unionByName(part)
    # Bounded by sample_rows, 12 bytes a row. An id on several rows teaches by the one whose text hashes lowest,
    # so that the sample has no more rows than ids.
    near = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    first = F.min(F.struct(F.xxhash64("text").alias("th"), "toxic", "text")).alias("first")
    return near.groupBy("doc_id").agg(first).select("first.toxic", "first.text")


def fit(documents: DataFrame, labels: DataFrame, p: ToxicityParameters = ToxicityParameters()) -> ToxicityModel | None:
    """None if the labels do not have both classes."""
    bits, widths = p.bits, p.widths

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            row, ids = _presence(batch.column("text"), widths, bits)
            parts = np.split(ids, np.searchsorted(row, np.arange(1, batch.num_rows)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array(parts, pa.list_(pa.int32()))], ["toxic", "ids"]
            )

    sample = labelled_sample(documents, labels, p).transform(mapped, features, "toxic int, ids array<int>")

    sample = stored(sample, "toxicity-sample")
    n = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not n.get(0) or not n.get(1):
        return None
    ratio = F.log((F.col("t") + 1.0) / (n[1] + 2.0)) - F.log((F.col("c") + 1.0) / (n[0] + 2.0))
    ranked = (
        sample.select("toxic", F.explode("ids").alias("id"))
        .groupBy("id")
        .agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
        .where(F.col("t") + F.col("c") >= p.min_documents)
        .withColumn("ratio", ratio)
        .orderBy((F.abs("ratio") * F.sqrt(F.col("t") + F.col("c"))).desc(), "id")
        .limit(p.features)
    )
    top = ranked.select("id", "ratio").collect()
    slots = np.full(1 << bits, -1, dtype=np.int32)
    slots[[r["id"] for r in top]] = np.arange(len(top), dtype=np.int32)
    ratios = np.array([r["ratio"] for r in top], dtype=np.float64)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            out = [s[s >= 0] for s in (slots[x.values.to_numpy(zero_copy_only=False)] for x in ids)]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(out, pa.list_(pa.int32()))], ["toxic", "ids"])

    rows = sample.transform(mapped, kept, "toxic int, ids array<int>").toArrow()  # bounded by sample_rows x features
    ids = [np.asarray(x.as_py(), dtype=np.int64) for x in rows["ids"]]
    weights, bias = _logistic(ids, rows["toxic"].to_numpy().astype(np.float64), ratios, p)
    return ToxicityModel(slots, (weights * ratios).astype(np.float64), bias, widths, bits)


def _logistic(ids: list[np.ndarray], y: np.ndarray, ratios: np.ndarray, p: ToxicityParameters) -> tuple[np.ndarray, float]:
    """Minimise the class-balanced, L2-regularised log loss by gradient steps with momentum (Nesterov)."""
    order = np.lexsort((np.array([hash_of(x) for x in ids]), y))  # the same sums whatever order the rows arrived in
    ids, y = [np.sort(ids[i]) for i in order], y[order]
    col = np.concatenate(ids).astype(np.int64)
    row = np.repeat(np.arange(len(y)), [len(x) for x in ids])
    x = ratios[col] / 4.0
    each = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    w, b = np.zeros(len(ratios)), 0.0
    v, c = w.copy(), b
    norm = np.bincount(row, x * x, len(y))
    rate = 1.0 / (0.25 * (np.percentile(norm, 99) + 1.0) * 0.5 + p.l2 * 1e-3)
    for k in range(p.steps):
        z = np.bincount(row, x * v[col], len(y)) + c
        g = each * (1.0 / (1.0 + np.exp(-np.clip(z, -40, 40))) - y)
        gw, gb = np.bincount(col, x * g[row], len(w)) + p.l2 * 1e-3 * v, g.sum()
        new, newb = v - rate * gw, c - rate * gb
        momentum = k / (k + 3.0)
        v, c = new + momentum * (new - w), newb + momentum * (newb - b)
        w, b = new, newb
    return w / 4.0, float(b)


def hash_of(x: np.ndarray) -> int:
    return int(mix(x.astype(np.uint64) + np.uint64(1)).sum(dtype=np.uint64) >> np.uint64(1))


def score_texts(texts: pa.Array, model: ToxicityModel | None) -> np.ndarray:
    if model is None:
        return np.full(len(texts), 0.5)
    z = np.full(len(texts), model.bias)
    for row, ids in ngram_ids(*utf8_buffer(texts), model.widths, model.bits):
        slot = model.slots[ids]
        hit = slot >= 0
        pairs = np.unique((row[hit].astype(np.int64) << 32) | slot[hit])
        z += np.bincount(pairs >> 32, model.weights[pairs & 0xFFFFFFFF], len(texts))
    return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))


def score(documents: DataFrame, model: ToxicityModel | None, into: str = "toxicity_score") -> DataFrame:
    """All columns of ``documents`` and the score (a column of that name is replaced)."""
    frame = documents.drop(into)
    schema = T.StructType([*frame.schema.fields, T.StructField(into, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            out = pa.array(score_texts(batch.column("text"), model), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, out], [*batch.schema.names, into])

    return frame.transform(mapped, run, schema)


def toxicity(documents: DataFrame, labels: DataFrame, p: ToxicityParameters = ToxicityParameters()) -> DataFrame:
    """doc_id, held_out, score and predicted (1 if score >= 0.7) of every document."""
    scored = score(documents.select("doc_id", "text"), fit(documents, labels, p))
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(FOLDS))
    return scored.select(
        "doc_id",
        F.coalesce(fold == HELD_OUT, F.lit(False)).alias("held_out"),
        F.col("toxicity_score").alias("score"),
        (F.col("toxicity_score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_non_toxic(documents: DataFrame, labels: DataFrame, p: ToxicityParameters = ToxicityParameters()) -> DataFrame:
    """The documents that score below the threshold, with their columns."""
    names = documents.columns
    into = free_name(names, "toxicity_score")
    return score(documents, fit(documents, labels, p), into).where(F.col(into) < THRESHOLD).select(*names)

"""Naive Bayes support vectors for document quality.

Features are indicators of byte 2- and 3-grams and of words, hashed to `1 << BITS` buckets.  Class counts
over all labelled rows of the learn fold give each bucket its log-count ratio; the indicators are scaled
by it and each document's vector is brought to length 1.  A linear model with hinge loss is then fitted
by dual coordinate descent on a sample of at most `sample` documents of each class, and its margins are
turned into probabilities on a fifth of that sample that the fit has not seen.

The texts meet their labels in one shuffle, for the counts; the sample is drawn from the labels alone, and
its ids are broadcast.  Neither plan depends on the size of the tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, widened, word_hashes
from .features import byte_ngrams, collected, lists, platt, ragged, row_keys, runs, sigmoid, text_steps
from .sampling import least_ids, one_text_each

BITS = 18
_MASK = np.uint64((1 << BITS) - 1)


def _indicators(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, bucket), in order of the rows."""
    row, bucket = byte_ngrams(buf, offsets, (2, 3), BITS)
    words, at = word_hashes(buf, offsets)
    keys, _ = runs(np.concatenate([row_keys(row, bucket, BITS), row_keys(at, words >> np.uint64(64 - BITS), BITS)]))
    return (keys >> np.uint64(BITS)).astype(np.int64), (keys & _MASK).astype(np.int64)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, rows = np.zeros((2, 1 << BITS), np.int64), np.zeros(2, np.int64)
    for batch in batches:
        label = batch.column(batch.schema.get_field_index("label")).to_numpy(zero_copy_only=False).astype(np.int64)
        rows += np.bincount(label, minlength=2)
        for lo, hi, buf, offsets in text_steps(batch):
            row, bucket = _indicators(buf, offsets)
            for c in (0, 1):
                total[c] += np.bincount(bucket[label[lo:hi][row] == c], minlength=1 << BITS)
    for c in (0, 1):
        at = np.flatnonzero(total[c])
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), c)), pa.array(at), pa.array(total[c][at])], ["label", "bucket", "n"])
        yield pa.RecordBatch.from_arrays([pa.array([c]), pa.array([-1]), pa.array(rows[c : c + 1])], ["label", "bucket", "n"])


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        label = batch.column(batch.schema.get_field_index("label"))
        for lo, hi, buf, offsets in text_steps(batch):
            row, bucket = _indicators(buf, offsets)
            yield pa.RecordBatch.from_arrays([label.slice(lo, hi - lo), ragged(bucket.astype(np.int32), row, hi - lo)], ["label", "buckets"])


def dual_coordinate_descent(values: np.ndarray, columns: np.ndarray, bounds: np.ndarray, sign: np.ndarray, size: int, cost: np.ndarray, epochs: int = 20) -> np.ndarray:
    """Weights that minimise |w|^2 / 2 + sum cost * max(0, 1 - sign * w.x) over sparse rows."""
    w, alpha = np.zeros(size), np.zeros(len(sign))
    square = np.add.reduceat(np.append(values**2, 0), np.minimum(bounds[:-1], len(values))) * (np.diff(bounds) > 0)
    rng = np.random.default_rng(7)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(sign)):
            if square[i] <= 0:
                continue
            at, v = columns[bounds[i] : bounds[i + 1]], values[bounds[i] : bounds[i + 1]]
            new = min(max(alpha[i] - (sign[i] * (w[at] @ v) - 1) / square[i], 0.0), cost[i])
            if new != alpha[i]:
                w[at] += (new - alpha[i]) * sign[i] * v
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w


class QualityModel:
    """ratio: log-count ratio of each bucket; weight: of the scaled indicator; a, b: of the probability."""

    def __init__(self, ratio: np.ndarray, weight: np.ndarray, bias: float, a: float, b: float):
        self.ratio, self.weight, self.bias, self.a, self.b = ratio.astype(np.float32), (ratio * weight).astype(np.float32), bias, a, b

    def margins(self, row: np.ndarray, bucket: np.ndarray, n: int) -> np.ndarray:
        length = np.sqrt(np.bincount(row, self.ratio[bucket].astype(np.float64) ** 2, n))
        return np.bincount(row, self.weight[bucket], n) / np.maximum(length, 1e-9) + self.bias

    def scores(self, margin: np.ndarray) -> np.ndarray:
        return sigmoid(self.a * margin + self.b)


def fit(docs: DataFrame, labels: DataFrame, sample: int = 2000, smoothing: float = 1.0, cost: float = 1.0) -> QualityModel:
    """Fits on docs(doc_id, text) and labels(doc_id, label), both already cut to the learn fold.

    sample bounds the documents of each class that the linear model is fitted on; the class counts are of
    all rows.  Labels other than 0 and 1 and null ids count for nothing; repeated labels count once, and an
    id with both labels is a member of both classes.  Repeated rows of docs count each; of an id's texts
    one is in the sample.  Null and empty texts have no indicator, and a very long text has at most
    `1 << BITS`.  Other columns are ignored.  Without rows of one class every text scores 0.5.
    """
    known = labels.filter("label in (0, 1) and doc_id is not null").select("doc_id", F.col("label").cast("long").alias("label")).distinct()
    known = stored(known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi"), "labels")
    labelled = docs.select("doc_id", "text").join(known.hint("shuffle_hash"), "doc_id")
    counts = labelled.mapInArrow(_counts, "label long, bucket long, n long").groupBy("label", "bucket").agg(F.sum("n").alias("n"))
    total, rows = np.zeros((2, 1 << BITS)), np.zeros(2)
    got = collected(counts)  # at most two rows for each bucket
    label, bucket, n = (got.column(c).to_numpy() for c in ("label", "bucket", "n"))
    for c in (0, 1):
        rows[c] = n[(label == c) & (bucket == -1)].sum()
        mine = (label == c) & (bucket >= 0)
        total[c, bucket[mine]] = n[mine]
    if not rows.all():
        return QualityModel(np.zeros(1 << BITS), np.zeros(1 << BITS), 0.0, 1.0, 0.0)
    rate = np.log((total + smoothing) / (rows[:, None] + 2 * smoothing))
    ratio = rate[1] - rate[0]
    some = one_text_each(docs, least_ids(known, "label", (0, 1), sample))
    some = collected(some.mapInArrow(_vectors, "label long, buckets array<int>"), shuffle=3)
    label, (columns, bounds) = some.column("label").to_numpy(), lists(some, "buckets")
    ratio = ratio.astype(np.float32)
    row = np.repeat(np.arange(len(label), dtype=np.int32), np.diff(bounds))
    scaled = ratio[columns]
    scaled /= np.maximum(np.sqrt(np.bincount(row, scaled**2, len(label))), 1e-9).astype(np.float32)[row]
    # The bias is one more column that every row has.
    columns, values = np.insert(columns, bounds[1:], 1 << BITS), np.insert(scaled, bounds[1:], 1.0)
    bounds = bounds + np.arange(len(bounds))
    own = len(label) - len(label) // 5
    costs = cost * np.where(label == 1, 0.5 / max((label == 1).mean(), 1e-9), 0.5 / max((label == 0).mean(), 1e-9))
    w = dual_coordinate_descent(values, columns, bounds[: own + 1], np.where(label[:own] == 1, 1.0, -1.0), (1 << BITS) + 1, costs)
    margin = np.add.reduceat(w[columns] * values, bounds[:-1])
    held = slice(own, None) if len(set(label[own:])) == 2 else slice(None)
    return QualityModel(ratio, w[:-1], float(w[-1]), *platt(margin[held], label[held]))


def score(docs: DataFrame, model: QualityModel, name: str = "quality_score") -> DataFrame:
    """docs with a column of that name, in [0, 1], added in place of any that it has so named.

    Null and empty texts have no indicator and get the score of the bias.  Repeated rows and ties are
    scored alike; an empty table gives an empty one.
    """
    docs = docs.drop(name)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two numbers for each bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [np.zeros(0)]
            for lo, hi, buf, offsets in text_steps(batch):
                parts.append(shared.value.scores(shared.value.margins(*_indicators(buf, offsets), hi - lo)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(parts))], [*batch.schema.names, name])

    return docs.mapInArrow(run, widened(docs.schema, **{name: "double"}))

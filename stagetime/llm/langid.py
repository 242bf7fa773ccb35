"""Language identification by sparse multinomial logistic regression on TF-IDF character n-grams.

1- to 3-grams of the lower-cased code points are hashed to `1 << BITS` buckets.  Document frequencies
come from all texts of the learn fold.  The weights are trained by follow-the-regularised-leader with
elastic-net penalties (most buckets end at exactly 0), and a temperature fitted on texts that training
has not seen calibrates the probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import widened
from .features import char_ngrams, collected, lists, ragged, row_keys, runs, string_steps
from .sampling import bounded_by_class

BITS = 16
ORDERS = (1, 2, 3)
_MASK = np.uint64((1 << BITS) - 1)


def _terms(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, bucket and count of every distinct bucket of each row, in order of the rows."""
    keys, n = runs(row_keys(*char_ngrams(texts, ORDERS, BITS), BITS))
    return (keys >> np.uint64(BITS)).astype(np.int64), (keys & _MASK).astype(np.int64), n


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, rows = np.zeros(1 << BITS, np.int64), 0
    for batch in batches:
        rows += batch.num_rows
        for _, _, texts in string_steps(batch):
            total += np.bincount(_terms(texts)[1], minlength=1 << BITS)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(total[at], rows))], ["bucket", "n"])


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lang = batch.column(batch.schema.get_field_index("lang"))
        for lo, hi, texts in string_steps(batch):
            row, bucket, n = _terms(texts)
            yield pa.RecordBatch.from_arrays([lang.slice(lo, hi - lo), ragged(bucket.astype(np.int32), row, hi - lo), ragged(n.astype(np.int32), row, hi - lo)], ["lang", "buckets", "counts"])


class FollowTheLeader:
    """Multinomial logistic regression by per-coordinate FTRL with penalties l1 and l2."""

    def __init__(self, size: int, classes: int, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.05, l2: float = 0.01):
        self.z, self.n = np.zeros((size, classes)), np.zeros((size, classes))
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= self.l1, 0.0, -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def learn(self, at: np.ndarray, value: np.ndarray, label: int) -> None:
        w = self.weights(at)
        p = value @ w
        p = np.exp(p - p.max())
        p /= p.sum()
        p[label] -= 1
        g = value[:, None] * p[None, :]
        self.z[at] += g - (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha * w
        self.n[at] += g * g


def best_temperature(logits: np.ndarray, label: np.ndarray) -> float:
    """The temperature of the least negative log-likelihood on a fine grid from 0.05 to 20."""
    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 121))
    loss = []
    for t in grid:
        x = logits / t
        x = x - x.max(axis=1, keepdims=True)
        loss.append((np.log(np.exp(x).sum(axis=1)) - x[np.arange(len(label)), label]).mean())
    return float(grid[int(np.argmin(loss))])


class LanguageModel:
    def __init__(self, langs: list[str], idf: np.ndarray, weight: np.ndarray, temperature: float):
        self.langs, self.idf, self.weight, self.temperature = langs, idf.astype(np.float32), weight.astype(np.float32), temperature

    def logits(self, row: np.ndarray, bucket: np.ndarray, n: np.ndarray, rows: int) -> np.ndarray:
        value = (1 + np.log(n)) * self.idf[bucket]
        length = np.maximum(np.sqrt(np.bincount(row, value**2, rows)), 1e-9)
        return np.stack([np.bincount(row, value * self.weight[bucket, k], rows) for k in range(len(self.langs))], axis=1) / length[:, None] + self.weight[-1]

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        if not self.langs:
            return ["und"] * len(texts), np.zeros(len(texts))
        x = self.logits(*_terms(texts), len(texts)) / self.temperature
        x = np.exp(x - x.max(axis=1, keepdims=True))
        x /= x.sum(axis=1, keepdims=True)
        best = x.argmax(axis=1)
        lettered = [any(map(str.isalpha, t)) for t in texts]
        return [self.langs[k] if has else "und" for k, has in zip(best, lettered, strict=True)], np.where(lettered, x[np.arange(len(texts)), best], 0.0)


def fit(known: DataFrame, sample: int = 1500, epochs: int = 3) -> LanguageModel:
    """Fits on known(doc_id, text, lang); rows with a null lang are ignored.

    sample bounds the rows of each language that train the weights and the temperature; document
    frequencies are of all rows.  Without rows the model answers und.
    """
    known = known.filter("lang is not null").select("doc_id", "text", "lang")
    counts = known.select("text").mapInArrow(_frequencies, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    got = collected(counts)  # at most one row for each bucket
    bucket, n = got.column("bucket").to_numpy(), got.column("n").to_numpy()
    rows = int(n[bucket == -1].sum())
    if not rows:
        return LanguageModel([], np.zeros(1 << BITS), np.zeros((1, 0)), 1.0)
    df = np.zeros(1 << BITS)
    df[bucket[bucket >= 0]] = n[bucket >= 0]
    idf = np.log((1 + rows) / (1 + df)) + 1
    some = bounded_by_class(known, "lang", sample).mapInArrow(_vectors, "lang string, buckets array<int>, counts array<int>")
    some = collected(some, shuffle=5)
    names = some.column("lang").to_pylist()
    langs = sorted(set(names))
    label = np.array([langs.index(x) for x in names])
    (columns, bounds), (counts, _) = lists(some, "buckets"), lists(some, "counts")
    row = np.repeat(np.arange(len(label), dtype=np.int32), np.diff(bounds))
    value = (1 + np.log(counts)) * idf[columns]
    value = value / np.maximum(np.sqrt(np.bincount(row, value**2, len(label))), 1e-9)[row]
    model = FollowTheLeader((1 << BITS) + 1, len(langs))
    own = len(label) - len(label) // 5
    for _ in range(epochs):
        for i in range(own):
            at = slice(bounds[i], bounds[i + 1])
            model.learn(np.append(columns[at], 1 << BITS), np.append(value[at], 1.0), label[i])
    out = LanguageModel(langs, idf, model.weights(), 1.0)
    held = row >= own if own < len(label) else row >= 0
    first = own if own < len(label) else 0
    logits = out.logits(row[held] - first, columns[held], counts[held], len(label) - first)
    out.temperature = best_temperature(logits, label[first:])
    return out


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """docs with lang_pred and lang_score added in place of any columns of those names.

    Null texts, and texts without a letter, are `und` with score 0.  Ties go to the language that is
    first in the alphabet; repeated rows are alike; an empty table gives an empty one.
    """
    docs = docs.drop("lang_pred", "lang_score")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few numbers for each bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = [], [np.zeros(0)]
            for _, _, texts in string_steps(batch):
                got = shared.value.predict(texts)
                langs += got[0]
                scores.append(got[1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(np.concatenate(scores))], [*batch.schema.names, "lang_pred", "lang_score"])

    return docs.mapInArrow(run, widened(docs.schema, lang_pred="string", lang_score="double"))

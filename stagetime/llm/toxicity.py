"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; texts drawn without regard to any label are the unlabelled set.
A linear model over indicators of words and of their 4- and 5-byte beginnings minimises the class-prior-corrected risk
`prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))`; while the bracket is negative, the step goes the other
way, which keeps the model from fitting the unlabelled rows as negatives.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, distinct_pairs, mix, span_hashes, stored, widened, word_spans
from .features import NOT_ALNUM, collected, lists, ragged, sigmoid, text_steps
from .sampling import bounded_by_class, least_ids, one_text_each


def _parts(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every word and of the beginnings of longer words.

    Words are runs of letters and digits, A-Z lower-cased.
    """
    low = LOWER[buf]
    starts, ends, row = word_spans(low, offsets, NOT_ALNUM)
    rows, hashes = [row], [span_hashes(low, starts, ends)]
    for k in (4, 5):
        longer = ends - starts > k
        rows.append(row[longer])
        hashes.append(mix(span_hashes(low, starts[longer], starts[longer] + k) + np.uint64(k)))
    return np.concatenate(rows), np.concatenate(hashes)


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, buf, offsets in text_steps(batch):
            yield pa.RecordBatch.from_arrays([pa.array(distinct_pairs(*_parts(buf, offsets))[1].view(np.int64))], ["word"])


class Vocabulary:
    """Sorted hashes of words, and where the words of texts stand among them."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.there = np.zeros(1 << 20, bool)
        self.there[words >> np.uint64(44)] = True

    def places(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (row, place), sorted by both."""
        row, word = _parts(buf, offsets)
        if not len(self.words):
            return row[:0], row[:0]
        some = self.there[word >> np.uint64(44)]
        row, word = row[some], word[some]
        at = np.minimum(np.searchsorted(self.words, word), len(self.words) - 1)
        hit = self.words[at] == word
        return distinct_pairs(row[hit], at[hit])


class ToxicityModel:
    """words: sorted hashes of the vocabulary; weight: of each; bias."""

    def __init__(self, words: np.ndarray, weight: np.ndarray, bias: float):
        self.vocabulary, self.weight, self.bias = Vocabulary(words), weight, bias

    def scores(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        row, at = self.vocabulary.places(buf, offsets)
        return sigmoid(np.bincount(row, self.weight[at], len(offsets) - 1) + self.bias)


def train(row: np.ndarray, column: np.ndarray, n: int, p: int, share: np.ndarray, prior: float, penalty: float = 4.0, epochs: int = 200, rate: float = 0.1) -> tuple[np.ndarray, np.ndarray, float]:
    """Chosen columns, their weights and the bias from the ones of a matrix of n rows, the first p positive.

    share is the part of all texts that each column's word stands in.  Each weight carries an absolute-value
    penalty of penalty standard deviations of the gradient of a word that is as frequent and has no bearing
    on the label.
    """
    shrink = penalty * prior * np.sqrt(share * (1 - share) * (1 / p + 1 / (n - p)))
    w, bias = _descend(row, column, n, p, prior, shrink, epochs, rate)
    chosen = np.flatnonzero(w)  # what bears on the label is fitted again without the penalty
    place = np.full(len(share), -1)
    place[chosen] = np.arange(len(chosen))
    column = place[column]
    w, bias = _descend(row[column >= 0], column[column >= 0], n, p, prior, np.zeros(len(chosen)), epochs, rate)
    return chosen, w, bias


def risk(g: np.ndarray, p: int, prior: float) -> float:
    """The non-negative risk of margins, the first p of which are of positives."""
    minus = np.logaddexp(0, g)
    return float(prior * np.logaddexp(0, -g[:p]).mean() + max(0.0, minus[p:].mean() - prior * minus[:p].mean()))


def _descend(row: np.ndarray, column: np.ndarray, n: int, p: int, prior: float, shrink: np.ndarray, epochs: int, rate: float) -> tuple[np.ndarray, float]:
    """Adam steps on the non-negative risk; the first p of n rows are the positives, the rest unlabelled."""
    size = len(shrink)
    w, bias = np.zeros(size), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, epochs + 1):
        g = np.bincount(row, w[column], n) + bias
        s = sigmoid(g)
        # The logistic loss of +1 has the slope s - 1, that of -1 the slope s.
        minus = np.logaddexp(0, g)
        push = np.zeros(n)
        if minus[p:].mean() >= prior * minus[:p].mean():
            push[:p] = prior * (s[:p] - 1) / p - prior * s[:p] / p
            push[p:] = s[p:] / (n - p)
        else:
            push[:p] = prior * s[:p] / p
            push[p:] = -s[p:] / (n - p)
        grad = np.append(np.bincount(column, push[row], size) + 1e-4 * w, push.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        pace = rate / (np.sqrt(v / (1 - 0.999**step)) + 1e-6)
        move = pace * m / (1 - 0.9**step)
        w, bias = w - move[:-1], bias - move[-1]
        w = np.sign(w) * np.maximum(np.abs(w) - shrink * pace[:-1], 0)
    return w, float(bias)


def fit(docs: DataFrame, labels: DataFrame, positives: int = 2500, unlabelled: int = 5000, least_df: int = 5, most_words: int = 200_000) -> ToxicityModel:
    """Fits on docs(doc_id, text) and labels(doc_id, toxic), both already cut to the learn fold.

    positives and unlabelled bound the texts of either kind that the weights are fitted on; the vocabulary
    is the words, most_words at most, that stand in least_df of these texts.  The share of texts that a word
    stands in, from which its penalty comes, is of all docs, and the class prior of all labels.  Null ids
    have no label; repeated labels and repeated texts of an id count once among the positives, and
    repeated rows once among the unlabelled.  Null and empty texts have no words; a very long text has at
    most the whole vocabulary.  Other columns are ignored.  Without positives every text gets the score 0.
    """
    nothing = ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), -60.0)
    counts = labels.agg(F.sum(F.expr("int(toxic = 1)")).alias("p"), F.count("toxic").alias("n")).first()
    if not counts["p"]:
        return nothing
    prior = min(max(counts["p"] / counts["n"], 1e-3), 0.9)
    toxic = labels.filter("toxic = 1 and doc_id is not null").select("doc_id", F.lit(1).alias("positive")).distinct()
    toxic = toxic.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    known = one_text_each(docs, least_ids(toxic, "positive", (1,), positives))
    others = bounded_by_class(docs.select("doc_id", "text", F.lit(0).alias("positive")), "positive", unlabelled)
    sample = stored(known.unionByName(others, allowMissingColumns=True).select("text", "positive"), "toxicity-sample")
    words = sample.mapInArrow(_words, "word long").groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least_df)
    words = np.sort(collected(words.orderBy(F.desc("n"), "word").limit(most_words)).column("word").to_numpy().view(np.uint64))
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(words))  # most_words at most

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            positive = batch.column(batch.schema.get_field_index("positive"))
            for lo, hi, buf, offsets in text_steps(batch):
                row, at = shared.value.places(buf, offsets)
                yield pa.RecordBatch.from_arrays([positive.slice(lo, hi - lo), ragged(at.astype(np.int32), row, hi - lo)], ["positive", "places"])

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(len(shared.value.words), np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            for _, _, buf, offsets in text_steps(batch):
                total += np.bincount(shared.value.places(buf, offsets)[1], minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(total[at], rows))], ["place", "n"])

    got = collected(sample.mapInArrow(vectors, "positive int, places array<int>"))
    order = np.argsort(-got.column("positive").to_numpy(), kind="stable")
    got = got.take(pa.array(order)).combine_chunks()
    n, p = got.num_rows, int(got.column("positive").to_numpy().sum())
    if not p or p == n:
        return nothing
    column, bounds = lists(got, "places")
    row = np.repeat(np.arange(n, dtype=np.int32), np.diff(bounds))
    every = collected(docs.select("text").mapInArrow(frequencies, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")))
    place, count = every.column("place").to_numpy(), every.column("n").to_numpy()
    df = np.zeros(len(words))
    df[place[place >= 0]] = count[place >= 0]
    chosen, w, bias = train(row, column, n, p, df / max(count[place < 0].sum(), 1), prior)
    return ToxicityModel(words[chosen], w, bias)


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """docs with a column toxic_score in [0, 1] added in place of any that it has of that name.

    Null and empty texts get the score of the bias.  Repeated rows are scored alike; an empty table
    gives an empty one.
    """
    docs = docs.drop("toxic_score")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # most_words at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [np.zeros(0), *(shared.value.scores(buf, offsets) for _, _, buf, offsets in text_steps(batch))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(parts))], [*batch.schema.names, "toxic_score"])

    return docs.mapInArrow(run, widened(docs.schema, toxic_score="double"))

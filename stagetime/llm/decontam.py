"""Benchmark decontamination: BM25 over test items, searched by every training passage with block-max WAND.

The index is of the test items, in order of length: postings in item order with impacts, and the greatest
impact of each term in each block of `BLOCK` items.  An impact is the BM25 weight of a term in an item over
the item's score against its own text, so a score is the share of an item that a passage holds, and one
threshold fits all items.  Every document is cut into overlapping passages, twice as long as the longest
item and half of that apart, so an item that stands in a document stands whole in a passage.  The block
bounds of many passages are summed at once; only blocks whose bound reaches the threshold are searched,
document at a time.  All items that a passage scores over the threshold are retrieved, and each is verified
by what the passage shares with its question and its answer.

An index is broadcast, so it holds about `INDEX_BYTES` of item text at most.  More items are split by the
hash of their texts, and each part has an index and a pass of its own; item count, document frequencies, mean
and greatest length are those of all items in every part, so a score means the same however many parts there
are.  Equal item texts are one item of the index, with all their ids.
"""

from __future__ import annotations

import bisect
import uuid
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, Scratch, mix, span_hashes, widened, word_spans
from .features import NOT_ALNUM, collected, runs, text_steps

SHINGLE, BLOCK, INDEX_BYTES = 5, 8, 32 << 20
K1, B = 1.2, 0.75

_PLACE = mix(np.arange(1, SHINGLE + 1, dtype=np.uint64)) | np.uint64(1)


def _hashes(text: str) -> np.ndarray:
    raw = LOWER[np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)]
    starts, ends, _ = word_spans(raw, np.array([0, len(raw)]), NOT_ALNUM)
    return span_hashes(raw, starts, ends)


def _shingles(words: np.ndarray) -> np.ndarray:
    out = np.zeros(max(0, len(words) - SHINGLE + 1), np.uint64)
    for k in range(SHINGLE):
        out += words[k : k + len(out)] * _PLACE[k]
    return mix(out)


def question_and_answer(text: str) -> tuple[str, str]:
    """The last sentence is the answer and what stands before it the question; one sentence is both."""
    text = text.strip()
    cut = max(text.rfind(mark, 0, len(text) - 1) for mark in (". ", "? ", "! ", ".\n", "?\n", "!\n"))
    return (text[: cut + 1], text[cut + 1 :].strip()) if cut >= 0 else (text, text)


def overlap(part: np.ndarray, part_shingles: np.ndarray, passage: np.ndarray, passage_shingles: np.ndarray) -> float:
    """Share of the part's words that shared five-word shingles cover; a shorter part is there or not."""
    n = len(part)
    if not n:
        return 1.0
    if n < SHINGLE:
        hit = np.ones(max(0, len(passage) - n + 1), bool)
        for k in range(n):
            hit &= passage[k : k + len(hit)] == part[k]
        return float(hit.any())
    covered = np.zeros(n, bool)
    for at in np.flatnonzero(np.isin(part_shingles, passage_shingles)):
        covered[at : at + SHINGLE] = True
    return float(covered.mean())


class ItemStatistics(NamedTuple):
    """Of all items with words: how many, mean and greatest length, and the items that hold each term."""

    items: int
    mean: float
    longest: int
    terms: np.ndarray
    df: np.ndarray


class ItemIndex:
    """Impact-ordered facts of the items: postings by term, term maxima and block maxima.

    ids has, for each text, the ids of the items that it stands for.  Without statistics the texts are all
    there are.
    """

    def __init__(self, ids: list[list[int | None]], texts: list[str], statistics: ItemStatistics | None = None):
        words = [_hashes(t) for t in texts]
        kept = sorted((i for i, w in enumerate(words) if len(w)), key=lambda i: len(words[i]))
        self.ids, words = [ids[i] for i in kept], [words[i] for i in kept]
        parts = [tuple(map(_hashes, question_and_answer(texts[i]))) for i in kept]
        self.parts = [[(p, _shingles(p)) for p in pair] for pair in parts]
        size = np.array([len(w) for w in words], float)
        counts = [runs(w) for w in words]
        item = np.repeat(np.arange(len(words)), [len(c[0]) for c in counts])
        term = np.concatenate([c[0] for c in counts]) if counts else np.zeros(0, np.uint64)
        tf = np.concatenate([c[1] for c in counts]).astype(float) if counts else np.zeros(0)
        self.terms, place, df = np.unique(term, return_inverse=True, return_counts=True)
        if statistics is None:
            statistics = ItemStatistics(len(words), size.mean() if len(words) else 0.0, int(size.max(initial=0)), self.terms, df)
        self.longest = statistics.longest
        df = statistics.df[np.searchsorted(statistics.terms, self.terms)]
        idf = np.log(1 + (statistics.items - df + 0.5) / (df + 0.5))
        impact = idf[place] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size[item] / max(statistics.mean, 1))) if len(words) else tf
        impact = impact / np.bincount(item, impact, len(words))[item] if len(words) else impact
        order = np.lexsort((item, place))
        self.bounds = np.searchsorted(place[order], np.arange(len(self.terms) + 1))
        self.item, self.impact = item[order], impact[order]
        self.most = np.maximum.reduceat(self.impact, self.bounds[:-1]) if len(self.terms) else np.zeros(0)
        self.there = np.zeros(1 << 18, bool)
        self.there[self.terms >> np.uint64(46)] = True
        block = self.item // BLOCK
        new = np.ones(len(block), bool)
        new[1:] = (block[1:] != block[:-1]) | (place[order][1:] != place[order][:-1])
        at = np.flatnonzero(new)
        self.block, self.block_most = block[at], np.maximum.reduceat(self.impact, at) if len(at) else np.zeros(0)
        self.block_bounds = np.searchsorted(place[order][at], np.arange(len(self.terms) + 1))
        self.blocks = -(-len(words) // BLOCK)
        self.cache: dict[int, tuple[list[int], list[float], list[int], list[float]]] = {}

    def postings(self, term: int) -> tuple[list[int], list[float], list[int], list[float]]:
        """Items and impacts, blocks and the greatest impact in each."""
        if term not in self.cache:
            at, by = slice(self.bounds[term], self.bounds[term + 1]), slice(self.block_bounds[term], self.block_bounds[term + 1])
            self.cache[term] = self.item[at].tolist(), self.impact[at].tolist(), self.block[by].tolist(), self.block_most[by].tolist()
        return self.cache[term]

    def open_blocks(self, passage: np.ndarray, term: np.ndarray, passages: int, least: float) -> list[tuple[int, int]]:
        """(passage, block) where the terms' block maxima sum up to least; passage is sorted, from 0."""
        out: list[tuple[int, int]] = []
        chunk = max(1, 2_000_000 // max(self.blocks, 1))
        for lo in range(0, passages, chunk):
            a, b = np.searchsorted(passage, (lo, lo + chunk))
            t, n = term[a:b], min(chunk, passages - lo)
            size = self.block_bounds[t + 1] - self.block_bounds[t]
            at = np.repeat(self.block_bounds[t] - np.cumsum(size) + size, size) + np.arange(size.sum())
            key = np.repeat(passage[a:b] - lo, size) * self.blocks + self.block[at]
            hit = np.flatnonzero(np.bincount(key, self.block_most[at], n * self.blocks) >= least)
            out += zip((hit // self.blocks + lo).tolist(), (hit % self.blocks).tolist(), strict=True)
        return out

    def search(self, terms: list[int], threshold: float, first: int = 0, last: int = 1 << 60) -> list[tuple[int, float]]:
        """(item, score) of the items from first to last that score the threshold, by block-max WAND."""
        least, found = threshold - 1e-9, []

        def advance(c: list, item: int) -> None:
            c[1] = bisect.bisect_left(c[3][0], item, c[1])
            c[0] = c[3][0][c[1]] if c[1] < len(c[3][0]) and c[3][0][c[1]] <= last else -1

        cursors = [[0, 0, float(self.most[t]), self.postings(t)] for t in terms]
        for c in cursors:
            advance(c, first)
        while True:
            cursors = sorted((c for c in cursors if c[0] >= 0), key=lambda c: c[0])
            bound, pivot = 0.0, -1
            for k, c in enumerate(cursors):
                bound += c[2]
                if bound >= least:
                    pivot = k
                    break
            if pivot < 0:
                return found
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            block, block_bound = item // BLOCK, 0.0
            for c in cursors[: pivot + 1]:
                k = bisect.bisect_left(c[3][2], block)
                if k < len(c[3][2]) and c[3][2][k] == block:
                    block_bound += c[3][3][k]
            if block_bound < least:
                upto = block * BLOCK + BLOCK
                if pivot + 1 < len(cursors):
                    upto = min(upto, cursors[pivot + 1][0])
                for c in cursors[: pivot + 1]:
                    advance(c, max(upto, item + 1))
            elif cursors[0][0] == item:
                score = 0.0
                for c in cursors[: pivot + 1]:
                    score += c[3][1][c[1]]
                    advance(c, item + 1)
                if score >= least:
                    found.append((item, score))
            else:
                for c in cursors[: pivot + 1]:
                    if c[0] < item:
                        advance(c, item)

    def leaks(self, words: np.ndarray, row: np.ndarray, rows: int, threshold: float, question_least: float, answer_least: float) -> list[list[dict]]:
        """For each row, the verified items with their best passage."""
        out: list[dict[int, dict]] = [{} for _ in range(rows)]
        if not len(self.terms) or not len(words):
            return [[] for _ in out]
        some = np.flatnonzero(self.there[words >> np.uint64(46)])
        at = np.minimum(np.searchsorted(self.terms, words[some]), len(self.terms) - 1)
        hit = self.terms[at] == words[some]
        some, at = some[hit], at[hit]
        step = max(32, self.longest)
        first = np.searchsorted(row, np.arange(rows + 1))
        base = np.concatenate([[0], np.cumsum(np.maximum(1, -(-np.diff(first) // step)))])
        own = base[row[some]] + (some - first[row[some]]) // step  # a passage is a stretch of step words and the next
        back = (some - first[row[some]]) >= step
        passage, term = np.concatenate([own, own[back] - 1]), np.concatenate([at, at[back]])
        keys, _ = runs((passage.astype(np.uint64) << np.uint64(32)) | term.astype(np.uint64))
        passage, term = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
        bound = np.bincount(passage, self.most[term], base[-1])
        likely = bound[passage] >= threshold - 1e-9
        passage, term = passage[likely], term[likely]
        cuts = np.searchsorted(passage, np.arange(base[-1] + 1))
        grams: tuple[int, np.ndarray] = (-1, words[:0])
        for p, block in self.open_blocks(passage, term, int(base[-1]), threshold - 1e-9):
            found = self.search(term[cuts[p] : cuts[p + 1]].tolist(), threshold, block * BLOCK, block * BLOCK + BLOCK - 1)
            if not found:
                continue
            r = int(np.searchsorted(base, p, "right")) - 1
            lo = first[r] + (p - base[r]) * step
            text = words[lo : min(lo + 2 * step, first[r + 1])]
            if grams[0] != p:
                grams = p, _shingles(text)
            for item, score in found:
                q, a = (overlap(w, s, text, grams[1]) for w, s in self.parts[item])
                old = out[r].get(item)
                if q >= question_least and a >= answer_least and (old is None or score > old["score"]):
                    out[r][item] = {"score": score, "question_overlap": q, "answer_overlap": a}
        named = [[{"item_id": i, **found} for item, found in x.items() for i in self.ids[item]] for x in out]
        return [sorted(x, key=lambda y: (y["item_id"] is not None, y["item_id"])) for x in named]


_LEAK = pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("question_overlap", pa.float64()), ("answer_overlap", pa.float64())])


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = [_hashes(t) for t in batch.column(0).to_pylist()]
        terms = [np.unique(w) for w in words]
        flat = np.concatenate([*terms, np.zeros(0, np.uint64)]).view(np.int64)
        lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, terms)]), pa.int32()), pa.array(flat))
        yield pa.RecordBatch.from_arrays([batch.column(1), pa.array([len(w) for w in words], pa.int64()), lists], ["part", "size", "terms"])


def _indexes(items: DataFrame, index_bytes: int) -> Iterator[ItemIndex]:
    """Indexes that together hold all items; only one is in the driver at a time."""
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("text is not null")
    texts = items.groupBy("text").agg(F.collect_list(F.struct("item_id")).alias("ids"))
    total = texts.agg(F.sum(F.octet_length("text") + 16 * F.size("ids"))).first()[0] or 0
    parts = int(-(-2 * total // index_bytes)) if total > index_bytes else 1
    scratch, statistics = Scratch(items.sparkSession), None
    if parts > 1:
        texts = scratch.stored(texts.withColumn("part", F.pmod(F.xxhash64("text"), F.lit(parts)).cast("int")), "items")
        sized = scratch.stored(texts.select("text", "part").mapInArrow(_item_terms, "part int, size long, terms array<long>"), "sizes").filter("size > 0")
        base = sized.agg(F.count("*").alias("n"), F.sum("size").alias("sum"), F.max("size").alias("most")).first()
        held = sized.select("part", F.explode("terms").alias("term"))
        df = scratch.stored(held.groupBy("term").agg(F.count("*").alias("df")), "frequencies")
    for k in range(parts):
        got = (texts.filter(F.col("part") == k) if parts > 1 else texts).select("text", "ids").collect()
        got.sort(key=lambda r: r["text"])
        if parts > 1:
            own = collected(df.join(held.filter(F.col("part") == k).select("term").distinct(), "term"))
            term = own.column("term").to_numpy().view(np.uint64)
            order = np.argsort(term)
            statistics = ItemStatistics(base["n"] or 0, (base["sum"] or 0) / max(base["n"] or 0, 1), base["most"] or 0, term[order], own.column("df").to_numpy()[order])
        yield ItemIndex([[x["item_id"] for x in r["ids"]] for r in got], [r["text"] for r in got], statistics)
    scratch.drop("items", "sizes", "frequencies")


_LEAKS = "array<struct<item_id:long,score:double,question_overlap:double,answer_overlap:double>>"


def _searched(docs: DataFrame, index: ItemIndex, least: tuple[float, float, float], name: str) -> DataFrame:
    """docs, which have a text, with a column of that name from one index."""
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaks: list[list[dict]] = []
            for lo, hi, buf, offsets in text_steps(batch):
                low = LOWER[buf]
                starts, ends, row = word_spans(low, offsets, NOT_ALNUM)
                leaks += shared.value.leaks(span_hashes(low, starts, ends), row, hi - lo, *least)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaks, pa.list_(_LEAK))], [*batch.schema.names, name])

    return docs.mapInArrow(run, widened(docs.schema, **{name: _LEAKS}))


def find_leaks(docs: DataFrame, items: DataFrame, threshold: float = 0.6, question_least: float = 0.8, answer_least: float = 0.5, index_bytes: int = INDEX_BYTES, name: str = "leaks") -> DataFrame:
    """docs with a column of that name, leaks: the test items that each text holds, with score and overlaps, by item_id.

    Null, empty and wordless texts, and items without words, leak nothing.  A very long text is searched
    passage by passage.  Repeated rows are treated each on its own; items of equal texts are all returned,
    and count once in the statistics.  A column of that name in docs is replaced; without items every list
    is empty.  An item text's ids are held and told with each of its finds, so the index also holds one number for
    every row of items.  Where items take more than index_bytes, docs are written once with a number for each row,
    every part's finds are stored by that number, and both are joined.
    """
    docs, least = docs.drop(name), (threshold, question_least, answer_least)
    indexes = _indexes(items, index_bytes)
    first = next(indexes)
    second = next(indexes, None)
    if second is None:
        return _searched(docs, first, least, name)
    scratch, row = Scratch(docs.sparkSession), f"row_{uuid.uuid4().hex}"
    numbered = scratch.stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = None
    for k, index in enumerate(chain((first, second), indexes)):
        one = scratch.stored(_searched(numbered.select(row, "text"), index, least, "leaks").filter("size(leaks) > 0").select(row, "leaks"), f"leaks-{k}")
        found = one if found is None else found.unionByName(one)
    order = F.transform("leaks", lambda x: F.struct(x["item_id"].isNotNull().alias("known"), *[x[c] for c in ("item_id", "score", "question_overlap", "answer_overlap")]))
    merged = found.groupBy(row).agg(F.flatten(F.collect_list("leaks")).alias("leaks")).select(row, F.transform(F.array_sort(order), lambda x: x.dropFields("known")).alias(f"{row}_leaks"))
    joined = numbered.join(merged, row, "left")
    return joined.select(*docs.columns, F.coalesce(f"{row}_leaks", F.array().cast(_LEAKS)).cast(_LEAKS).alias(name))


def decontaminate(docs: DataFrame, items: DataFrame, **settings) -> DataFrame:
    """The rows of docs that hold no test item, in docs' own columns, whatever they are called."""
    name = f"leaks_{uuid.uuid4().hex}"
    return find_leaks(docs, items, name=name, **settings).filter(F.size(name) == 0).drop(name)

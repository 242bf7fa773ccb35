"""SimHash near-duplicates by a self-join of binary tries.

1. One pass over the texts makes the fingerprints: bit b is set if over half of a text's three-word shingles,
   repeats included, have it set in their XXH64.  Documents of one fingerprint form a class, represented by
   its least doc_id, so thousands of copies cost one row.
2. The tries are dealt over tasks by their upper levels.  Two fingerprints that differ in at most two bits
   agree on one whole third of the bits, so three tries are laid, each with another third on top, and those
   levels are passed with no error at all.  A subtrie of more than `GROUP` members is dealt again in the same
   way by thirds of its remaining bits, until what remains has at most 12 bits and so at most 4,096
   fingerprints.  Every subtrie is therefore bounded by construction; none is cut, sampled or left out.
3. A task walks pairs of nodes of a subtrie together, from its top with itself down: the children of a pair
   are paired, a 0 child with a 1 child adds one differing bit, and pairs beyond the budget are pruned.
   A pair of fingerprints counts only in the first of the thirds that it agrees on, so it is found once.
4. A task hands on its links joined to stars, so dense groups give one link for a member; star contraction
   makes components.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, Scratch, steps, text_buffer, word_spans
from .components import components

SHINGLE, SEED, BUDGET = 3, 42, 2
#: Members of a subtrie that one task walks at once; subtries of more are dealt by further bits.
GROUP = 4096
#: Node pairs of at most so many pairs of members are compared member by member.
_LEAF = 16
_LANES = np.uint64(0x0101010101010101)


# --- fingerprints -------------------------------------------------------------------------------


def shingle_hashes(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every shingle in order of the rows, and the n + 1 offsets of the rows into them."""
    low = LOWER[buf]
    starts, ends, row = word_spans(low, offsets)
    size = ends - starts
    at = np.cumsum(size + 1) - size - 1  # the words again, one space after each
    total = int(size.sum()) + len(size)
    joined = low[np.minimum(np.arange(total) + np.repeat(starts - at, size + 1), max(len(low) - 1, 0))] if total else low[:0]
    joined[at + size] = 0x20
    n_words = np.bincount(row, minlength=len(offsets) - 1)
    n = np.where(n_words > 0, np.maximum(n_words - SHINGLE + 1, 1), 0)
    cut, first = np.concatenate([[0], np.cumsum(n)]), np.concatenate([[0], np.cumsum(n_words)])[:-1]
    begin = np.arange(cut[-1]) - np.repeat(cut[:-1] - first, n)
    last = begin + np.repeat(np.minimum(n_words, SHINGLE) - 1, n)
    data, digest = joined.tobytes(), xxhash.xxh64_intdigest
    spans = zip(at[begin].tolist(), (at + size)[last].tolist(), strict=True)
    return np.fromiter((digest(data[s:e], SEED) for s, e in spans), np.uint64, int(cut[-1])), cut


def majority(values: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """For each row the bits that over half of its values have set; 0 for a row without values.

    Bits are counted in byte lanes, up to 255 values at a time.
    """
    n = np.diff(cut)
    out = np.zeros(len(n), np.uint64)
    full = np.flatnonzero(n)
    if not len(full):
        return out
    parts = -(-n[full] // 255)
    first = np.cumsum(parts) - parts
    begin = np.repeat(cut[:-1][full], parts) + 255 * (np.arange(parts.sum()) - np.repeat(first, parts))
    for bit in range(8):
        lanes = np.add.reduceat((values >> np.uint64(bit)) & _LANES, begin)
        counts = np.add.reduceat(lanes.astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.int64), first)
        most = (2 * counts > n[full, None]).astype(np.uint64)
        out[full] |= (most << (np.arange(8, dtype=np.uint64) * np.uint64(8) + np.uint64(bit))).sum(axis=1, dtype=np.uint64)
    return out


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        buf, offsets = text_buffer(batch.column(1))
        found = [majority(*shingle_hashes(buf[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])) for lo, hi in steps(offsets)]
        value = np.concatenate(found) if found else np.zeros(0, np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(value.view(np.int64))], ["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp: the 64-bit fingerprint of every row, as a signed long."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_fingerprints, "doc_id long, fp long")


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# --- tries --------------------------------------------------------------------------------------


@cache
def _trie(code: int) -> tuple[int, list[int], list[int]]:
    """Bits on top of the trie of a code, those below from the highest on, and bit sets that a pair must not wholly agree on.

    Code 1 is the trie of all bits; code 3 * c + j - 1, for j = 0, 1, 2, has the j-th third of what lies below in c on top as well.
    """
    if code == 1:
        return 0, list(range(63, -1, -1)), []
    above, j = (code + 1) // 3, (code + 1) % 3
    top, below, unlike = _trie(above)
    edges = [round(len(below) * k / 3) for k in range(4)]
    thirds = [below[edges[k] : edges[k + 1]] for k in range(3)]
    sets = [sum(1 << b for b in t) for t in thirds]
    return top | sets[j], [b for k in range(3) if k != j for b in thirds[k]], [*unlike, *sets[:j]]


def _codes(level: int) -> list[int]:
    """The codes of the tries that are dealt level times."""
    return [1] if level == 0 else [3 * c + j - 1 for c in _codes(level - 1) for j in range(3)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def trie_pairs(value: np.ndarray, cut: np.ndarray, code: int, budget: int = BUDGET) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of all pairs of distinct values of one subtrie that differ in at most budget bits.

    value holds the members of the subtries one after the other (cut: offsets), each sorted by the bits below.
    """
    top, below, unlike = _trie(code)
    a, a_end = cut[:-1], cut[1:]
    b, b_end, d = a, a_end, np.zeros(len(a), np.int8)
    left, right = [], []
    for bit in [*below, None]:
        ends = (a_end - a) * (b_end - b) <= (_LEAF if bit is not None else 1)
        if ends.any():
            m, n = (b_end - b)[ends], ((a_end - a) * (b_end - b))[ends]
            k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            i, j = np.repeat(a[ends], n) + k // np.repeat(m, n), np.repeat(b[ends], n) + k % np.repeat(m, n)
            x = value[i] ^ value[j]
            near = (i < j) & (np.bitwise_count(x) <= budget)
            for bits in unlike:
                near &= (x & np.uint64(bits)) != 0
            left.append(i[near])
            right.append(j[near])
        a, a_end, b, b_end, d = (x[~ends] for x in (a, a_end, b, b_end, d))
        if bit is None or not len(a):
            break
        ones = np.concatenate([[0], np.cumsum(((value >> np.uint64(bit)) & np.uint64(1)).astype(np.int64))])
        a_mid, b_mid = a_end - (ones[a_end] - ones[a]), b_end - (ones[b_end] - ones[b])
        other = a != b
        children = [(a, a_mid, b, b_mid, d, True), (a_mid, a_end, b_mid, b_end, d, True), (a, a_mid, b_mid, b_end, d + 1, True), (a_mid, a_end, b, b_mid, d + 1, other)]
        kept = [(c_end > c) & (e_end > e) & (f <= budget) & also for c, c_end, e, e_end, f, also in children]
        a, a_end, b, b_end, d = (np.concatenate([child[k][keep] for child, keep in zip(children, kept, strict=True)]) for k in range(5))
    return (np.concatenate(left), np.concatenate(right)) if left else (cut[:0], cut[:0])


def _stars(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n places the least one that the links (i, j) reach."""
    least = np.arange(n)
    while True:
        low = np.minimum(least[i], least[j])
        new = least.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == least).all():
            return least
        least = new


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of the subtries of a batch, as stars of representatives, with the number of documents that each member meets."""
    for batch in batches:
        code = batch.column(0).to_numpy(zero_copy_only=False)
        members = batch.column(1)
        offsets = np.asarray(members.offsets, np.int64)
        flat = members.values
        fp, rep, n = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(3))
        fp = fp.view(np.uint64)
        for c in np.unique(code).tolist():
            rows, at = np.flatnonzero(code == c), 0
            size = np.diff(offsets)[rows]
            while at < len(rows):
                end = max(at + 1, at + int(np.searchsorted(np.cumsum(size[at:]), 2 * GROUP, "right")))
                own, cut = size[at:end], np.concatenate([[0], np.cumsum(size[at:end])])
                place = np.arange(cut[-1]) + np.repeat(offsets[rows[at:end]] - cut[:-1], own)
                group, value = np.repeat(np.arange(len(own)), own), fp[place]
                place = place[np.lexsort((value & ~np.uint64(_trie(c)[0]), group))]
                value, reps, docs = fp[place], rep[place], n[place]
                i, j = trie_pairs(value, cut, c)
                met = np.bincount(i, docs[j], len(value)) + np.bincount(j, docs[i], len(value))
                root = _stars(len(value), i, j)
                hit = np.flatnonzero(met)
                yield pa.RecordBatch.from_arrays([pa.array(reps[hit]), pa.array(reps[root[hit]]), pa.array(value[hit].view(np.int64)), pa.array(met[hit].astype(np.int64))], ["a", "b", "fp", "met"])
                at = end


def _linked(classes: DataFrame, scratch: Scratch, group: int = GROUP) -> DataFrame:
    """a, b, fp, met: links of representatives of classes(fp, rep, n), and the documents that each class meets."""
    found = []
    rest = classes.select("fp", "rep", "n", F.lit(1).alias("code"))
    for level in range(1, 64):
        below = {c: [3 * c + j - 1 for j in range(3)] for c in _codes(level - 1)}
        tops = F.create_map(*[F.lit(x) for c, three in below.items() for x in (c, [_signed(_trie(t)[0]) for t in three])])
        nexts = F.create_map(*[F.lit(x) for c, three in below.items() for x in (c, three)])
        dealt = rest.select("fp", "rep", "n", F.explode(F.arrays_zip(nexts[F.col("code")].alias("code"), tops[F.col("code")].alias("top"))).alias("x"))
        dealt = dealt.select("fp", "rep", "n", "x.code", F.col("fp").bitwiseAND(F.col("x.top")).alias("key"))
        sizes = dealt.groupBy("code", "key").agg(F.count("*").alias("members")).filter("members > 1")
        ends = max(len(_trie(c)[1]) for c in _codes(level)) <= 12
        small = sizes if ends else sizes.filter(F.col("members") <= group)
        whole = dealt.join(small.select("code", "key"), ["code", "key"]).groupBy("code", "key").agg(F.collect_list(F.struct("fp", "rep", "n")).alias("members"))
        found.append(scratch.stored(whole.select("code", "members").mapInArrow(_walk, "a long, b long, fp long, met long"), f"links-{level}"))
        if ends:
            break
        large = scratch.stored(sizes.filter(F.col("members") > group).select("code", "key"), f"large-{level}")
        if large.isEmpty():
            break
        rest = scratch.stored(dealt.join(large, ["code", "key"], "left_semi").select("fp", "rep", "n", "code"), f"rest-{level}")
    links = found[0]
    for more in found[1:]:
        links = links.union(more)
    return links


def near_duplicates(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """doc_id, fingerprint, component_id, n_links: one row for each row of docs(doc_id, text, ...).

    Two documents are linked if their fingerprints differ in at most two bits.  component_id is the least
    doc_id that links reach; n_links is the number of other rows that the row is linked with.

    Null or wordless text: fingerprint zero, linked like any other.  Repeated rows: one class, each row
    returned.  A doc_id that several texts share belongs to all their classes, which it joins.  A null
    doc_id: component_id and n_links null, and no part in links.  A very long text is read whole.  Other
    columns are ignored; an empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession)
    made = scratch.stored(fingerprints(docs), "fingerprints")
    real = made.filter("doc_id is not null")
    classes = scratch.stored(real.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")), "classes")
    linked = _linked(classes, scratch, group)
    several = real.groupBy("doc_id").agg(F.min("fp").alias("p"), F.max("fp").alias("q")).filter("p <> q").select("doc_id")
    alias = real.join(several, "doc_id", "left_semi").distinct().join(classes, "fp").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    final = components(linked.select("a", "b").union(alias))
    met = linked.groupBy("fp").agg(F.sum("met").alias("met"))
    known = classes.join(met, "fp", "left").join(final, F.col("rep") == F.col("node"), "left")
    known = known.select("fp", F.coalesce("component", "rep").alias("component_id"), (F.col("n") - 1 + F.coalesce("met", F.lit(0))).alias("n_links"))
    named = real.join(known, "fp").select("doc_id", as_hex(F.col("fp")).alias("fingerprint"), "component_id", "n_links")
    nameless = made.filter("doc_id is null").select("doc_id", as_hex(F.col("fp")).alias("fingerprint"), F.lit(None).cast("long"), F.lit(None).cast("long"))
    return named.union(nameless)

"""b-bit MinHash near-duplicate detection with exact confirmation on whole shingle sets.

1. One pass over the texts makes each document's shingle-set fingerprint, its minima under
   `BANDS * ROWS` hash functions, a band key per `ROWS` minima, and a signature that keeps the low
   `BITS` bits of each minimum.
2. Documents with the same shingle set form a class, keyed by the set's fingerprint; thousands of copies
   cost one row.  Links are of the classes' least doc_ids.
3. Classes that share a band key are candidates.  Round 1 links each class to the band centre with which
   it shares most bands.  A band's centre is the class whose bands hold most classes, summed over its bands:
   the text that the others vary, where it is there, whatever the ids or hash values.  Bands whose classes
   round 1 did not bring together stay open; round 2 finds what can be linked across the parts of open
   bands by an exact prefix and position filter over rare-first shingles.  No round lists the pairs inside
   a known component.
4. Candidates whose collision-corrected similarity, from the bit counts of the signatures, lies more
   than six standard deviations under the threshold go; the rest are confirmed on the full sets.
5. Links are joined to components by star contraction.

A pair at the threshold 0.85 shares no band with probability (1 - 0.85**4)**32 = 6e-11, at 0.8 5e-8.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, distinct_pairs, mix, steps, text_buffer, word_hashes
from .components import components

SHINGLE, BANDS, ROWS, BITS = 5, 32, 4, 4
HASHES = BANDS * ROWS
SIG = [f"s{i}" for i in range(HASHES * BITS // 64)]

_rng = np.random.default_rng(20240131)
_MUL = (_rng.integers(1, 1 << 32, HASHES, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_ADD = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32)
_PLACE = mix(np.arange(1, SHINGLE + 1, dtype=np.uint64)) | np.uint64(1)


def shingles(words: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, sorted by row and hash; words are in order of their rows.

    A row of fewer than SHINGLE words has its whole sequence as its one shingle.
    """
    n = len(words)
    if not n:
        return row[:0], words[:0]
    first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    size = np.diff(np.append(first, n))
    whole = np.flatnonzero(row[: max(0, n - SHINGLE + 1)] == row[SHINGLE - 1 :])
    value = np.zeros(len(whole), np.uint64)
    for k in range(SHINGLE):
        value += words[whole + k] * _PLACE[k]
    short = np.flatnonzero(size < SHINGLE)
    least = size[short].astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D)
    for k in range(SHINGLE - 1):
        has = size[short] > k
        least[has] += words[first[short[has]] + k] * (_PLACE[k] ^ np.uint64(0x5851F42D4C957F2C))
    return distinct_pairs(np.concatenate([row[whole], row[first[short]]]), mix(np.concatenate([value, least])))


def minima(values: np.ndarray) -> np.ndarray:
    """The least value of each hash function over one set."""
    low, out = (values >> np.uint64(32)).astype(np.uint32), np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), 2048):
        part = low[at : at + 2048]
        np.minimum(out, (_MUL[:, None] * part[None, :] + _ADD[:, None]).min(axis=1), out=out)
    return out


def signature(low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Band keys, and the low BITS bits of each scrambled minimum packed in 64-bit words; rows are sets."""
    scrambled = mix(low.astype(np.uint64))
    band = np.zeros((len(low), BANDS), np.uint64)
    for k in range(ROWS):
        band = mix(band + scrambled[:, k::ROWS] + np.uint64(k))
    band = mix(band + np.arange(BANDS, dtype=np.uint64)[None, :])
    per = 64 // BITS
    bits = (scrambled & np.uint64((1 << BITS) - 1)).reshape(len(low), len(SIG), per)
    return band, (bits << (np.arange(per, dtype=np.uint64) * np.uint64(BITS))).sum(axis=2, dtype=np.uint64)


def _per_step(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    buf, offsets = text_buffer(batch.column(batch.schema.get_field_index("text")))
    for lo, hi in steps(offsets):
        row, value = shingles(*word_hashes(buf[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]))
        yield lo, hi, np.searchsorted(row, np.arange(hi - lo + 1)), value


def _fingerprints(cut: np.ndarray, value: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit fingerprints of each set of values."""
    sums = np.zeros((2, len(value) + 1), np.uint64)
    np.cumsum(value, dtype=np.uint64, out=sums[0, 1:])
    np.cumsum(mix(value + np.uint64(1)), dtype=np.uint64, out=sums[1, 1:])
    return [mix(s[cut[1:]] - s[cut[:-1]] + np.diff(cut).astype(np.uint64)) for s in sums]


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, cut, value in _per_step(batch):
            n = np.diff(cut)
            set_a, set_b = _fingerprints(cut, value)
            low = np.stack([minima(value[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)])
            band, sig = signature(low)
            ids = batch.column(batch.schema.get_field_index("doc_id")).slice(lo, hi - lo)
            columns = [ids, pa.array(n, pa.int64()), pa.array(set_a.view(np.int64)), pa.array(set_b.view(np.int64))]
            columns.append(pa.ListArray.from_arrays(pa.array(np.arange(hi - lo + 1) * BANDS, pa.int32()), pa.array(band.view(np.int64).ravel())))
            yield pa.RecordBatch.from_arrays(columns + [pa.array(np.ascontiguousarray(sig[:, i]).view(np.int64)) for i in range(len(SIG))], ["doc_id", "n_shingles", "set_a", "set_b", "bands", *SIG])


_SKETCH = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, " + ", ".join(f"{s} long" for s in SIG)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, cut, value in _per_step(batch):
            key = pa.array(_fingerprints(cut, value)[0].view(np.int64))
            yield pa.RecordBatch.from_arrays([key, pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(value.view(np.int64)))], ["key", "shingle_set"])


def estimated_similarity(left: str, right: str) -> Column:
    """Jaccard similarity from two packed signatures, corrected for chance agreement of BITS bits."""
    unequal = F.lit(0)
    for s in SIG:
        x = F.col(f"{left}.{s}").bitwiseXOR(F.col(f"{right}.{s}"))
        spread = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        spread = spread.bitwiseOR(F.shiftrightunsigned(spread, 2))
        unequal = unequal + F.bit_count(spread.bitwiseAND(F.lit(0x1111111111111111)))
    chance = 2.0**-BITS
    return ((F.lit(1.0) - unequal / F.lit(float(HASHES))) - F.lit(chance)) / F.lit(1 - chance)


def _floor(similarity: float) -> float:
    """Six standard deviations under the threshold, for the estimate from HASHES values of BITS bits."""
    chance = 2.0**-BITS
    p = similarity + (1 - similarity) * chance
    return similarity - 6 * (p * (1 - p) / HASHES) ** 0.5 / (1 - chance)


def _shingle_sets(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """key, shingle_set of all texts of the documents that ids(doc_id) names."""
    texts = docs.select("doc_id", "text").join(ids, "doc_id", "left_semi")
    return texts.mapInArrow(_sets, "key long, shingle_set array<long>").dropDuplicates(["key"])


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of the documents of pairs(a, b, rep_a, rep_b) whose full shingle sets are as similar as percent says."""
    left = pairs.join(sets.select(F.col("key").alias("a"), F.col("shingle_set").alias("x")), "a")
    both = left.join(sets.select(F.col("key").alias("b"), F.col("shingle_set").alias("y")), "b")
    shared = F.size(F.array_intersect("x", "y")).cast("long")
    counted = both.select("rep_a", "rep_b", shared.alias("i"), (F.size("x") + F.size("y")).cast("long").alias("t"))
    return counted.filter(F.expr(f"100 * i >= {percent} * (t - i)")).select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b"))


def _prefix_pairs(parts: DataFrame, sets: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """All pairs (a, b) of keys of different parts(key, rep, part) that can be as similar as percent says.

    Shingles are ordered by how few of the sets hold them.  Two similar sets share one of the first
    n - ceil(percent / 100 * n) + 1 of each, and what follows the first one that they share must still
    make up the overlap; sets of unlike parts share only shingles late in that order and fall away.
    """
    held = sets.select("key", F.explode("shingle_set").alias("s"))
    common = held.groupBy("s").agg(F.count("*").alias("f")).filter("f > 1")
    ranked = held.join(common, "s", "left").groupBy("key").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("f", F.lit(1)).alias("f"), "s"))).alias("r"))
    n = F.size("r")
    first = F.slice("r", 1, n - F.ceil(n * F.lit(percent) / 100).cast("int") + 1)
    prefix = ranked.join(parts, "key").select("key", "part", n.alias("n"), F.posexplode(first).alias("pos", "x")).filter("x.f > 1")
    prefix = scratch.stored(prefix.select("key", "part", "n", "pos", F.col("x.s").alias("s")), "prefixes")
    x, y = prefix.alias("x"), prefix.alias("y")
    after = F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos"))
    can = (100 + percent) * after >= percent * (F.col("x.n") + F.col("y.n"))
    met = x.join(y, (F.col("x.s") == F.col("y.s")) & (F.col("x.key") < F.col("y.key")) & (F.col("x.part") != F.col("y.part")) & can)
    return met.select(F.col("x.key").alias("a"), F.col("y.key").alias("b")).distinct()


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row for each row of docs(doc_id, text, ...).

    Two documents are linked if 100 * |A & B| >= percent * |A | B| over their sets of distinct
    five-word shingles (words are cut at ASCII white space, A-Z lower-cased; fewer than five words make
    one shingle).  component_id is the least doc_id that links reach; kept says that it is the row's own.

    Null or wordless text: an empty set, linked with nothing.  Repeated rows: one class, each row
    returned.  A doc_id that several texts share belongs to all their classes, which it joins.  A null
    doc_id: component_id null, kept true, and no part in links.  Other columns are ignored; an empty
    table gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scratch = Scratch(docs.sparkSession)
    sketch = scratch.stored(docs.mapInArrow(_sketch, _SKETCH), "sketch")
    real = sketch.filter("n_shingles > 0 and doc_id is not null")
    firsts = [F.first(c).alias(c) for c in ("n_shingles", "bands", *SIG)]
    rep = F.min("doc_id").alias("rep")
    classes = scratch.stored(real.groupBy("set_a", "set_b").agg(rep, *firsts), "classes")
    key = F.col("set_a").alias("key")
    sizes = classes.select(key, "rep", "n_shingles", *SIG)
    banded = scratch.stored(classes.select(key, "rep", F.explode("bands").alias("band")), "bands")

    def plausible(pairs: DataFrame) -> DataFrame:
        p, x, y = pairs.alias("p"), sizes.alias("x"), sizes.alias("y")
        close = p.join(x, F.col("p.a") == F.col("x.key")).join(y, F.col("p.b") == F.col("y.key"))
        least, most = F.least("x.n_shingles", "y.n_shingles"), F.greatest("x.n_shingles", "y.n_shingles")
        return close.filter((100 * least >= percent * most) & (estimated_similarity("x", "y") >= _floor(percent / 100))).select("p.a", "p.b", F.col("x.rep").alias("rep_a"), F.col("y.rep").alias("rep_b"))

    crowded = banded.select("band", "key").join(banded.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1"), "band")
    weights = crowded.groupBy("key").agg(F.sum("n").alias("weight"))
    weighed = scratch.stored(crowded.join(weights, "key").select("band", "key", "weight"), "weighed")
    rank = F.struct("weight", F.bitwise_not("key").alias("other"))
    centres = weighed.groupBy("band").agg(F.max_by("key", rank).alias("centre"))
    shared = weighed.join(centres, "band").filter("key <> centre").groupBy("key", "centre").agg(F.count("*").alias("n"))
    best = shared.groupBy("key").agg(F.max_by("centre", F.struct("n", F.bitwise_not("centre"))).alias("centre"))
    pairs = scratch.stored(plausible(best.select(F.col("centre").alias("a"), F.col("key").alias("b"))), "pairs-1")
    sets = scratch.stored(_shingle_sets(pairs.select(F.explode(F.array("rep_a", "rep_b")).alias("doc_id")).distinct(), docs), "sets")
    links = scratch.stored(_confirmed(pairs, sets, percent), "links-1")
    scratch.drop("weighed", "pairs-1", "sets")

    # A doc_id with several texts stands for several classes; it links each to the least one.
    held = scratch.stored(real.select("doc_id", "set_a", "set_b").join(classes.select("set_a", "set_b", "rep"), ["set_a", "set_b"]).select("doc_id", "rep"), "held")
    several = held.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).filter("a <> b").select("doc_id", "a")
    alias = held.join(several, "doc_id").filter("a <> rep").select("a", F.col("rep").alias("b"))
    links = links.union(alias)

    known = scratch.stored(components(links), "known")
    labelled = banded.join(known, F.col("rep") == F.col("node"), "left").select("band", "key", "rep", F.coalesce("component", "rep").alias("part"))
    open_bands = labelled.groupBy("band").agg(F.min("part").alias("p"), F.max("part").alias("q")).filter("p <> q").select("band")
    parts = scratch.stored(labelled.join(open_bands, "band", "left_semi").select("key", "rep", "part").distinct(), "open-parts")
    scratch.drop("bands")
    sets = scratch.stored(_shingle_sets(parts.select(F.col("rep").alias("doc_id")), docs), "sets")
    rest = plausible(_prefix_pairs(parts, sets, percent, scratch))
    more = _confirmed(scratch.stored(rest, "pairs-2"), sets, percent)
    final = components(links.union(more))
    scratch.drop("links-1", "held", "known", "open-parts", "sets", "prefixes", "pairs-2")

    by_class = classes.join(final, F.col("rep") == F.col("node"), "left").select("set_a", "set_b", F.coalesce("component", "rep").alias("component_id"))
    empty = sketch.filter("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    linked = real.join(by_class, ["set_a", "set_b"]).select("doc_id", "n_shingles", "component_id")
    return linked.union(empty).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def without_near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of docs that stay: one of each group of near copies, in docs' own columns.

    The document with the least doc_id stays.  Of rows that share that doc_id the one with the least
    text stays (nulls first, then by the row as JSON); rows with a null doc_id all stay.
    """
    columns = docs.columns
    named = docs.filter("doc_id is not null")
    gone = near_duplicates(named, percent).filter("not kept").select("doc_id").distinct()
    kept = named.join(gone, "doc_id", "left_anti")
    twice = kept.groupBy("doc_id").agg(F.count("*").alias("n_rows")).filter("n_rows > 1").select("doc_id")
    once = kept.join(twice, "doc_id", "left_anti").select(*columns)
    row = F.struct(*columns)
    first = kept.join(twice, "doc_id", "left_semi").groupBy("doc_id").agg(F.min_by(row, F.struct("text", F.to_json(row))).alias("w"))
    first = first.select("w.*")
    return once.unionByName(first).unionByName(docs.filter("doc_id is null"))

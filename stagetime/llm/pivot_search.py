"""Exact top-k by inner product over a pivot-distance index.

A vector x gets one more coordinate, sqrt(M - |x|^2) with M the greatest squared length, and a query a 0;
then the greatest inner products are the least distances.  Each vector is keyed by its nearest pivot and
its distance from it, and the sorted keys are cut into annuli of `ANNULUS` vectors.  A query first looks
into an annulus near its own key; the k-th best score there bounds how far any better vector can lie, and
by the triangle inequality only annuli that come so close to it from their pivot are opened.

Distances are of floating-point numbers and only choose annuli, with a slack beyond their rounding errors;
scores are exact integers.  Vectors of each length are searched by themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

ANNULUS, GROUP = 1024, 128
PIVOT_SAMPLE = 4096
#: Annuli are dealt to so many buckets, of which each is scored in one task.
BUCKETS = 4096


def _choose_pivots(points: np.ndarray, k: int) -> np.ndarray:
    """Farthest-first points of the sample."""
    if not len(points):
        return points
    chosen, far = [0], ((points - points[0]) ** 2).sum(axis=1)
    while len(chosen) < min(k, len(points)) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    return points[chosen]


def _lifted(v: np.ndarray, most: float) -> np.ndarray:
    return np.hstack([v, np.sqrt(np.maximum(most - (v**2).sum(axis=1, keepdims=True), 0))])


def _distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (points**2).sum(axis=1)[:, None] + (pivots**2).sum(axis=1)[None, :] - 2 * points @ pivots.T
    return np.sqrt(np.maximum(square, 0))


def _products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers, cut to what a long holds."""
    if len(q) and len(v) and np.abs(q).max() * np.abs(v).max() * q.shape[1] < 2.0**53:
        return np.rint(q @ v.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    return np.clip(whole(q) @ whole(v).T, -(1 << 63), (1 << 63) - 1)


def _matrix(column: pa.Array) -> np.ndarray:
    values = np.asarray(column.flatten(), float)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 1)


def _blocks(frame: DataFrame, size: int, name: str) -> DataFrame:
    """Rows of one pivot, in order of distance, as one row for each size of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serial = TaskContext.get().partitionId() << 32
        for batch in batches:
            pivot = batch.column(2).to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(pivot)) + 1).tolist(), batch.num_rows]
            for a, b in zip(edges, edges[1:], strict=False):
                for lo in range(a, b, size):
                    part = batch.slice(lo, min(size, b - lo))
                    dist, vec = part.column(3).to_numpy(), part.column(1)
                    lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (part.column(0), part.column(4), vec.flatten())]
                    yield pa.RecordBatch.from_arrays([pa.array([serial]), pa.array(pivot[lo : lo + 1]), pa.array([dist.min()]), pa.array([dist.max()]), *lists], [name, "pivot", "near", "far", "ids", "rows", "vectors"])
                    serial += 1

    ordered = frame.repartitionByRange("pivot", "dist", "row").sortWithinPartitions("pivot", "dist", "row")
    return ordered.select("vec_id", "v", "pivot", "dist", "row").mapInArrow(run, f"{name} long, pivot int, near double, far double, ids array<long>, rows array<long>, vectors array<double>")


_RESULT = "query_id long, rank int, vec_id long, score long"


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0) -> DataFrame:
    """query_id, rank, vec_id, score: the k greatest inner products of each query with all other rows.

    Vectors are rows of vectors(vec_id, embedding, ...), brought to whole numbers floor(scale * x).  Ties
    go to the smaller vec_id; fewer than k other rows give as many.  Null and empty vectors, null ids, and
    vectors with null or non-finite components take no part; a scaled component of 1e150 or more counts as
    not finite.  Only vectors of one length are compared.  Rows that repeat an id are rows of their own: each
    is a candidate of the others, and each query row has its own k rows in the result.  Scores are exact;
    those beyond a long are cut to its ends before they are ranked.  Other columns are ignored; an empty
    table gives an empty result.  The pivots are chosen from PIVOT_SAMPLE rows; every row is indexed.
    """
    spark = vectors.sparkSession
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(F.lit(scale) * x.cast("double")) < 1e150))
    whole = F.transform("embedding", lambda x: _floored(F.lit(scale) * x.cast("double")))
    clean = vectors.filter("vec_id is not null and size(embedding) > 0").filter(F.coalesce(finite, F.lit(False)))
    clean = clean.select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"), is_query.alias("is_query"))
    square = F.aggregate("v", F.lit(0).cast("double"), lambda s, x: s + x * x)
    found = None
    for size in clean.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"), F.max(square).alias("most")).orderBy("d").collect():
        one = _of_one_length(clean.filter(F.size("v") == size["d"]), size["n"], float(size["most"]), k)
        found = one if found is None else found.unionByName(one)
    return spark.createDataFrame([], _RESULT) if found is None else found


def _floored(x: Column) -> Column:
    """floor(x) as a double, which holds it at any size; at 2**52 and beyond x is whole already."""
    return F.when(F.abs(x) < 2.0**52, F.floor(x).cast("double")).otherwise(x)


def _of_one_length(clean: DataFrame, n: int, most: float, k: int) -> DataFrame:
    spark = clean.sparkSession
    slack = 1e-3 + 4e-6 * most**0.5
    place, share = F.pmod(F.xxhash64("vec_id", "v"), F.lit(1 << 62)), min(1.0, 2 * PIVOT_SAMPLE / n)
    sample = np.array([r[0] for r in clean.filter(place < int((1 << 62) * share)).orderBy(place).select("v").limit(PIVOT_SAMPLE).collect()], float)
    sample = sample.reshape(len(sample), -1)
    n_pivots = int(min(256, max(8, n**0.5 / 8)))
    pivots = spark.sparkContext.broadcast(_choose_pivots(_lifted(sample, most), n_pivots))

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 40
        for batch in batches:
            far = _distances(_lifted(_matrix(batch.column(1)), most), pivots.value)
            best = far.argmin(axis=1) if len(far) else np.zeros(0, np.int64)
            row = np.arange(at, at + len(far))
            at += len(far)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(best.astype(np.int32)), pa.array(far[np.arange(len(far)), best]), pa.array(row)], ["vec_id", "v", "is_query", "pivot", "dist", "row"])

    scratch = Scratch(spark)
    keyed = scratch.stored(clean.mapInArrow(key, "vec_id long, v array<double>, is_query boolean, pivot int, dist double, row long"), "keyed")
    annuli = scratch.stored(_blocks(keyed, ANNULUS, "annulus"), "annuli")
    groups = scratch.stored(_blocks(keyed.filter("is_query"), GROUP, "group"), "groups")
    scratch.drop("keyed")
    places = annuli.select("annulus", "pivot", "near", "far")

    def best_of(pairs: DataFrame) -> DataFrame:
        """The k best candidates of each query in each annulus that the pairs name."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for r in range(batch.num_rows):
                    q_ids, q_rows, q, ids, rows, v = (np.asarray(batch.column(c)[r].values) for c in range(6))
                    score = _products(q.reshape(len(q_ids), -1), v.reshape(len(ids), -1)).astype(np.int64)
                    own = q_rows[:, None] == rows[None, :]
                    out: list[tuple[np.ndarray, ...]] = []
                    for i in range(len(q_ids)):
                        free = np.flatnonzero(~own[i])
                        top = free[np.lexsort((rows[free], ids[free], ~score[i, free]))[:k]]
                        out.append((np.full(len(top), q_ids[i]), np.full(len(top), q_rows[i]), ids[top], rows[top], score[i, top]))
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], ["query_id", "query_row", "vec_id", "row", "score"])

        # A group's vectors are sent once to each bucket of annuli that it reaches, not to each annulus.
        bucket = F.pmod(F.xxhash64("annulus"), F.lit(BUCKETS)).alias("bucket")
        reached = pairs.select("group", "annulus", bucket).groupBy("group", "bucket").agg(F.collect_set("annulus").alias("reach"))
        left = reached.join(groups.select("group", F.col("ids").alias("q_ids"), F.col("rows").alias("q_rows"), F.col("vectors").alias("q")), "group").alias("l")
        right = annuli.select(bucket, "annulus", "ids", "rows", "vectors").alias("r")
        both = left.join(right, (F.col("l.bucket") == F.col("r.bucket")) & F.array_contains("l.reach", F.col("r.annulus")))
        return both.select("q_ids", "q_rows", "q", "ids", "rows", "vectors").mapInArrow(run, "query_id long, query_row long, vec_id long, row long, score long")

    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")

    def ranked(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    # The annulus of the group's own pivot whose middle is nearest to the group's; else any that holds rows.
    middle = F.abs(F.col("g.near") + F.col("g.far") - F.col("a.near") - F.col("a.far"))
    first = groups.alias("g").join(places.alias("a"), F.col("g.pivot") == F.col("a.pivot")).groupBy("g.group").agg(F.min_by("a.annulus", F.struct(middle, F.col("a.annulus"))).alias("annulus"))
    seeds = ranked(best_of(first.select("group", "annulus"))).filter(F.col("rank") == k).select("query_row", F.col("score").alias("bound"))
    per_query = groups.select("group", F.explode("rows").alias("query_row")).join(seeds, "query_row", "left")
    bounds = per_query.groupBy("group").agg(F.map_from_entries(F.collect_list(F.struct("query_row", "bound"))).alias("bounds"))  # GROUP at most

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                ids, q = np.asarray(batch.column(1)[r].values), np.asarray(batch.column(2)[r].values)
                q = q.astype(float).reshape(len(ids), -1)
                bound = dict(batch.column(3)[r].as_py())
                score = np.array([-np.inf if (b := bound.get(i)) is None or b == -(1 << 63) else b for i in ids.tolist()], float)
                radius = np.sqrt(np.maximum((q**2).sum(axis=1) + most - 2 * score, 0)) * (1 + 1e-9) + slack
                far = _distances(np.hstack([q, np.zeros((len(q), 1))]), pivots.value)
                lo, hi = (far - radius[:, None]).min(axis=0), (far + radius[:, None]).max(axis=0)
                n = len(lo)
                yield pa.RecordBatch.from_arrays([pa.array([batch.column(0)[r].as_py()] * n, pa.int64()), pa.array(np.arange(n, dtype=np.int32)), pa.array(lo), pa.array(hi)], ["group", "pivot", "lo", "hi"])

    rings = scratch.stored(groups.select("group", "rows", "vectors").join(bounds, "group").mapInArrow(reach, "group long, pivot int, lo double, hi double"), "rings")
    open_rings = rings.alias("r").join(places.alias("a"), (F.col("r.pivot") == F.col("a.pivot")) & (F.col("a.far") >= F.col("r.lo")) & (F.col("a.near") <= F.col("r.hi")))
    found = ranked(best_of(open_rings.select("group", "annulus")))
    return found.select("query_id", "rank", "vec_id", "score")

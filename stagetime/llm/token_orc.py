"""Token ids as ORC files: integer run-length encoding, row indexes, Bloom filters on document ids.

Texts are dealt out by ranges of doc_id and of the text's hash, so that rows of one id can fill several
ranges, and sorted before they are encoded; the only shuffle carries compressed text rather than ids.  Each
file holds one range, in order; stripes are read in parallel, and a lookup by doc_id skips stripes and row
groups by their statistics and Bloom filters.  Run-length encoding has packed the ids already, so the blocks
are compressed by a light codec.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tokens import default_vocabulary, encoder

SCHEMA = "doc_id long, part int, part_start long, n_tokens int, ids array<int>"
_CHUNK = 256


def write_token_files(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = 0, stripe_mb: int = 16, stride: int = 2000) -> None:
    """Writes the ids of docs(doc_id, text, ...) to ORC files under path, in ascending doc_id order.

    Each document ends with end_id.  Null and empty texts have the end id alone; null doc_ids come
    first; rows that share a doc_id stand in order of the text's hash.  Other columns are ignored; an
    empty table leaves files without rows.
    """
    source = vocabulary or default_vocabulary()
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done = TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, _CHUNK):
                rows = batch.slice(at, _CHUNK)
                ids = encoder(source).encode([t or "" for t in rows.column(1).to_pylist()], end)
                cuts = np.cumsum([0, *(len(i) // 4 for i in ids)])
                values = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(np.frombuffer(b"".join(ids), "<i4")))
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array([part] * len(ids), pa.int32()), pa.array(done + cuts[:-1]), pa.array(np.diff(cuts), pa.int32()), values], ["doc_id", "part", "part_start", "n_tokens", "ids"])
                done += int(cuts[-1])

    order = F.col("doc_id").asc_nulls_first(), F.xxhash64("text")
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(*order).sortWithinPartitions(*order)
    options = {"orc.compress": "SNAPPY", "orc.stripe.size": str(stripe_mb << 20), "orc.row.index.stride": str(stride), "orc.create.index": "true", "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01"}
    ordered.mapInArrow(run, SCHEMA).write.options(**options).orc(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).orc(path)


def find_documents(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """Rows of some documents; the filter reaches the stripes' statistics and Bloom filters."""
    return read_token_files(spark, path).filter(F.col("doc_id").isin(doc_ids))


def digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, all from the files.

    start counts the ids of all documents before; the sums of the files, one row for each, are added up
    over the files before; for these only the small columns are read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(4)
            offsets = np.asarray(ids.offsets)
            values = np.ascontiguousarray(np.asarray(ids.values), "<u4")
            crc = [zlib.crc32(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(np.diff(offsets), pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "part", "part_start", "n_tokens", "ids_crc32"])

    rows = read_token_files(spark, path).mapInArrow(run, "doc_id long, part int, part_start long, n_tokens long, ids_crc32 long")
    sums = read_token_files(spark, path).groupBy("part").agg(F.max(F.col("part_start") + F.col("n_tokens")).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sums.select("part", before.alias("before"))
    return rows.join(F.broadcast(starts), "part").select("doc_id", (F.col("before") + F.col("part_start")).alias("start"), "n_tokens", "ids_crc32")

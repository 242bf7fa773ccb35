"""Helpers that the operators share: tables, shared scratch space, Arrow text buffers, hashing."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

#: Bytes of text that one numpy step works on; a single longer document is cut at white space.
STEP_BYTES = 1 << 19


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, as spark.checkpoint.dir names it.

    Only where the setting is missing and all work is in one process, as in tests, a temporary folder takes
    its place; on a cluster a missing setting is an error.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    root = root or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="stagetime-")
        spark.sparkContext.setCheckpointDir(root)
    return root


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/stagetime-{uuid.uuid4().hex}/{name}"


class Scratch:
    """Tables of one run in the shared folder: short lineage that outlives lost executors.

    A name that is stored again replaces the table of that name: the older one is deleted once the newer
    is written.  drop() deletes tables that no result still reads.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.root = spark, shared_path(spark, "")
        self.paths: dict[str, str] = {}

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}{name}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(path)
        self.drop(name)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm = self.spark.sparkContext._jvm
        for name in names:
            if name in self.paths:
                path = jvm.org.apache.hadoop.fs.Path(self.paths.pop(name))
                path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it back."""
    return Scratch(df.sparkSession).stored(df, name)


def widened(schema: StructType, **types: str) -> StructType:
    return StructType([*schema.fields, *(StructField(name, StructType.fromDDL(f"x {kind}")[0].dataType) for name, kind in types.items())])


def fold(key: Column | str, mod: int) -> Column:
    """crc32 of the id as text, modulo mod; a null id falls in fold 0."""
    key = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % mod, F.lit(0))


# --- Arrow text buffers -------------------------------------------------------------------------


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows and the n + 1 offsets into them; a null counts as empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    n = len(column)
    offs = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8) if n else np.zeros(1, np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf[offs[0] : offs[-1]], offs - offs[0]


def steps(offsets: np.ndarray, limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most limit bytes together, or of one longer row."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi
        lo = hi


# --- words and their hashes ---------------------------------------------------------------------

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, STEP_BYTES + 1)
        inverse = pow(_BASE, -1, 1 << 64)
        for b in (_BASE, inverse):
            factors = np.full(size, b, np.uint64)
            factors[0] = 1
            _powers.append(np.cumprod(factors, dtype=np.uint64))
        del _powers[:-2]
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_spans(buf: np.ndarray, offsets: np.ndarray, separator: np.ndarray = SEPARATOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and the row that each is in."""
    inside = ~separator[buf]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    full = offsets[:-1] < offsets[1:]
    at, end = offsets[:-1][full], offsets[1:][full] - 1
    first[at], last[end] = inside[at], inside[end]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(offsets, starts, "right") - 1


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; the same bytes give the same hash anywhere."""
    out = np.empty(len(starts), np.uint64)
    lo = 0
    while lo < len(starts):
        at = starts[lo]
        hi = max(lo + 1, int(np.searchsorted(ends, at + STEP_BYTES, "right")))
        part = buf[at : ends[hi - 1]]
        power, inverse = _power_tables(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * power[: len(part)], dtype=np.uint64, out=sums[1:])
        s, e = starts[lo:hi] - at, ends[lo:hi] - at
        out[lo:hi] = mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        lo = hi
    return out


def word_hashes(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (A-Z lower-cased, cut at ASCII white space) and the row of each."""
    low = LOWER[buf]
    starts, ends, row = word_spans(low, offsets)
    return span_hashes(low, starts, ends), row


def distinct_pairs(row: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, value), sorted by row and value."""
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[new], value[new]

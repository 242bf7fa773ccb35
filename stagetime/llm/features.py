"""Hashed n-gram features of whole texts, made with numpy for many rows at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import STEP_BYTES, mix, steps, text_buffer

#: Bytes that end a word where punctuation counts as space: all ASCII but letters and digits.
NOT_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and how often each stands there."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.diff(np.append(first, len(keys)))


def byte_ngrams(buf: np.ndarray, offsets: np.ndarray, orders: tuple[int, ...], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every n-gram of bytes that lies in one row."""
    sizes = np.diff(offsets)
    row = np.repeat(np.arange(len(sizes), dtype=np.uint32), sizes)
    wide = buf.astype(np.uint64)
    return _ngrams(wide, row, orders, bits)


def _ngrams(code: np.ndarray, row: np.ndarray, orders: tuple[int, ...], bits: int) -> tuple[np.ndarray, np.ndarray]:
    rows, buckets = [], []
    for n in orders:
        m = max(0, len(code) - n + 1)
        key = np.full(m, n, np.uint64)
        for k in range(n):
            key *= np.uint64(0x9E3779B97F4A7C15)
            key += code[k : m + k]
        key ^= key >> np.uint64(29)
        key *= np.uint64(0xBF58476D1CE4E5B9)
        inside = row[:m] == row[n - 1 : m + n - 1]
        rows.append(row[:m][inside])
        buckets.append((key >> np.uint64(64 - bits))[inside])
    return np.concatenate(rows), np.concatenate(buckets)


def char_ngrams(texts: list[str], orders: tuple[int, ...], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every n-gram of code points of the lower-cased texts."""
    low = [t.lower() for t in texts]
    code = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    row = np.repeat(np.arange(len(low), dtype=np.uint32), [len(t) for t in low])
    return _ngrams(code, row, orders, bits)


def row_keys(row: np.ndarray, bucket: np.ndarray, bits: int) -> np.ndarray:
    return (row.astype(np.uint64) << np.uint64(bits)) | bucket.astype(np.uint64)


def text_steps(batch: pa.RecordBatch, name: str = "text") -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First and last row, bytes and offsets of each step over a batch's texts; a null is empty."""
    buf, offsets = text_buffer(batch.column(batch.schema.get_field_index(name)))
    for lo, hi in steps(offsets, STEP_BYTES // 2):
        yield lo, hi, buf[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]


def string_steps(batch: pa.RecordBatch, name: str = "text") -> Iterator[tuple[int, int, list[str]]]:
    column = batch.column(batch.schema.get_field_index(name))
    _, offsets = text_buffer(column)
    for lo, hi in steps(offsets, STEP_BYTES // 2):
        yield lo, hi, [t or "" for t in column.slice(lo, hi - lo).to_pylist()]


def ragged(values: np.ndarray, row: np.ndarray, n: int) -> pa.ListArray:
    """Values, sorted by their rows, as one list for each of n rows."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(n + 1)), pa.int32()), pa.array(values))


def collected(rows: DataFrame, shuffle: int | None = None) -> pa.Table:
    """A bounded result as an Arrow table, in random order where shuffle seeds one."""
    got = rows.toArrow().combine_chunks()
    return got if shuffle is None else got.take(pa.array(np.random.default_rng(shuffle).permutation(got.num_rows))).combine_chunks()


def lists(table: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    """All values of a column of lists, and the bounds of each list in them."""
    column = table.column(name)
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    if not len(column):
        return np.zeros(0, np.int64), np.zeros(1, np.int64)
    bounds = np.asarray(column.offsets, np.int64)
    return np.asarray(column.values)[bounds[0] : bounds[-1]], bounds - bounds[0]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * np.clip(x, -60, 60)))


def platt(margin: np.ndarray, label: np.ndarray, rounds: int = 100) -> tuple[float, float]:
    """a > 0 and b of sigmoid(a * margin + b), fitted with the usual smoothed targets by Newton steps."""
    pos, neg = label.sum(), (1 - label).sum()
    target = np.where(label == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    weight = np.where(label == 1, 0.5 / max(pos, 1), 0.5 / max(neg, 1)) * len(label)
    a, b = 1.0, 0.0
    for _ in range(rounds):
        p = sigmoid(a * margin + b)
        g, h = weight * (p - target), weight * np.maximum(p * (1 - p), 1e-9)
        grad = np.array([(g * margin).sum() + 1e-3 * (a - 1), g.sum()])
        hess = np.array([[(h * margin**2).sum() + 1e-3, (h * margin).sum()], [(h * margin).sum(), h.sum() + 1e-6]])
        step = np.linalg.solve(hess, grad)
        a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -1, 1)
        if abs(step).max() < 1e-6:
            break
    return float(max(a, 1e-3)), float(b)


__all__ = ["NOT_ALNUM", "byte_ngrams", "char_ngrams", "collected", "lists", "mix", "platt", "ragged", "row_keys", "runs", "sigmoid", "string_steps", "text_steps"]

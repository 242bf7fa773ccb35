"""Hierarchical multi-length packing of tokenised documents.

A document's ids (with the end id) are cut into full windows of the longest tier; what is left is routed
to the shortest tier that holds it.  Windows are then filled from the longest piece down: each window is
as long as the tier of its longest piece, its gap takes the longest shorter pieces that fit, and what is
still open is closed by cutting the shortest piece that waits.  So every window but the last few of a
task is full and has a power-of-two length.  The last windows of a task are cut at powers of two, so they
need no padding either.

Windows of one tier form step groups of equal numbers of tokens.  What is left of all tiers at a task's end
is put into groups from the longest window down, which fills them exactly, as each length divides the next;
so a task leaves one group at most that holds fewer tokens, and every row tells how many its group holds.

All of it runs in one pass over each input partition, without a shuffle; a task holds `_ROUND` pieces of
at most one window each.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import default_vocabulary, encoder

TIERS = (256, 512, 1024, 2048)
_ROUND = 2048
_CHUNK = 256


class _Packer:
    """Pieces are (doc_id, start, ids, doc_tokens) with ids as bytes of 32-bit integers."""

    def __init__(self, tiers: tuple[int, ...], group_tokens: int, part: int):
        self.tiers, self.group_tokens = tiers, group_tokens
        self.sequence = self.group = part << 32
        self.open: dict[int, list[list[tuple]]] = {}  # tier -> windows that wait for their group to fill
        self.pool: list[tuple[int, int, tuple]] = []  # (length, tie, piece), sorted
        self.tie = 0
        self.rows: list[tuple] = []

    def add(self, doc_id, ids: bytes) -> None:
        n, most = len(ids) // 4, self.tiers[-1]
        for start in range(0, n, most):
            piece = (doc_id, start, ids[4 * start : 4 * (start + most)], n)
            if start + most <= n:
                self._emit([piece], most)
            else:
                self._wait(piece)
        if len(self.pool) >= _ROUND:
            self._fill(_ROUND // 2)

    def _wait(self, piece: tuple) -> None:
        self.tie += 1
        bisect.insort(self.pool, (len(piece[2]) // 4, self.tie, piece))

    def _fill(self, keep: int) -> None:
        while len(self.pool) > keep:
            length, _, piece = self.pool.pop()
            tier = self.tiers[bisect.bisect_left(self.tiers, length)]
            window, gap = [piece], tier - length
            while gap and self.pool:
                at = bisect.bisect_left(self.pool, (gap + 1,)) - 1
                if at >= 0:
                    length, _, piece = self.pool.pop(at)
                else:
                    length, (doc_id, start, ids, n) = gap, self.pool.pop(0)[2]
                    piece = (doc_id, start, ids[: 4 * gap], n)
                    self._wait((doc_id, start + gap, ids[4 * gap :], n))
                window.append(piece)
                gap -= length
            if gap:
                self._close(window)
            else:
                self._emit(window, tier)

    def _close(self, window: list[tuple]) -> None:
        """The last pieces of a task, cut into windows whose lengths are powers of two."""
        left = sum(len(p[2]) // 4 for p in window)
        while left:
            size = 1 << (left.bit_length() - 1)
            part, need = [], size
            while need:
                doc_id, start, ids, n = window.pop(0)
                have = len(ids) // 4
                if have > need:
                    window.insert(0, (doc_id, start + need, ids[4 * need :], n))
                    ids, have = ids[: 4 * need], need
                part.append((doc_id, start, ids, n))
                need -= have
            self._emit(part, size)
            left -= size

    def _emit(self, window: list[tuple], tier: int) -> None:
        waiting = self.open.setdefault(tier, [])
        waiting.append(window)
        if (len(waiting) + 1) * tier > self.group_tokens:
            self._group([(tier, w) for w in self.open.pop(tier)])

    def _group(self, windows: list[tuple[int, list[tuple]]]) -> None:
        total = sum(tier for tier, _ in windows)
        for tier, window in windows:
            offset = 0
            for doc_id, start, ids, n in window:
                length = len(ids) // 4
                self.rows.append((doc_id, start, length, zlib.crc32(ids), n, self.sequence, offset, tier, self.group, total, ids))
                offset += length
            self.sequence += 1
        self.group += 1

    def finish(self) -> None:
        self._fill(0)
        group: list[tuple[int, list[tuple]]] = []
        for tier in sorted(self.open, reverse=True):
            for window in self.open[tier]:
                if group and sum(t for t, _ in group) + tier > self.group_tokens:
                    self._group(group)
                    group = []
                group.append((tier, window))
        self.open.clear()
        if group:
            self._group(group)


_FIELDS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step_group", "group_tokens"]


def pack(docs: DataFrame, vocabulary: str | None = None, end_id: int = 1, tiers: tuple[int, ...] = TIERS, group_tokens: int = 8 * 2048, with_ids: bool = True) -> DataFrame:
    """One row for each piece of a document: where it stands in its document and in its sequence.

    Columns: doc_id, start, length, ids_crc32 (of the little-endian unsigned 32-bit ids), doc_tokens,
    sequence_id, offset, tier (the sequence's length), step_group, group_tokens (how many tokens the group
    holds) and, if with_ids, ids.  Offsets of a
    sequence are gapless from 0 and its lengths add up to tier.  tiers are rising powers of two.

    Null and empty texts have the end id alone.  Repeated rows and null doc_ids are documents of their
    own.  A very long text fills windows of its own.  Other columns are ignored; an empty table gives an
    empty result.
    """
    path = vocabulary or default_vocabulary()
    end = end_id.to_bytes(4, "little")
    names = [*_FIELDS, *["ids"] * with_ids]
    types = [pa.int64()] * len(_FIELDS) + [pa.list_(pa.int32())] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        packer = _Packer(tiers, group_tokens, TaskContext.get().partitionId())

        def out() -> pa.RecordBatch:
            rows, packer.rows = packer.rows, []
            columns = [pa.array([r[k] for r in rows], pa.int64()) for k in range(len(_FIELDS))]
            if with_ids:
                ends = np.cumsum([0, *(r[2] for r in rows)])
                columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(r[-1] for r in rows), "<i4"))))
            return pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(columns, types, strict=True)], names)

        for batch in batches:
            for at in range(0, batch.num_rows, _CHUNK):
                part = batch.slice(at, _CHUNK)
                for doc_id, ids in zip(part.column(0).to_pylist(), encoder(path).encode([t or "" for t in part.column(1).to_pylist()], end), strict=True):
                    packer.add(doc_id, ids)
                if packer.rows:
                    yield out()
        packer.finish()
        if packer.rows:
            yield out()

    schema = ", ".join(f"{c} long" for c in _FIELDS) + ", ids array<int>" * with_ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def sequences(pieces: DataFrame) -> DataFrame:
    """sequence_id, tier, step_group, input_ids, doc_ids: the windows that pack(with_ids=True) makes."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    whole = pieces.groupBy("sequence_id", "tier", "step_group").agg(parts.alias("p"))
    return whole.select("sequence_id", "tier", "step_group", F.flatten("p.ids").alias("input_ids"), F.col("p.doc_id").alias("doc_ids"))

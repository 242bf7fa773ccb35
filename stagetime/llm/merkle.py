"""Merkle manifest of a dataset: one binary hash tree for each language and one over their roots, in van Emde Boas layout.

Leaves are ranked over tasks: rows are dealt by ranges of (lang, doc_id), and only counts of the parts are
brought together.  A tree of any size is stored as aligned blocks of at most 2**HEIGHT leaves, one row each, and the
roots of its blocks are the leaves of the blocks above, until one block is left.  So a language that holds
most rows is dealt over tasks like any other, and no task holds more than one block at a time.

Within a block the nodes stand in van Emde Boas order: the upper half of the levels first, then the
subtrees below it one after the other, each laid in the same way.  `address` finds a node by arithmetic
alone, for construction as for siblings; whatever the size of a page or cache line, a way from a leaf to the top
touches few of them.

A run of one node is hashed alone, so each level above n nodes has (n + 1) // 2.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, widened

HEIGHT = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: One step of a way to the root: whether a sibling stands left (1), right (2) or nowhere (0), and its digest.
_STEP = 33


# --- layout -------------------------------------------------------------------------------------


def address(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Places in van Emde Boas order of the nodes of the given depth in a tree of so many levels."""
    if levels == 1:
        return np.zeros_like(index)
    top = levels // 2
    if depth < top:
        return address(top, depth, index)
    bottom, below = levels - top, depth - top
    return (1 << top) - 1 + (index >> below) * ((1 << bottom) - 1) + address(bottom, below, index & ((1 << below) - 1))


@cache
def _rows(levels: int) -> list[np.ndarray]:
    """The addresses of every depth."""
    return [address(levels, depth, np.arange(1 << depth)) for depth in range(levels)]


def levels_of(leaves: int, size: int, height: int = HEIGHT) -> int:
    """Levels of a block of so many leaves in a tree of size: all where blocks stand above it, else up to its own top."""
    return height + 1 if size > 1 << height else (leaves - 1).bit_length() + 1


def lay_out(digests: list[bytes], levels: int) -> bytes:
    """The nodes of a block in van Emde Boas order, 32 bytes each; places without a node hold zeros."""
    nodes = np.zeros(((1 << levels) - 1, 32), np.uint8)
    rows = _rows(levels)
    for depth in range(levels - 1, -1, -1):
        nodes[rows[depth][: len(digests)]] = np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 32)
        text = b"".join(digests).hex().encode()
        digests = [sha256(text[at : at + 128]).digest() for at in range(0, len(text), 128)]
    return nodes.tobytes()


def ways(nodes: bytes, leaves: int, levels: int) -> list[bytes]:
    """For each leaf of a block the steps from it to the top of the block."""
    store = np.frombuffer(nodes, np.uint8).reshape(-1, 32)
    out = np.zeros((leaves, levels - 1, _STEP), np.uint8)
    for k in range(levels - 1):
        depth = levels - 1 - k
        own = np.arange(leaves) >> k
        other = own ^ 1
        there = other < -(-leaves // (1 << k))
        out[there, k, 0] = np.where(own & 1, 1, 2)[there]
        out[there, k, 1:] = store[address(levels, depth, other[there])]
    return [x.tobytes() for x in out]


def top_of(nodes: bytes) -> bytes:
    return nodes[:32]


def fold(digest: str, way: list[tuple[int, str]]) -> str:
    """The root that a leaf's digest and its way lead to, as hex text."""
    for side, other in way:
        digest = sha256((other + digest if side == 1 else digest + other).encode()).hexdigest()
    return digest


# --- building -----------------------------------------------------------------------------------


def leaf_digest(**changed: Column) -> Column:
    """Hex sha256 of the fields of a document: - for null, else the UTF-8 byte count, a colon and the value."""
    parts = []
    for name in FIELDS:
        value = changed.get(name, F.col(name)).cast("string")
        parts.append(F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return F.sha2(F.concat(*parts), 256)


def _ranked(rows: DataFrame, order: list[str], scratch: Scratch, name: str) -> DataFrame:
    """rows with rank (from 0, by order, within tree) and size (rows of the tree), without bringing a tree together."""
    placed = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order).withColumn("place", F.monotonically_increasing_id())
    placed = scratch.stored(placed.withColumn("part", F.shiftright("place", 33)), name)
    counts = placed.groupBy("tree", "part").agg(F.count("*").alias("n"), F.min("place").alias("least"))
    own = Window.partitionBy("tree")
    before = F.coalesce(F.sum("n").over(own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("tree", "part", (before - F.col("least")).alias("shift"), F.sum("n").over(own).alias("size"))
    return placed.join(starts, ["tree", "part"]).withColumn("rank", F.col("place") + F.col("shift")).drop("place", "part", "shift")


def _lay_blocks(height: int):
    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, members = batch.column("size").to_pylist(), batch.column("members")
            nodes = []
            for k in range(batch.num_rows):
                digests = members[k].values.field("digest").to_pylist()
                nodes.append(lay_out(digests, levels_of(len(digests), size[k], height)))
            columns = [*batch.columns, pa.array(nodes, pa.binary()), pa.array(map(top_of, nodes), pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "nodes", "top"])

    return lay


def _blocks(ranked: DataFrame, height: int) -> DataFrame:
    """tree, block, size, members, nodes, top of the leaves ranked(tree, rank, size, digest, further columns)."""
    carried = [c for c in ranked.columns if c not in ("tree", "rank", "size")]
    grouped = ranked.groupBy("tree", F.shiftright("rank", height).alias("block")).agg(F.max("size").alias("size"), F.array_sort(F.collect_list(F.struct("rank", *carried))).alias("members"))
    return grouped.mapInArrow(_lay_blocks(height), widened(grouped.schema, nodes="binary", top="binary"))


def _raise(ranked: DataFrame, height: int, scratch: Scratch, name: str) -> list[DataFrame]:
    """The blocks of all levels over ranked leaves; each level's block roots are the next one's leaves."""
    levels = [scratch.stored(_blocks(ranked, height), f"{name}-0")]
    while True:
        open_blocks = levels[-1].filter(F.col("size") > 1 << height)
        if open_blocks.isEmpty():
            return levels
        above = open_blocks.select("tree", F.col("block").alias("rank"), (F.shiftright(F.col("size") - 1, height) + 1).alias("size"), F.col("top").alias("digest"))
        levels.append(scratch.stored(_blocks(above, height), f"{name}-{len(levels)}"))


def _handed_down(height: int):
    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.to_pylist():
                n = x["leaves"]
                own = ways(x["nodes"], n, levels_of(n, x["size"], height))
                trees, ranks = [x["tree"]] * n, [(x["block"] << height) + i for i in range(n)]
                rest = [[x[c]] * n for c in ("subroot", "root")]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip([trees, ranks, [w + x["way"] for w in own], *rest], [pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.binary()], strict=True)], ["tree", "block", "way", "subroot", "root"])

    return down


def _upper_ways(levels: list[DataFrame], tops: DataFrame, height: int) -> DataFrame:
    """tree, block, way, subroot, root of every block of the lowest level; tops has way, subroot and root by tree."""
    above = None
    for level in reversed(levels):
        whole = level.filter(F.col("size") <= 1 << height).select("tree", "block").join(tops, "tree").select("tree", "block", "way", "subroot", "root")
        ways_here = whole if above is None else whole.union(above)
        if level is levels[0]:
            return ways_here
        own = level.select("tree", "block", "size", F.size("members").alias("leaves"), "nodes").join(ways_here, ["tree", "block"])
        above = own.mapInArrow(_handed_down(height), "tree string, block long, way binary, subroot binary, root binary")


class Manifest:
    """Stored blocks of all trees: levels[0] holds the leaves of the documents, top_levels the languages' roots."""

    def __init__(self, docs: DataFrame, tampered: Column | None = None, height: int = HEIGHT):
        """Builds the trees of docs(doc_id, text, lang, source, n_chars, ...).

        tampered says of which rows a second digest is kept, with n_chars greater by one, to try the proofs with.
        """
        self.height, scratch = height, Scratch(docs.sparkSession)
        greater = (F.col("n_chars").cast("decimal(38,0)") + 1).cast("string")
        other = F.when(F.coalesce(tampered, F.lit(False)) & F.col("n_chars").isNotNull(), F.unhex(leaf_digest(n_chars=greater))) if tampered is not None else F.lit(None).cast("binary")
        tree = F.when(F.col("lang").isNull(), F.lit("")).otherwise(F.concat(F.lit("+"), "lang"))
        leaves = docs.select(tree.alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), F.unhex(leaf_digest()).alias("digest"), other.alias("other"))
        leaves = scratch.stored(leaves, "leaves")
        self.levels = _raise(_ranked(leaves, ["doc_id", "digest"], scratch, "ranked"), height, scratch, "blocks")
        subroots = self.levels[0].filter(F.col("size") <= 1 << height).select("tree", "top")
        for level in self.levels[1:]:
            subroots = subroots.union(level.filter(F.col("size") <= 1 << height).select("tree", "top"))
        langs = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("lang_key"), F.col("top").alias("digest"))
        self.langs = scratch.stored(_ranked(langs, ["lang_key"], scratch, "ranked-langs"), "langs")
        self.top_levels = _raise(self.langs.select("tree", "rank", "size", "digest"), height, scratch, "top")
        scratch.drop("leaves", "ranked", "ranked-langs")

    def table(self) -> DataFrame:
        """lang, top (whether over languages), level, block, leaves, nodes: the stored blocks."""
        found = None
        for top, levels in ((False, self.levels), (True, self.top_levels)):
            for k, level in enumerate(levels):
                lang = F.lit(None).cast("string") if top else F.when(F.col("tree") != "", F.substring("tree", 2, 1 << 30))
                rows = level.select(lang.alias("lang"), F.lit(top).alias("top"), F.lit(k).alias("level"), "block", F.size("members").alias("leaves"), "nodes")
                found = rows if found is None else found.union(rows)
        return found

    def proofs(self) -> DataFrame:
        """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, from the stored blocks.

        proof_sha256 is of the siblings' digests from the leaf to the root, as hex text one after the other;
        folded_root is what the tampered digest, where there is one, else the leaf, and the siblings lead to.
        """
        highest = self.top_levels[-1].select(F.lit("").alias("tree"), F.lit(b"").alias("way"), F.col("top").alias("subroot"), F.col("top").alias("root"))
        in_top = _upper_ways(self.top_levels, highest, self.height)
        own = self.top_levels[0].select("tree", "block", "size", F.size("members").alias("leaves"), "nodes").join(in_top, ["tree", "block"])
        by_rank = own.mapInArrow(_handed_down(self.height), "tree string, block long, way binary, subroot binary, root binary")
        by_rank = by_rank.select(F.col("block").alias("rank"), "way", "root")
        tops = self.langs.join(by_rank, "rank").select(F.col("lang_key").alias("tree"), "way", F.col("digest").alias("subroot"), "root")
        found = self.levels[0].join(_upper_ways(self.levels, tops, self.height), ["tree", "block"])
        return found.select("size", "members", "nodes", "way", "subroot", "root").mapInArrow(_prove(self.height), _PROOF)


_PROOF = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _steps(way: bytes) -> list[tuple[int, str]]:
    return [(way[at], way[at + 1 : at + _STEP].hex() if way[at] else "") for at in range(0, len(way), _STEP)]


def _prove(height: int):
    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                x = {c: batch.column(c)[k] for c in batch.schema.names}
                members = x["members"].values
                n = len(members)
                subroot, root, upper = x["subroot"].as_py().hex(), x["root"].as_py().hex(), _steps(x["way"].as_py())
                rows = []
                for leaf, other, way in zip(members.field("digest").to_pylist(), members.field("other").to_pylist(), ways(x["nodes"].as_py(), n, levels_of(n, x["size"].as_py(), height)), strict=True):
                    steps = [*_steps(way), *upper]
                    folded = fold((other or leaf).hex(), steps)
                    rows.append((leaf.hex(), subroot, root, sha256("".join(s for _, s in steps).encode()).hexdigest(), folded, folded == root))
                columns = [pa.array(c) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays([members.field("doc_id"), *columns], ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    return prove


def proofs(docs: DataFrame, tampered: Column | None = None, height: int = HEIGHT) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: one row for each row of docs.

    Leaves ascend by doc_id within lang, null first, and rows that share a doc_id by their digest; languages
    ascend bytewise, null first.  Nulls in any column hash as `-`; empty and very long texts hash as they
    are; repeated rows are leaves each.  Other columns are ignored; an empty table gives an empty result.
    """
    return Manifest(docs, tampered, height).proofs()


_CRC_SQL = """bits(n, c, k) AS (SELECT n, n::BIGINT, 0 FROM range(256) r(n) UNION ALL SELECT n, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY n) AS t FROM bits WHERE k = 8)"""


def crc32_sql(text: str) -> str:
    """crc32 of an ASCII text in DuckDB SQL, beside the table of _CRC_SQL."""
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length({text}) + 1), lambda i: ascii(substr({text}, i, 1))::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"


def proofs_sql() -> str:
    """The same over documents in DuckDB SQL, tampering where 7 divides the crc32 of doc_id."""
    field = lambda x: f"CASE WHEN {x} IS NULL THEN '-' ELSE strlen({x}::VARCHAR) || ':' || {x}::VARCHAR END"
    digest = lambda n: "sha256(" + " || ".join(field(n if c == "n_chars" else c) for c in FIELDS) + ")"
    return f"""
WITH RECURSIVE {_CRC_SQL},
hashed AS (SELECT doc_id, lang, {digest("n_chars")} AS leaf, CASE WHEN {crc32_sql("doc_id::VARCHAR")} % 7 = 0 THEN {digest("(n_chars + 1)")} END AS other FROM documents, crc),
leaves AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n, row_number() OVER () AS r FROM hashed),
nodes(lang, k, i, n, h) AS (SELECT lang, 0, i, n, leaf FROM leaves UNION ALL SELECT lang, k + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM nodes WHERE n > 1 GROUP BY lang, k, i // 2, n),
subroots AS (SELECT lang, k AS height, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1),
top(k, i, n, h) AS (SELECT 0, i, n, h FROM subroots UNION ALL SELECT k + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY k, i // 2, n),
steps AS (SELECT r, k, a.i >> k AS own, a.n FROM (SELECT leaves.*, height FROM leaves JOIN subroots s ON leaves.lang IS NOT DISTINCT FROM s.lang) a, range(64) g(k) WHERE k < height),
low AS (SELECT r, s.k, own % 2 AS odd, o.h FROM steps s JOIN leaves l USING (r) LEFT JOIN nodes o ON o.lang IS NOT DISTINCT FROM l.lang AND o.k = s.k AND o.i = xor(own, 1)),
high AS (SELECT r, u.height + g.k AS k, (u.i >> g.k) % 2 AS odd, o.h FROM leaves l JOIN subroots u ON l.lang IS NOT DISTINCT FROM u.lang, range(64) g(k) LEFT JOIN top o ON o.k = g.k AND o.i = xor(u.i >> g.k, 1) WHERE g.k < (SELECT max(k) FROM top)),
path AS (SELECT * FROM low UNION ALL SELECT * FROM high),
proof AS (SELECT r, string_agg(h, '' ORDER BY k) AS s FROM path GROUP BY r),
folded(r, k, h) AS (SELECT r, 0, coalesce(other, leaf) FROM leaves UNION ALL
  SELECT f.r, f.k + 1, sha256(CASE WHEN odd = 1 THEN coalesce(p.h, '') || f.h ELSE f.h || coalesce(p.h, '') END) FROM folded f JOIN path p ON p.r = f.r AND p.k = f.k),
ends AS (SELECT r, arg_max(h, k) AS h FROM folded GROUP BY r)
SELECT doc_id, leaf, u.h AS subroot, t.h AS root, sha256(coalesce(s, '')) AS proof_sha256, ends.h AS folded_root, ends.h = t.h AS verified
FROM leaves l JOIN subroots u ON l.lang IS NOT DISTINCT FROM u.lang JOIN ends USING (r) LEFT JOIN proof USING (r), (SELECT h FROM top WHERE n = 1) t
"""

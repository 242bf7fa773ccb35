"""Bounded, repeatable samples of labelled rows.  No id, however often it stands there, can exceed them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UNIT = 1 << 62


def _spread(*columns: str) -> Column:
    return F.xxhash64(*columns, F.lit("sample"))


def bounded_by_class(rows: DataFrame, label: str, most: int) -> DataFrame:
    """About most of the distinct rows(doc_id, text, label) of each label at most; all of smaller labels.

    Rows are chosen by the hash of doc_id and text and repeats of a row count once, so a doc_id or a row
    that stands there many times takes no more than its share.  Only the counts of the labels reach the
    driver.
    """
    counts = {r[0]: r[1] for r in rows.groupBy(label).count().collect()}
    keep: Column = F.lit(False)
    place = F.pmod(_spread("doc_id", "text"), F.lit(_UNIT))
    for value, n in counts.items():
        share = min(1.0, most / max(n, 1))
        keep = keep | ((F.col(label) == F.lit(value)) & (place < int(_UNIT * share)))
    return rows.filter(keep).select("doc_id", "text", label).dropDuplicates()


def least_ids(labels: DataFrame, label: str, values: tuple, most: int) -> DataFrame:
    """doc_id and label of at most `most` ids of each value: those of the least hashes."""
    parts = [labels.filter(F.col(label) == v).select("doc_id", label).orderBy(_spread("doc_id"), "doc_id").limit(most) for v in values]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def one_text_each(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of a bounded table of ids with one text of docs(doc_id, text) each: that of the least hash.

    The ids are broadcast, so texts of other documents are not moved; ids without a text are left out.
    """
    found = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    return found.groupBy(*ids.columns).agg(F.min_by("text", F.xxhash64("text")).alias("text"))

"""Reviewers' files: what is laid before them, and their decisions read back into the catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import decisions
from . import runs

REVIEW = "entity_type string, source_text string, canonical_id string, canonical_name string, entity_kind string, review_status string, updated_at string"
DECISION = "entity_type string, source_key string, canonical_id string, canonical_name string, entity_kind string, review_status string, decided_at bigint"


def read_reviews(spark: SparkSession, path: str, kind: str = "json") -> DataFrame:
    """Rows of REVIEW from a list in JSON, lines of JSON, or a sheet as CSV with a header; columns beyond these are left out."""
    if kind == "csv":
        sheet = spark.read.options(header=True, multiLine=True, escape='"').csv(path)
        names = [f.split()[0] for f in REVIEW.split(", ")]
        missing = [c for c in names if c not in sheet.columns]
        if missing:
            raise ValueError(f"the sheet has no column {', '.join(missing)}")
        return sheet.select(*names)
    return spark.read.schema(REVIEW).options(mode="FAILFAST", multiLine=kind == "json").json(path)


def catalogue(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """All decisions up to a version; none before the first import."""
    found = any("catalogue" in c["tables"] for c in runs.CommitLog(spark, root).commits(version))
    return runs.table(spark, root, "catalogue", version) if found else spark.createDataFrame([], DECISION)


def import_reviews(spark: SparkSession, root: str, raw: DataFrame, cut: int, run: str) -> dict:
    """Adds reviewed decisions to the catalogue and commits it; all of a file enters or nothing does.

    Raises if raw is empty or has a row that may not enter, or if what would be in force contradicts itself.  Older decisions
    stay: they were in force in their time.
    """
    new, refused = decisions.reviewed(raw, cut)
    odd = refused.select("reasons").limit(1).collect()
    if odd:
        raise ValueError(f"a row may not enter: {odd[0]['reasons']}")
    if new.isEmpty():
        raise ValueError("nothing was reviewed")
    both = catalogue(spark, root).unionByName(new).distinct()
    clash = decisions.contradictions(both, cut).limit(1).collect()
    if clash:
        raise ValueError(f"{clash[0]['canonical_id']} is {clash[0]['issue']}")
    return runs.publish(spark, root, {"catalogue": both}, cut, run)


def export_review(spark: SparkSession, root: str, pending: DataFrame, quarantined: DataFrame, cut: int, run: str) -> dict:
    """Pending and quarantined cases and the catalogue as it stands, committed together under one version."""
    return runs.publish(spark, root, {"pending": pending, "quarantined": quarantined, "catalogue": catalogue(spark, root)}, cut, run)

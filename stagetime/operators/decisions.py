"""Catalogue decisions in force at a time: aliases of names, what was decided about them and until when, and what is pending."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import SEPARATORS
from ..functions.columns import clean_text, folded, source_key, uuid5, zoned_micros

NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "stagetime:catalogue")
PERSON = "person"
_ALIAS = ["entity_type", "source_key"]


def validity(decisions: DataFrame) -> DataFrame:
    """decisions(entity_type, source_key, canonical_id, canonical_name, entity_kind, review_status, decided_at) with valid_from and valid_to.

    A decision is in force until the next one on its alias; valid_to is null for the last.  Of several of one
    instant the one with the greatest hash is the last, and the others never were in force.
    """
    order = Window.partitionBy(*_ALIAS).orderBy("decided_at", F.xxhash64("canonical_id", "canonical_name", "entity_kind", "review_status"))
    rows = decisions.withColumn("valid_from", F.col("decided_at")).withColumn("valid_to", F.lead("decided_at").over(order))
    return rows.filter(F.col("valid_to").isNull() | (F.col("valid_to") > F.col("valid_from")))


def reviewed(raw: DataFrame, now: int, statuses: tuple[str, ...] = ("approved", "quarantined")) -> tuple[DataFrame, DataFrame]:
    """(decisions, refused) of raw(entity_type, source_text, canonical_id, canonical_name, entity_kind, review_status, updated_at), all text.

    A row is refused, with its reasons, if it has no alias, wasn't reviewed, or was decided at no instant with a zone or after
    now.  A decision that stands several times counts once.
    """
    at, key = zoned_micros(F.col("updated_at")), source_key(F.col("source_text"))
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    why = {"no_alias": blank(F.col("entity_type")) | blank(key), "not_reviewed": ~F.coalesce(F.col("review_status").isin(*statuses), F.lit(False)), "no_instant": at.isNull(), "after_now": at > now}
    rows = raw.withColumn("source_key", key).withColumn("decided_at", at).withColumn("reasons", F.array_join(F.array_compact(F.array(*[F.when(c, F.lit(r)) for r, c in why.items()])), ","))
    kept = rows.filter("reasons = ''").select("entity_type", "source_key", "canonical_id", "canonical_name", "entity_kind", "review_status", "decided_at").distinct()
    return kept, rows.filter("reasons <> ''").select(*raw.columns, "reasons")


def in_force(decisions: DataFrame, cut: int) -> DataFrame:
    """The decision on each alias as of a cut, and since when it stands."""
    return validity(decisions.filter(F.col("decided_at") <= cut)).filter("valid_to is null").drop("valid_to", "decided_at")


def contradictions(decisions: DataFrame, cut: int) -> DataFrame:
    """entity_type, canonical_id, issue: approvals without an identity, a name or a kind, and identities of several names or kinds."""
    approved = in_force(decisions, cut).filter("review_status = 'approved'")
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    bare = approved.filter(blank("canonical_id") | blank("canonical_name") | blank("entity_kind") | (F.col("entity_kind") == "unknown"))
    several = approved.filter(~blank("canonical_id")).groupBy("entity_type", "canonical_id").agg(F.count_distinct(F.struct("canonical_name", "entity_kind")).alias("n")).filter("n > 1")
    return bare.select("entity_type", "canonical_id", F.lit("incomplete").alias("issue")).distinct().unionByName(several.select("entity_type", "canonical_id", F.lit("conflicting").alias("issue")))


def _own_id() -> Column:
    """The id of a name that no decision stands for: by its type and key."""
    return uuid5(NAMESPACE, F.concat_ws(":", "entity_type", "source_key"))


def resolve(values: DataFrame, decisions: DataFrame, cut: int, people: tuple[str, ...] = ("talent",)) -> DataFrame:
    """values(entity_type, text, exclusive, ...) with source_key, decided_kind, identity_id, identity_name and situation as of a cut.

    situation: missing (blank text), quarantined, not_individual (an approved alias of a type of people that
    stands for no person), approved, pending_review (a person that only a free text names and nobody has reviewed),
    exclusive_register or normalised_text (the name stands for itself).
    """
    known = in_force(decisions, cut).select(*[F.col(c).alias(f"_{c}") for c in _ALIAS], F.struct("canonical_id", "canonical_name", "entity_kind", "review_status").alias("_d"))
    rows = values.withColumn("source_key", source_key(F.col("text")))
    rows = rows.join(known, (F.col("entity_type") == F.col("_entity_type")) & (F.col("source_key") == F.col("_source_key")), "left")
    person, status = F.col("entity_type").isin(*people), F.col("_d.review_status")
    situation = F.when(F.col("source_key").isNull(), "missing").when(status == "quarantined", "quarantined")
    situation = situation.when((status == "approved") & person & ~F.col("_d.entity_kind").eqNullSafe(F.lit(PERSON)), "not_individual").when(status == "approved", "approved")
    situation = situation.when(person & ~F.coalesce("exclusive", F.lit(False)), "pending_review").when(F.coalesce("exclusive", F.lit(False)), "exclusive_register").otherwise("normalised_text")
    rows = rows.withColumn("situation", situation).withColumn("decided_kind", F.when(status == "approved", F.col("_d.entity_kind")))
    itself = F.col("situation").isin("exclusive_register", "normalised_text")
    identity = F.when(F.col("situation") == "approved", F.col("_d.canonical_id")).when(itself, _own_id())
    name = F.when(F.col("situation") == "approved", F.col("_d.canonical_name")).when(itself, clean_text(F.col("text")))
    return rows.withColumn("identity_id", identity).withColumn("identity_name", name).drop("_entity_type", "_source_key", "_d")


def pending(values: DataFrame, decisions: DataFrame, at: int) -> DataFrame:
    """One row for each alias of values(entity_type, text) that nobody has decided on up to an instant, as it would be laid before a reviewer."""
    keyed = values.select("entity_type", source_key(F.col("text")).alias("source_key"), clean_text(F.col("text")).alias("source_text")).filter("source_key is not null")
    asked = keyed.groupBy(*_ALIAS).agg(F.min("source_text").alias("source_text"), F.count("*").alias("uses"))
    left = asked.join(decisions.filter(F.col("decided_at") <= at).select(*_ALIAS).distinct(), _ALIAS, "left_anti")
    return left.select(*_ALIAS, "source_text", "uses", F.lit("unknown").alias("entity_kind"), F.lit("pending").alias("review_status"), F.lit(at).alias("updated_at"))


def talent_decisions(snapshots: DataFrame, decisions: DataFrame, cut: int, collectives: tuple[str, ...] = ("group", "various"), squad: str = "squad") -> DataFrame:
    """item, reasons, origin, identity_id, identity_name, situation of snapshots(item, talent, other, talent_ids) as of a cut.

    reasons: both_columns (unlike names in both), several (more than one id in the structured cell, or a text of several
    names that isn't approved as one person), squad, and not_individual (a collective, or an alias approved as
    something else than a person).  origin is the column that the identity comes from.
    """
    texts = F.array(F.struct(F.col("talent").alias("text"), F.lit(True).alias("exclusive"), F.lit(0).alias("place")), F.struct(F.col("other").alias("text"), F.lit(False).alias("exclusive"), F.lit(1).alias("place")))
    each = snapshots.select("item", F.explode(texts).alias("x"), F.lit("talent").alias("entity_type")).select("item", "entity_type", "x.*")
    found = resolve(each, decisions, cut)
    approved_person = F.coalesce(F.col("decided_kind") == PERSON, F.lit(False))
    there = F.col("source_key").isNotNull()
    flags = found.groupBy("item").agg(
        F.bool_or(there & F.regexp_like(folded(F.col("text")), F.lit(rf"\b{squad}\b"))).alias("squad"),
        F.bool_or(there & (folded(F.col("text")).isin(*collectives) | F.coalesce(F.col("decided_kind") != PERSON, F.lit(False)))).alias("not_individual"),
        F.bool_or(there & ~approved_person & F.regexp_like("text", F.lit(SEPARATORS))).alias("several"),
        F.count_distinct(F.when(there, folded(F.col("text")))).alias("names"),
        F.min_by(F.struct("place", "identity_id", "identity_name", "situation"), F.when(there, F.col("place")).otherwise(F.col("place") + 2)).alias("first"),
    )
    rows = flags.join(snapshots.select("item", F.size(F.array_distinct(F.coalesce("talent_ids", F.array().cast("array<string>")))).alias("ids")), "item")
    tests = {"both_columns": F.col("names") > 1, "several": F.col("several") | (F.col("ids") > 1), "squad": F.col("squad"), "not_individual": F.col("not_individual")}
    reasons = F.array_join(F.array_compact(F.array(*[F.when(F.coalesce(t, F.lit(False)), F.lit(n)) for n, t in tests.items()])), ",")
    origin = F.when(F.col("first.situation") == "missing", F.lit(None)).when(F.col("first.place") == 0, "talent").otherwise("other")
    return rows.select("item", reasons.alias("reasons"), origin.alias("origin"), "first.identity_id", "first.identity_name", "first.situation")


def register_projection(cases: DataFrame, register: DataFrame, board: int, version: str, attributes: list[str]) -> tuple[DataFrame, DataFrame]:
    """(cases with the register's attributes, cases whose register row isn't theirs).

    cases(case_id, item, ...) meet register(item, board_id, contract, captured_at, attributes): a case without a
    row gets nulls; one whose row is of another board or contract, or without an instant, is told and gets nulls too.
    """
    sound = (F.col("board_id") == board) & (F.col("contract") == version) & F.col("captured_at").isNotNull()
    rows = cases.join(register.withColumn("_sound", F.coalesce(sound, F.lit(False))), "item", "left")
    shown = [F.when(F.col("_sound"), F.col(c)).alias(f"current_{c}") for c in [*attributes, "captured_at"]]
    issue = F.when(F.col("board_id") != board, "other_board").when(F.col("contract") != version, "other_contract").otherwise("no_instant")
    return rows.select(*cases.columns, *shown), rows.filter("not _sound").select("case_id", "item", issue.alias("issue"))

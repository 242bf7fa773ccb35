"""Proofs over whole tables: a stored table against its derivation, and what a change has left as it was.

Tables are compared by sums of hashes that are made before the shuffle, one row for each key and task, so no
row meets another one and a key with many rows costs no more than one with few.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import row_hash

_SUM = "decimal(38,0)"
_LOW = (1 << 32) - 1


def _hash(column: str) -> Column:
    """A hash of one value; null hashes like no value does, and -0.0 and NaN like their equals."""
    return F.xxhash64(F.lit(column), F.to_json(F.struct(F.col(column)), {"ignoreNullFields": "false"}))


def compared(stored: DataFrame, derived: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """key, kind, fields: where a stored table differs from its derivation, as multisets of rows.

    kind is missing (only derived), extra (only stored), repeated or lacking (more or fewer stored rows than
    derived ones) or changed; fields names the columns that differ, for keys with as many rows on both sides,
    each compared null-safely over all of the key's rows.  Null keys are keys like any other.

    A field takes two longs: the stored hashes less the derived ones, summed by their upper and lower 32 bits, which
    is exact for up to 2**31 rows of a key.  Rows go to as many tasks as spark.sql.shuffle.partitions says before they
    are counted, so that no task that derives them holds their keys, and none is merged with others.
    """
    sides = []
    for df, side in ((stored, 1), (derived, -1)):
        sides.append(df.select(*key, F.lit(side).alias("_s"), *[_hash(f).alias(f"_h{k}") for k, f in enumerate(fields)]))
    tasks = int(stored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = sides[0].unionByName(sides[1]).repartition(tasks, *key)
    upper, lower = (lambda k: F.shiftright(F.col(f"_h{k}"), 32)), (lambda k: F.col(f"_h{k}").bitwiseAND(F.lit(_LOW)))
    sums = [F.sum(F.col("_s") * part(k)).alias(f"_{c}{k}") for k in range(len(fields)) for c, part in (("u", upper), ("l", lower))]
    got = both.groupBy(*key).agg(F.count_if(F.col("_s") == 1).alias("_n"), F.count_if(F.col("_s") == -1).alias("_m"), *sums)
    same = lambda k: (F.col(f"_l{k}").bitwiseAND(F.lit(_LOW)) == 0) & (F.col(f"_u{k}") == -F.shiftright(F.col(f"_l{k}"), 32))
    differs = F.array_compact(F.array(*[F.when(~same(k), F.lit(f)) for k, f in enumerate(fields)]))
    n, m = F.col("_n"), F.col("_m")
    kind = F.when(n == 0, "missing").when(m == 0, "extra").when(n > m, "repeated").when(n < m, "lacking").when(F.size(differs) > 0, "changed")
    rows = got.withColumn("kind", kind).filter("kind is not null")
    return rows.select(*key, "kind", F.array_join(F.when(F.col("kind") == "changed", differs).otherwise(F.array().cast("array<string>")), ",").alias("fields"))


def verdict(found: DataFrame, contract: str) -> DataFrame:
    """contract, kind, fields, n: how many keys of compared(...) differ in which way."""
    return found.groupBy("kind", "fields").agg(F.count("*").alias("n")).select(F.lit(contract).alias("contract"), "kind", "fields", "n")


def group_prints(df: DataFrame, group: list[str], fields: list[str]) -> DataFrame:
    """group, n_rows, digest: a fingerprint of each group's rows over fields, whatever their order.

    Sums of these are the fingerprint of the table, so a table's is made of its groups' without reading rows again.
    """
    return df.groupBy(*group).agg(F.count("*").alias("n_rows"), F.sum(row_hash(fields).cast(_SUM)).alias("digest"))


def combined(prints: DataFrame) -> DataFrame:
    """One row: the fingerprint of all groups together."""
    return prints.agg(F.coalesce(F.sum("n_rows"), F.lit(0).cast("long")).alias("n_rows"), F.coalesce(F.sum("digest"), F.lit(0).cast(_SUM)).cast(_SUM).alias("digest"))


def _held_against(before: DataFrame, after: DataFrame, group: list[str], fields: list[str]) -> DataFrame:
    """group with the fingerprints of both tables, null where one has no such group."""
    a = group_prints(before, group, fields).select(*[F.col(g).alias(f"_{g}") for g in group], F.struct("n_rows", "digest").alias("_a"))
    b = group_prints(after, group, fields).select(*group, F.struct("n_rows", "digest").alias("_b"))
    both = a.join(b, reduce(lambda x, y: x & y, [F.col(f"_{g}").eqNullSafe(F.col(g)) for g in group]), "full_outer")
    return both.select(*[F.coalesce(g, f"_{g}").alias(g) for g in group], "_a", "_b")


def recut(before: DataFrame, after: DataFrame, kept: DataFrame, group: str, fields: list[str]) -> DataFrame:
    """group, state: whether a cut of whole groups has kept exactly the groups of kept(group), row for row.

    state is kept, changed (its rows differ), lost (it should be there), left_out, still_there (it should
    not be) or unheard_of (it wasn't there before).
    """
    rows = _held_against(before, after, [group], fields).join(kept.select(group).distinct().withColumn("_k", F.lit(True)), group, "left")
    stays = F.coalesce("_k", F.lit(False))
    state = F.when(F.col("_a").isNull(), "unheard_of").when(stays & F.col("_b").isNull(), "lost").when(stays & (F.col("_a") == F.col("_b")), "kept").when(stays, "changed")
    return rows.select(group, state.when(F.col("_b").isNull(), "left_out").otherwise("still_there").alias("state"))


def upgrade(before: DataFrame, after: DataFrame, group: list[str], added: list[str]) -> DataFrame:
    """check, n: an upgrade that only adds columns has changed no group in its old ones.

    columns: how many columns were lost, or came without being declared in added; and the groups that were
    lost, are new, or differ in some old column.
    """
    old = [c for c in before.columns if c in after.columns]
    odd = len([c for c in before.columns if c not in after.columns]) + len([c for c in after.columns if c not in before.columns and c not in added]) + len([c for c in added if c not in after.columns])
    rows = _held_against(before, after, group, old)
    tests = {"groups lost": F.col("_b").isNull(), "groups new": F.col("_a").isNull(), "groups changed": F.col("_a").isNotNull() & F.col("_b").isNotNull() & (F.col("_a") != F.col("_b"))}
    row = rows.agg(*[F.count_if(t).alias(c) for c, t in tests.items()])
    checks = [F.struct(F.lit("columns").alias("check"), F.lit(odd).cast("long").alias("n")), *[F.struct(F.lit(c).alias("check"), F.col(c).alias("n")) for c in tests]]
    return row.select(F.explode(F.array(*checks)).alias("x")).select("x.*")


def published_split(source: DataFrame, published: DataFrame, excluded: DataFrame, group: str, fields: list[str]) -> DataFrame:
    """group, state: every group of source stands whole in exactly one of published and excluded.

    state is published or excluded, where the fingerprint is that of the source; both, neither, changed or
    unheard_of otherwise.  Fingerprints of groups are compared, never rows.
    """
    parts = [group_prints(df, [group], fields).select(group, F.lit(s).alias("_s"), F.struct("n_rows", "digest").alias("_p")) for s, df in (("source", source), ("published", published), ("excluded", excluded))]
    rows = reduce(DataFrame.unionByName, parts).groupBy(group).agg(*[F.max(F.when(F.col("_s") == s, F.col("_p"))).alias(f"_{s}") for s in ("source", "published", "excluded")])
    there = F.coalesce("_published", "_excluded")
    state = F.when(F.col("_source").isNull(), "unheard_of").when(F.col("_published").isNotNull() & F.col("_excluded").isNotNull(), "both").when(there.isNull(), "neither").when(there != F.col("_source"), "changed")
    return rows.select(group, state.when(F.col("_published").isNotNull(), "published").otherwise("excluded").alias("state"))


def only_allowed(before: DataFrame, after: DataFrame, key: list[str], allowed: list[str]) -> DataFrame:
    """kind, fields, n of what differs between two versions besides the columns that may: none if the rebuild kept to them."""
    fields = [c for c in before.columns if c not in key and c not in allowed]
    return compared(after, before, key, fields).groupBy("kind", "fields").agg(F.count("*").alias("n"))


def patched(base: DataFrame, patch: DataFrame, approved: DataFrame, key: list[str]) -> DataFrame:
    """base with the rows of approved keys replaced by those of patch; what patch has beyond them counts for nothing.

    An approved key without a row in patch keeps its own rows, so nothing is lost; one without a row in base is added.
    """
    good = patch.join(approved.select(*key).distinct(), key, "left_semi")
    return base.join(good.select(*key).distinct(), key, "left_anti").unionByName(good.select(*base.columns))

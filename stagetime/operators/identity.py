"""Identity across sources: candidate pairs, one-to-one selection, probable spellings of one name."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def candidate_pairs(old: DataFrame, new: DataFrame, seeds: dict[str, list[str]], most: int = 100) -> DataFrame:
    """old_id, new_id, seeds: pairs that agree in all columns of one seed at least.

    A value that would give over most pairs says nothing about identity and is left out; the counts are
    taken before the join, so a generic value never multiplies.
    """
    out = None
    for name, columns in seeds.items():
        known = F.lit(True)
        for c in columns:
            known = known & F.col(c).isNotNull()
        a, b = old.filter(known), new.filter(known)
        few = a.groupBy(*columns).agg(F.count("*").alias("_a")).join(b.groupBy(*columns).agg(F.count("*").alias("_b")), columns).filter(F.col("_a") * F.col("_b") <= most).select(*columns)
        pairs = a.join(few, columns, "left_semi").select(F.col("id").alias("old_id"), *columns).join(b.join(few, columns, "left_semi").select(F.col("id").alias("new_id"), *columns), columns)
        pairs = pairs.select("old_id", "new_id", F.lit(name).alias("seed"))
        out = pairs if out is None else out.unionByName(pairs)
    return out.groupBy("old_id", "new_id").agg(F.array_join(F.array_sort(F.collect_set("seed")), "+").alias("seeds"))


def select_pairs(pairs: DataFrame, wanted: Column) -> DataFrame:
    """Pairs that meet a condition and whose either end is in no other such pair."""
    good = pairs.filter(wanted)
    counted = good.withColumn("_o", F.count("*").over(Window.partitionBy("old_id"))).withColumn("_n", F.count("*").over(Window.partitionBy("new_id")))
    return counted.filter("_o = 1 and _n = 1").drop("_o", "_n")


def _ratios(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([difflib.SequenceMatcher(None, x, y, autojunk=False).ratio() for x, y in zip(a, b, strict=True)])


def similarity_ratio(a: str, b: str) -> Column:
    """Twice the length of the matching blocks over the lengths of both, in Arrow batches."""
    return F.pandas_udf(_ratios, "double")(a, b)


def probable_spellings(names: DataFrame, least: float = 0.9) -> DataFrame:
    """name, of, rule of names(name, uses): the most used of the more used names that each may be a spelling of.

    Rule prefix: a name's words are the first words of the other.  Rule ratio: both have five characters at
    least and the ratio of matching blocks reaches least.  With a and b characters, u = (1 - least) * (a + b)
    at most are unmatched, and at most 2 * u of a name's letter pairs don't stand in the other; so in an order
    common to all, rarest first, the names share one of their first 2 * u + 1 pairs.
    """
    words = F.split("name", " ")
    shorter = F.transform(F.sequence(F.lit(1), F.size(words) - 1), lambda n: F.array_join(F.slice(words, 1, n), " "))
    longer = names.filter(F.size(words) > 1).select(F.col("name").alias("of"), F.col("uses").alias("of_uses"), F.explode(shorter).alias("name"))
    by_prefix = names.join(longer, "name").select("name", "uses", "of", "of_uses", F.lit("prefix").alias("rule"))
    long = names.filter(F.length("name") >= 5)
    pairs = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("name") - 1), lambda i: F.substring(F.col("name"), i, F.lit(2))))
    held = long.select("name", "uses", F.explode(pairs).alias("pair"))
    common = held.groupBy("pair").agg(F.count("*").alias("f"))
    ranked = held.join(common, "pair").groupBy("name", "uses").agg(F.array_sort(F.collect_list(F.struct("f", "pair"))).alias("r"))
    most = F.floor(F.lit(2 * (1 - least) * (1 + (2 - least) / least)) * F.length("name") + 1e-9).cast("int")
    firsts = ranked.select("name", "uses", F.explode(F.slice("r", 1, most + 1)).alias("x")).select("name", "uses", "x.pair")
    a, b = firsts.alias("a"), firsts.alias("b")
    low, high = F.least(F.length("a.name"), F.length("b.name")), F.greatest(F.length("a.name"), F.length("b.name"))
    met = a.join(b, (F.col("a.pair") == F.col("b.pair")) & _more_used(F.col("a.uses"), F.col("a.name"), F.col("b.uses"), F.col("b.name")) & (2 * low >= least * (low + high)))
    met = met.select(F.col("a.name").alias("name"), F.col("a.uses").alias("uses"), F.col("b.name").alias("of"), F.col("b.uses").alias("of_uses")).distinct()
    by_ratio = met.filter(similarity_ratio("name", "of") >= least).withColumn("rule", F.lit("ratio"))
    found = by_prefix.filter(_more_used(F.col("uses"), F.col("name"), F.col("of_uses"), F.col("of"))).unionByName(by_ratio)
    return found.groupBy("name").agg(F.max(F.struct("of_uses", "of", F.col("rule").alias("rule"))).alias("x")).select("name", "x.of", "x.rule")


def _more_used(uses: Column, name: Column, other_uses: Column, other: Column) -> Column:
    return (other_uses > uses) | ((other_uses == uses) & (other > name))

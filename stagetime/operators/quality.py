"""Contracts, references, differences and reconciliation, as DataFrames of violations and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def violations(df: DataFrame, key: list[str], rules: dict[str, Column]) -> DataFrame:
    """rule and number of rows that break it, plus rows whose key is null or repeated; one pass each."""
    null_key = F.lit(False)
    for k in key:
        null_key = null_key | F.col(k).isNull()
    flags = {**rules, "null key": null_key}
    row = df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(f"_{i}") for i, c in enumerate(flags.values())])
    named = row.select(F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"_{i}").alias("n")) for i, n in enumerate(flags)])).alias("x")).select("x.*")
    repeated = df.groupBy(*key).count().filter("count > 1").agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n")).select(F.lit("repeated key").alias("rule"), "n")
    return named.unionByName(repeated)


def orphans(child: DataFrame, parent: DataFrame, on: dict[str, str]) -> DataFrame:
    """Rows of child whose reference is set and leads nowhere."""
    keys = parent.select(*[F.col(p).alias(f"_{c}") for c, p in on.items()]).distinct()
    condition = [F.col(c) == F.col(f"_{c}") for c in on]
    return child.dropna(subset=list(on)).join(keys, condition, "left_anti")


def profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """For each column: nulls, blanks and distinct values."""
    aggs = []
    for c in columns:
        aggs += [F.count_if(F.col(c).isNull()).alias(f"{c}.nulls"), F.count_if(F.trim(F.col(c).cast("string")) == "").alias(f"{c}.blanks"), F.count_distinct(c).alias(f"{c}.distinct")]
    row = df.agg(*aggs)
    return row.select(F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(f"`{c}.nulls`").alias("nulls"), F.col(f"`{c}.blanks`").alias("blanks"), F.col(f"`{c}.distinct`").alias("n_distinct")) for c in columns])).alias("x")).select("x.*")


def upsert(base: DataFrame, news: DataFrame, key: list[str], first_seen: str | None = None, order: tuple[str, ...] = ()) -> DataFrame:
    """Rows by key, the new ones before the old; first_seen keeps the least value of either.

    Of several new rows of one key the last by the columns of order stays, and of those that tie in them
    the one of the greatest hash, so that a run gives the same table again.
    """
    both = base.withColumn("_p", F.lit(0)).unionByName(news.withColumn("_p", F.lit(1)))
    w = Window.partitionBy(*key)
    if first_seen:
        both = both.withColumn(first_seen, F.min(first_seen).over(w))
    last = [F.desc("_p"), *[F.desc_nulls_last(c) for c in order], F.desc(F.xxhash64(*news.columns))]
    return both.withColumn("_r", F.row_number().over(w.orderBy(*last))).filter("_r = 1").drop("_r", "_p")


def differences(before: DataFrame, after: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """By kind (added, removed or the field that changed): how many keys."""
    a = before.select(*[F.col(k).alias(f"_{k}") for k in key], F.struct(*fields).alias("_a"))
    b = after.select(*key, F.struct(*fields).alias("_b"))
    both = a.join(b, [F.col(f"_{k}").eqNullSafe(F.col(k)) for k in key], "full_outer")
    changed = F.array_compact(F.array(*[F.when(~F.col(f"_a.{f}").eqNullSafe(F.col(f"_b.{f}")), F.lit(f)) for f in fields]))
    kind = F.when(F.col("_a").isNull(), F.array(F.lit("added"))).when(F.col("_b").isNull(), F.array(F.lit("removed"))).otherwise(changed)
    return both.select(F.explode(kind).alias("kind")).groupBy("kind").agg(F.count("*").alias("n"))


def batch_audit(batches: DataFrame, singles: DataFrame) -> DataFrame:
    """How the items of batch events (action, item, value) agree with their own events of the action."""
    own = singles.groupBy("action", "item").agg(F.collect_set("value").alias("values"))
    rows = batches.join(own, ["action", "item"], "left")
    state = F.when(F.col("values").isNull(), "missing").when(F.size("values") > 1, "conflict").when(F.array_contains("values", F.col("value")), "agrees").otherwise("differs")
    return rows.groupBy(state.alias("state")).agg(F.count("*").alias("n"))


def errors(rows: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """error_id, key, rule: one row for each rule that a key breaks, however many of its rows do."""
    broken = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()]))
    found = rows.select(key, F.explode(broken).alias("rule")).distinct()
    return found.select(F.sha2(F.concat_ws("|", F.coalesce(F.col(key).cast("string"), F.lit("None")), "rule"), 256).alias("error_id"), key, "rule")


def fill_quality(started: DataFrame, found: DataFrame, by: list[str]) -> DataFrame:
    """by, started, errors, rules: what was started against what is wrong, with a JSON map rule -> count.

    Groups that only one side has are kept.  The map has as many entries as there are rules.
    """
    a = started.groupBy(*by).agg(F.count("*").alias("started"))
    each = found.groupBy(*by, "rule").agg(F.count("*").alias("n"))
    b = each.groupBy(*by).agg(F.sum("n").alias("errors"), F.array_sort(F.collect_list(F.struct("rule", "n"))).alias("_r"))
    both = a.join(b, by, "full_outer")
    rules = F.to_json(F.map_from_entries(F.coalesce("_r", F.array().cast("array<struct<rule:string,n:bigint>>"))))
    return both.select(*by, F.coalesce("started", F.lit(0)).alias("started"), F.coalesce("errors", F.lit(0)).alias("errors"), rules.alias("rules"))

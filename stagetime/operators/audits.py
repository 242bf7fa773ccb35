"""Checks, comparisons and reports over whole tables, each as one small DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import entity_key
from .identity import probable_spellings
from .intervals import in_order, split_days
from .rules import cell_state, whole_case_filter


def stacked(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _counted(rows: DataFrame, **tests: Column) -> list[DataFrame]:
    """check, n: how many rows fail each test, in one pass."""
    row = rows.agg(*[F.count_if(F.coalesce(t, F.lit(False))).alias(name) for name, t in tests.items()])
    return [row.select(F.explode(F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).alias("n")) for n in tests])).alias("x")).select("x.*")]


def stay_checks(intervals: DataFrame, zone: str) -> DataFrame:
    """check, n of build_intervals(...): sequence, continuity, open stays, spans, and days that add up."""
    rows = intervals.withColumn("_next", F.lead("started").over(in_order()))
    cases = rows.groupBy("case_id").agg(
        F.count("*").alias("n"), F.max("position").alias("top"), F.count_if(F.col("ended").isNull()).alias("open"), F.sum(F.col("seen_until") - F.col("started")).alias("spent"),
        (F.max("seen_until") - F.min("started")).alias("span"), F.count_if(~F.col("ended").eqNullSafe(F.col("_next"))).alias("breaks"), F.count_if(F.col("ended") < F.col("started")).alias("negative"),
    )
    days = split_days(intervals, zone).groupBy("case_id").agg(F.sum("spent").alias("by_day"))
    both = cases.join(days, "case_id", "left").withColumn("by_day", F.coalesce("by_day", F.lit(0).cast("long")))
    tests = {"sequence": F.col("top") != F.col("n"), "continuity": F.col("breaks") > 0, "several open": F.col("open") > 1, "negative": F.col("negative") > 0, "span": F.col("spent") != F.col("span"), "days": F.col("by_day") != F.col("spent")}
    return stacked(_counted(both, **tests))


def cycle_checks(stays: DataFrame, cycles: DataFrame) -> DataFrame:
    """check, n: cycle_table(...) recomputed from its stays, gaps in the numbers, and endings before starts."""
    again = stays.filter("cycle is not null").groupBy("case_id", "cycle").agg(F.count("*").alias("_stays"), F.min("started").alias("_started"))
    both = cycles.join(again, ["case_id", "cycle"], "full_outer")
    numbers = cycles.groupBy("case_id").agg(F.count("*").alias("n"), F.max("cycle").alias("top"))
    return stacked(_counted(both, totals=~(F.col("stays").eqNullSafe(F.col("_stays")) & F.col("started").eqNullSafe(F.col("_started"))), order=F.col("closed") < F.col("started")) + _counted(numbers, numbers=F.col("n") != F.col("top")))


def increments(stored: DataFrame, source: DataFrame, overlap: int, key: str, fields: list[str]) -> DataFrame:
    """state, n of what a read from the watermark brings: new, changed or same against stored(key, at, fields).

    The watermark is the last stored instant; the read goes overlap microseconds before it.
    """
    mark = stored.agg(F.max("at").alias("_mark"))
    read = source.crossJoin(F.broadcast(mark)).filter(F.col("_mark").isNull() | (F.col("at") >= F.col("_mark") - overlap))  # one row
    was = stored.select(F.col(key).alias("_key"), F.struct(*fields).alias("_was"))
    both = read.join(was, F.col(key) == F.col("_key"), "left")
    state = F.when(F.col("_was").isNull(), "new").when(F.col("_was").eqNullSafe(F.struct(*fields)), "same").otherwise("changed")
    return both.groupBy(state.alias("state")).agg(F.count("*").alias("n"))


def beyond(events: DataFrame, cut: int) -> tuple[DataFrame, DataFrame]:
    """Events before the cut, and those at or after it, which no run may take in silently."""
    return events.filter(F.col("at") < cut), events.filter((F.col("at") >= cut) | F.col("at").isNull())


def common_variants(names: DataFrame) -> DataFrame:
    """key, name, uses, variants of names(key, name, place): the most common spelling, of equal ones the first seen."""
    each = names.groupBy("key", "name").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    return each.groupBy("key").agg(F.max_by("name", F.struct("n", (-F.col("first")).alias("f"))).alias("name"), F.sum("n").alias("uses"), F.count("*").alias("variants"))


def matching_fields(old: DataFrame, new: DataFrame, fields: list[str], top: int = 12) -> DataFrame:
    """field, common, one_to_one: how many values both sides have, and how many stand once on either; the best `top`."""
    def values(df: DataFrame, n: str) -> DataFrame:
        entries = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])
        return df.select(F.explode(entries).alias("x")).select("x.*").filter("value is not null").groupBy("field", "value").agg(F.count("*").alias(n))

    both = values(old, "a").join(values(new, "b"), ["field", "value"])
    return both.groupBy("field").agg(F.count("*").alias("common"), F.count_if((F.col("a") == 1) & (F.col("b") == 1)).alias("one_to_one")).orderBy(F.desc("common"), "field").limit(top)


def composite_keys(old: DataFrame, new: DataFrame, name: str, fields: list[str], top: int = 12, least: int = 5) -> DataFrame:
    """fields, unique_pairs, ambiguous, disambiguated: how well the name and one or two more fields tell items apart.

    Only the `top` fields with most values on both sides, and with `least` of them, are put together.  unique_pairs
    are values that stand once on either side, ambiguous the other common ones; disambiguated are unique
    pairs whose name alone stands several times.  Values are counted before they meet, so a common one costs one
    row, and missing parts never match.
    """
    chosen = [r["field"] for r in matching_fields(old, new, fields, top).filter(F.col("common") >= least).select("field").collect()]  # top at most
    combos = [(a, None) for a in chosen] + [(a, b) for i, a in enumerate(chosen) for b in chosen[i + 1 :]]
    tasks = int(old.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def values(df: DataFrame, side: int) -> DataFrame:
        # A small file is one task, whatever its rows give: they are dealt out before each becomes one for every combination.
        text = lambda c: F.nullif(F.col(c).cast("string"), F.lit(""))
        rows = df.select(text(name).alias("name"), *[text(c).alias(f"_v{i}") for i, c in enumerate(chosen)]).filter("name is not null").repartition(tasks)
        place = {c: F.col(f"_v{i}") for i, c in enumerate(chosen)}
        entry = lambda fields, v, w: F.struct(F.lit(fields).alias("fields"), v.cast("string").alias("v"), w.cast("string").alias("w"))
        entries = [F.when(place[a].isNotNull() & place[b or a].isNotNull(), entry("+".join(filter(None, (a, b))), place[a], place[b] if b else F.lit(None))) for a, b in combos]
        rows = rows.select("name", F.explode(F.array(entry("", F.lit(None), F.lit(None)), *entries)).alias("x")).filter("x is not null").select("name", "x.*")
        return rows.groupBy("fields", "name", "v", "w").agg(F.count("*").alias("n")).withColumn("side", F.lit(side))

    mine = lambda side: F.sum(F.when(F.col("side") == side, F.col("n")).otherwise(0))
    both = values(old, 0).unionByName(values(new, 1)).groupBy("fields", "name", "v", "w").agg(mine(0).alias("a"), mine(1).alias("b")).filter("a > 0 and b > 0")
    repeated = both.filter("fields = '' and (a > 1 or b > 1)").select("name", F.lit(1).alias("_r"))
    rows = both.filter("fields <> ''").join(repeated, "name", "left")
    one = (F.col("a") == 1) & (F.col("b") == 1)
    return rows.groupBy("fields").agg(F.count_if(one).alias("unique_pairs"), F.count_if(~one).alias("ambiguous"), F.count_if(one & F.col("_r").isNotNull()).alias("disambiguated"))


def memberships(sets: dict[str, DataFrame], key: list[str]) -> DataFrame:
    """groups, n: how many keys are in exactly which of several sets."""
    every = stacked([df.select(*key, F.lit(name).alias("_s")) for name, df in sets.items()])
    return every.groupBy(*key).agg(F.array_join(F.array_sort(F.collect_set("_s")), "+").alias("groups")).groupBy("groups").agg(F.count("*").alias("n"))


def scope_impact(rows: DataFrame, offends: Column, by: str) -> DataFrame:
    """by, stays and cases before and after whole cases with an offending row are left out."""
    counts = lambda df, when: df.groupBy(by).agg(F.count("*").alias(f"stays_{when}"), F.count_distinct("case_id").alias(f"cases_{when}"))
    both = counts(rows, "before").join(counts(whole_case_filter(rows, offends), "after"), by, "left")
    return both.select(by, "stays_before", "cases_before", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("stays_after", "cases_after")])


def closed_diversity(intervals: DataFrame) -> DataFrame:
    """statuses, cases: how many distinct statuses the closed cases had before they closed."""
    last = F.max_by("role", "position").alias("_last")
    cases = intervals.groupBy("case_id").agg(last, F.count_distinct(F.when(F.col("role") != "terminal", F.col("status"))).alias("statuses")).filter("_last = 'terminal'")
    return cases.groupBy("statuses").agg(F.count("*").alias("cases"))


def freshness(events: DataFrame, by: str, now: int, most: int) -> DataFrame:
    """by, last_at, age, state: fresh while the last event is at most so many microseconds old."""
    got = events.groupBy(by).agg(F.max("at").alias("last_at")).withColumn("age", F.lit(now) - F.col("last_at"))
    return got.withColumn("state", F.when(F.col("age") <= most, "fresh").otherwise("stale"))


def against_group(rows: DataFrame, middle: DataFrame, by: str, value: Column, mark: str) -> DataFrame:
    """rows with a group's quantile beside each and whether the value is above it."""
    joined = rows.join(middle.select(by, mark), by)
    return joined.withColumn("above", value > F.col(mark))


def name_dimension(names: DataFrame, model_items: DataFrame) -> DataFrame:
    """key, name, variants, n_variants, is_exclusive, uses_exclusive, uses_other, items, items_in_model, duplicate_of.

    names(item, name, exclusive, place): name is the most common spelling of the key, of equal ones the first by place;
    variants is a JSON list of them with their counts.  duplicate_of is a more used key that this one is probably
    another spelling of.  Names without a letter or digit have no key and are left out.
    """
    keyed = names.withColumn("key", entity_key(F.col("name"))).filter("key <> ''")
    each = keyed.groupBy("key", "name").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    spelt = each.groupBy("key").agg(F.max_by("name", F.struct("n", (-F.col("first")).alias("f"))).alias("name"), F.to_json(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), "name", "n"))), lambda x: F.struct(x["name"].alias("name"), x["n"].alias("n")))).alias("variants"), F.count("*").alias("n_variants"))
    inside = keyed.join(model_items.select("item").distinct().withColumn("_in", F.lit(1)), "item", "left")
    uses = inside.groupBy("key").agg(F.count_if("exclusive").alias("uses_exclusive"), F.count_if(~F.col("exclusive")).alias("uses_other"), F.count_distinct("item").alias("items"), F.count_distinct(F.when(F.col("_in") == 1, F.col("item"))).alias("items_in_model"))
    alike = probable_spellings(uses.select(F.col("key").alias("name"), F.col("items").alias("uses"))).select(F.col("name").alias("key"), F.col("of").alias("duplicate_of"))
    return spelt.join(uses, "key").join(alike, "key", "left").select("key", "name", "variants", "n_variants", (F.col("uses_exclusive") > 0).alias("is_exclusive"), "uses_exclusive", "uses_other", "items", "items_in_model", "duplicate_of")


def input_audit(cells: DataFrame, by: str, value: str, present: str, denied: str) -> DataFrame:
    """by, state, n, share: cells that are filled, blank, unverified (never returned) or denied, in each group."""
    state = F.when(F.coalesce(F.col(denied), F.lit(False)), "denied").otherwise(cell_state(F.col(present), F.col(value)))
    got = cells.groupBy(by, state.alias("state")).agg(F.count("*").alias("n"))
    return got.withColumn("share", F.round(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy(by)), 6))


def strict_start(intervals: DataFrame, intake: str, by: str) -> DataFrame:
    """by, what, cases, stays: what a start at the intake leaves out, by how a case begins instead.

    what is intake_first, blank_then_intake (null statuses before it), other_then_intake, or never_intake.
    """
    known = F.min(F.when(F.col("status").isNotNull(), F.struct("position", "status")))
    cases = intervals.groupBy("case_id").agg(known.alias("k"), F.min(F.when(F.col("status") == intake, F.col("position"))).alias("i"), F.count("*").alias("stays"), F.min_by(by, "position").alias(by))
    what = F.when(F.col("i").isNull(), "never_intake").when(F.col("i") == 1, "intake_first").when(F.col("k.position") == F.col("i"), "blank_then_intake").otherwise("other_then_intake")
    return cases.groupBy(by, what.alias("what")).agg(F.count("*").alias("cases"), F.sum("stays").alias("stays"))


def review_rows(issues: DataFrame, key: list[str], issue: str, order: list[str], remedies: dict[str, str]) -> DataFrame:
    """review_id, place, key, issue, remedy: one row for each pending issue, under an id that another run gives again.

    place is the order within an issue; an issue without a remedy is unknown to the review.
    """
    rows = issues.select(*key, F.col(issue).alias("issue"), *[c for c in order if c not in key]).distinct()
    text = [F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in (*key, "issue")]
    known = F.create_map(*[F.lit(x) for pair in remedies.items() for x in pair])
    ranked = rows.withColumn("place", F.row_number().over(Window.partitionBy("issue").orderBy(*order, *key)))
    return ranked.select(F.sha2(F.concat_ws("|", *text), 256).alias("review_id"), "place", *key, "issue", F.try_element_at(known, F.col("issue")).alias("remedy"))

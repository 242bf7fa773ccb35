"""Live cycles over two accounts, and the consolidation of both with every exclusion accounted for."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import strict_sum
from .intervals import by_case, in_order

REASONS = ("estimated_transition", "no_continuity", "account_boundary", "unknown_status", "no_duration")
#: What the stay that opens a cycle is excused from: it concerns the wait before.
_AT_OPENING = ("estimated_transition", "no_continuity", "account_boundary")


def live_stays(intervals: DataFrame, intake: str, cut: int) -> DataFrame:
    """Stays of cases that begin with the intake, with provenance of their duration, reasons and cycles.

    Takes case_id, event_id, account, status, role, started, ended.  A stay that another account carries
    on may have no observed end; the next start is then an estimate.  provenance: prefix (before the first
    known status), terminal, observed, estimated, open_age (last stay, up to the cut) or unavailable.
    A delivery or terminal stay closes the cycle; the next work opens one.
    """
    known = F.min(F.when(F.col("role") != "unknown", F.struct("started", "event_id", "status"))).over(by_case())
    rows = intervals.withColumn("_k", known).filter(F.col("_k.status") == intake)
    begun = F.struct("started", "event_id") >= F.struct("_k.started", "_k.event_id")
    before, after = F.lag(F.struct("status", "account", "role", "ended")).over(in_order()), F.lead(F.struct("account", "role", "started")).over(in_order())
    rows = rows.withColumn("_in", begun).withColumn("_b", F.when(F.lag(begun).over(in_order()), before)).withColumn("_n", after)
    carried = F.col("ended").isNull() & (F.col("_n.account") != F.col("account")) & ~F.col("role").isin("terminal", "unknown") & (F.col("_n.role") != "unknown") & (F.col("_n.started") > F.col("started"))
    carried = F.coalesce(carried & F.col("_in"), F.lit(False))
    rows = rows.withColumn("_carried", carried).withColumn("_from", F.coalesce(F.lag(carried).over(in_order()), F.lit(False)))
    provenance = F.when(~F.col("_in"), "prefix").when(F.col("role") == "terminal", "terminal").when(F.col("ended").isNotNull(), "observed")
    provenance = provenance.when(F.col("_carried"), "estimated").when(F.col("_n").isNull() & (F.col("role") != "unknown"), "open_age").otherwise("unavailable")
    until = F.when(F.col("provenance") == "observed", F.col("ended")).when(F.col("provenance") == "estimated", F.col("_n.started")).when(F.col("provenance") == "open_age", F.lit(cut))
    same = F.coalesce(F.col("_b.status").eqNullSafe(F.col("status")) & F.col("_b").isNotNull(), F.lit(False))
    rows = rows.withColumn("provenance", provenance).withColumn("spent", until - F.col("started")).withColumn("continues", same)
    visits = F.sum((F.col("_in") & ~F.col("continues")).cast("int")).over(Window.partitionBy("case_id", "status").orderBy("started", "event_id"))
    joined = F.coalesce(F.col("_b.ended") == F.col("started"), F.lit(False))
    tests = {
        "estimated_transition": F.col("_b").isNotNull() & ~joined & F.col("_from"),
        "no_continuity": F.col("_b").isNotNull() & ~joined & ~F.col("_from"),
        "account_boundary": F.coalesce(F.col("_b.account") != F.col("account"), F.lit(False)),
        "unknown_status": F.col("_in") & (F.col("role") == "unknown"),
        "no_duration": F.col("_in") & (F.col("role") != "terminal") & F.col("spent").isNull(),
    }
    for name in REASONS:
        rows = rows.withColumn(name, tests[name])
    closing = F.col("role").isin("delivery", "terminal") & F.col("_in")
    rows = rows.withColumn("returns", F.col("_in") & ~F.col("continues") & (visits > 1)).withColumn("_closing", closing)
    rows = rows.withColumn("_segment", F.coalesce(F.sum(closing.cast("int")).over(in_order().rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    part = Window.partitionBy("case_id", "_segment")
    rows = rows.withColumn("_first", F.min(F.when(F.col("_in") & (F.col("role") == "work"), F.struct("started", "event_id"))).over(part))
    place = F.struct("started", "event_id")
    rows = rows.withColumn("opens", F.coalesce(F.col("_first") == place, F.lit(False)))
    number = F.sum(F.col("opens").cast("int")).over(in_order())
    member = F.coalesce(place >= F.col("_first"), F.lit(False))
    kept = ["case_id", "event_id", "account", "status", "role", "started", "ended", "provenance", "spent", "continues", "returns", "opens", *REASONS]
    return rows.withColumn("cycle", F.when(member, number)).select(*kept, "cycle")


def live_cycles(stays: DataFrame) -> DataFrame:
    """Cycles of live_stays(...): state, reasons, completeness, estimates, totals by role and delivery KPI.

    Totals are null where a reason other than a boundary or an estimate speaks against the cycle.
    """
    closing = F.col("role").isin("delivery", "terminal")
    flags = {r: F.col(r) & ~(F.col("opens") if r in _AT_OPENING else closing if r == "no_duration" else F.lit(False)) for r in REASONS}
    inside = lambda c: F.coalesce(F.bool_or(~closing & c), F.lit(False))
    total = lambda role: strict_sum(F.when(F.col("role") == role, F.col("spent")).otherwise(F.lit(0).cast("long")))
    got = stays.filter("cycle is not null").groupBy("case_id", "cycle").agg(
        F.min("started").alias("started"), F.max(F.when(closing, F.col("started"))).alias("closed"), F.max(F.when(closing, F.col("role"))).alias("ending"),
        F.count_if(F.col("role") == "work").alias("work_stays"), *[F.bool_or(c).alias(f"_{r}") for r, c in flags.items()],
        inside(F.col("provenance") == "estimated").alias("has_estimate"), inside(F.col("provenance") == "open_age").alias("has_open_age"), (~inside(F.col("provenance") != "observed")).alias("_observed"),
        total("work").alias("_work"), total("waiting").alias("_waiting"), total("standby").alias("_standby"),
    )
    invalid = F.col("_no_continuity") | F.col("_unknown_status") | F.col("_no_duration")
    complete = ~invalid & F.col("_work").isNotNull()
    state = F.when(F.col("ending") == "delivery", "delivered").when(F.col("ending") == "terminal", "stopped").otherwise("ongoing")
    reasons = F.array_join(F.array_compact(F.array(*[F.when(F.col(f"_{r}"), F.lit(r)) for r in REASONS])), ",")
    return got.select(
        "case_id", "cycle", F.when(F.col("cycle") == 1, "first").otherwise("reopened").alias("kind"), "started", "closed", state.alias("state"), reasons.alias("reasons"), "work_stays",
        complete.alias("complete"), "has_estimate", "has_open_age", F.when(complete, F.col("_work")).alias("worked"), F.when(~invalid, F.col("_waiting")).alias("waited"), F.when(~invalid, F.col("_standby")).alias("paused"),
        (complete & (F.col("ending") == "delivery") & F.col("_observed") & ~F.col("_account_boundary")).alias("observed_delivery"),
    ).withColumn("observed_delivery", F.coalesce("observed_delivery", F.lit(False)))


def consolidate(sources: dict[str, DataFrame], pairs: DataFrame, offends: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(published, excluded) of sources' rows(item, event_id, status, started, ended).

    pairs(project, source, item) says whose timeline an item belongs to.  A row without a pair, or of a
    project that has a row which offends (reason: SQL condition) or two rows of one start, is excluded,
    with all reasons of its project.  An overlap leaves a row in, without a duration.
    """
    rows = None
    for name, df in sources.items():
        one = df.select(F.lit(name).alias("source"), "item", "event_id", "status", "started", "ended")
        rows = one if rows is None else rows.unionByName(one)
    rows = rows.join(pairs.select("project", "source", "item"), ["source", "item"], "left")
    whole = Window.partitionBy("project")
    order = whole.orderBy("started", "source", "event_id")
    paired = rows.filter("project is not null").withColumn("_tie", F.coalesce(F.lag("started").over(order) == F.col("started"), F.lit(False)))
    reasons = [F.when(F.max(F.coalesce(F.expr(c), F.lit(False))).over(whole), F.lit(r)) for r, c in offends.items()]
    reasons.append(F.when(F.max("_tie").over(whole), F.lit("ambiguous_order")))
    paired = paired.withColumn("reasons", F.array_join(F.array_compact(F.array(*reasons)), ",")).drop("_tie")
    alone = rows.filter("project is null").withColumn("reasons", F.lit("no_pair"))
    good = paired.filter("reasons = ''").drop("reasons").withColumn("position", F.row_number().over(order))
    overlap = F.coalesce(F.lead("started").over(order) < F.col("ended"), F.lit(False))
    good = good.withColumn("overlaps", overlap).withColumn("spent", F.when(~F.col("overlaps"), F.col("ended") - F.col("started")))
    return good, paired.filter("reasons <> ''").unionByName(alone)


def accounting(sources: dict[str, DataFrame], published: DataFrame, excluded: DataFrame) -> DataFrame:
    """source, rows, published, excluded, adds_up: every source row is in exactly one place."""
    parts = [df.select(F.lit(s).alias("source"), F.lit(1).alias("rows"), F.lit(0).alias("published"), F.lit(0).alias("excluded")) for s, df in sources.items()]
    parts.append(published.select("source", F.lit(0).alias("rows"), F.lit(1).alias("published"), F.lit(0).alias("excluded")))
    parts.append(excluded.select("source", F.lit(0).alias("rows"), F.lit(0).alias("published"), F.lit(1).alias("excluded")))
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    got = both.groupBy("source").agg(*[F.sum(c).alias(c) for c in ("rows", "published", "excluded")])
    return got.withColumn("adds_up", F.col("rows") == F.col("published") + F.col("excluded"))

"""Whole cases and stays for consumption: destinations, quality states, errors, duplicates, KPI classes, issues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import HOUR, folded
from .intervals import by_case, in_order
from .quantiles import running_total


def _named(tests: dict[str, Column]) -> Column:
    """The names of the tests that hold, in their order; an unknown test doesn't hold."""
    return F.array_compact(F.array(*[F.when(t, F.lit(name)) for name, t in tests.items()]))


def destinations(intervals: DataFrame, register: DataFrame, intake: str, cut: int) -> DataFrame:
    """case_id, stays, destination, reasons, waited: each whole case goes to one of measured, queue and quality.

    A case with a reason against it goes to quality: its first known status isn't the intake, or from there
    on a status is unknown, stays don't join, or another account carries on.  A case that is still in its
    first intake waits in the queue if register(case_id, current_status) says so too.
    """
    first = F.min(F.when(F.col("status").isNotNull(), F.struct("position", "status"))).over(by_case())
    rows = intervals.withColumn("_k", first).withColumn("_p", F.lag(F.struct("ended", "account")).over(in_order()))
    inside, after = F.col("position") >= F.col("_k.position"), F.col("position") > F.col("_k.position")
    some = lambda c: F.coalesce(F.bool_or(c), F.lit(False))
    cases = rows.groupBy("case_id").agg(
        F.count("*").alias("stays"), F.count_if(inside).alias("_n"), F.max("_k.status").alias("_first"), some(inside & (F.col("role") == "unknown")).alias("_unknown"),
        some(after & ~F.col("_p.ended").eqNullSafe(F.col("started"))).alias("_gap"), some(after & (F.col("_p.account") != F.col("account"))).alias("_moved"),
        some(F.col("ended").isNull()).alias("_open"), F.max("started").alias("_last"),
    ).join(register.select("case_id", "current_status"), "case_id", "left")
    lone = (F.col("_n") == 1) & (F.col("_first") == intake) & ~F.col("_unknown")
    reasons = _named({
        "no_known_status": F.col("_first").isNull(), "first_is_not_intake": F.col("_first") != intake, "unknown_after_start": F.col("_unknown"), "gap_or_overlap": F.col("_gap"), "account_change": F.col("_moved"),
        "intake_ended_without_next": lone & ~F.col("_open"), "register_differs": lone & F.col("_open") & ~F.col("current_status").eqNullSafe(F.lit(intake)),
    })
    cases = cases.withColumn("_r", reasons)
    where = F.when(F.size("_r") > 0, "quality").when(F.col("_n") == 1, "queue").otherwise("measured")
    return cases.select("case_id", "stays", where.alias("destination"), F.array_join("_r", ",").alias("reasons"), F.when(where == "queue", F.lit(cut) - F.col("_last")).alias("waited"))


def kpi_classes(stays: DataFrame, business: Column, measured: tuple[str, ...] = ("work", "waiting"), accounts: tuple[str, ...] = ("A", "B"), tolerated: tuple[str, ...] = ("account_boundary", "estimated_transition")) -> DataFrame:
    """case_id, event_id, class, reasons, measure of live_stays(...): whether a stay counts for its stage.

    Fails closed: every known objection is a reason, and so is any issue of the stay that isn't tolerated.
    measure is the business time of stays without a reason, else null.
    """
    issues = [c for c in ("estimated_transition", "no_continuity", "account_boundary", "unknown_status", "no_duration") if c not in tolerated]
    reasons = _named({
        "no_status": F.col("status").isNull(), "role_is_not_measured": ~F.coalesce(F.col("role").isin(*measured), F.lit(False)), "not_closed": F.col("ended").isNull(),
        "before_start": F.col("provenance") == "prefix", "not_observed": ~F.col("provenance").isin("observed", "prefix"), "unknown_account": ~F.coalesce(F.col("account").isin(*accounts), F.lit(False)),
        "ends_before_it_starts": F.col("ended") < F.col("started"), "duration_differs": F.col("spent") != F.col("ended") - F.col("started"), "no_business_time": F.col("ended").isNotNull() & business.isNull(),
        **{f"issue:{c}": F.col(c) for c in issues},
    })
    rows = stays.withColumn("_r", reasons)
    kind = F.when(F.size("_r") == 0, "approved").when(F.col("role") == "terminal", "closing").when(F.col("ended").isNull(), "no_exit_observed").otherwise("insufficient")
    return rows.select("case_id", "event_id", "status", "account", kind.alias("class"), F.array_join("_r", ",").alias("reasons"), F.when(kind == "approved", business).alias("measure"))


def evidence_reasons(version: str, approved: tuple[str, ...] = ("observed_at_exit", "observed_at_start")) -> Column:
    """Why the evidence of a stay doesn't bear a figure: of its label, the events at both ends, its history and its calendar.

    For rows with account, label_quality, entry_events, exit_events (arrays of ids), history, eligible and calendar.  The
    old account A needs an approved label and an event at either end; the new one its own approval.  Fails closed: what is
    null is no evidence.
    """
    blank = lambda c: F.coalesce(F.size(c) <= 0, F.lit(True)) | F.coalesce(F.exists(c, lambda e: F.coalesce(F.trim(e), F.lit("")) == ""), F.lit(True))
    old = F.coalesce(F.col("account") == "A", F.lit(False))
    return _named({
        "unknown_account": ~F.coalesce(F.col("account").isin("A", "B"), F.lit(False)), "label_without_evidence": old & ~F.coalesce(F.col("label_quality").isin(*approved), F.lit(False)),
        "boundary_event_missing": old & (blank("entry_events") | blank("exit_events")), "history_not_observed": ~F.col("history").eqNullSafe(F.lit("observed")),
        "origin_not_eligible": ~old & ~F.coalesce("eligible", F.lit(False)), "calendar_not_validated": ~F.col("calendar").eqNullSafe(F.lit(version)),
    })


def public_stays(stays: DataFrame) -> DataFrame:
    """live_stays(...) as shown outside: inferred starts and durations are hidden, the case's last stay is marked."""
    last = F.lead("event_id").over(in_order()).isNull()
    seen = F.col("provenance") == "observed"
    return stays.select("case_id", "event_id", "status", F.when(F.col("provenance") != "prefix", F.col("started")).alias("started"), F.when(seen, F.col("ended")).alias("ended"), F.when(seen, F.col("spent")).alias("spent"), last.alias("is_last"))


def quality_states(intervals: DataFrame, intake: str) -> DataFrame:
    """case_id, state, reasons: every case once, from one pass over its stays.

    A case whose first known status is the intake is measured from there on: complete without reasons, else
    partial (open_stay, unknown_status).  Any other is not_measured, with all that speaks against it.
    """
    known = F.min(F.when(F.col("role") != "unknown", F.struct("position", "status"))).over(by_case())
    rows = intervals.withColumn("_k", known)
    measured = F.coalesce(F.col("_k.status") == intake, F.lit(False))
    inside = measured & (F.col("position") >= F.col("_k.position"))
    some = lambda c: F.coalesce(F.bool_or(c), F.lit(False))
    cases = rows.groupBy("case_id").agg(
        some(measured).alias("_m"), some(inside & F.col("ended").isNull() & (F.col("role") != "terminal")).alias("_open"), some(inside & (F.col("role") == "unknown")).alias("_unknown"),
        some(F.col("status").isNull()).alias("_blank"), some(F.col("status") == intake).alias("_intake"),
    )
    m = F.col("_m")
    reasons = _named({"blank_status": ~m & F.col("_blank"), "never_intake": ~m & ~F.col("_intake"), "no_intake_first": ~m, "open_stay": m & F.col("_open"), "unknown_status": m & F.col("_unknown")})
    state = F.when(~m, "not_measured").when(F.size(reasons) == 0, "complete").otherwise("partial")
    return cases.select("case_id", state.alias("state"), F.array_join(reasons, ",").alias("reasons"))


def case_errors(intervals: DataFrame, responses: DataFrame, intake: str) -> DataFrame:
    """error_id, case_id, rule, status, at: what was filled in wrongly, each occurrence once.

    starts_without_intake: at the first known status; terminal_in_middle: some stay that isn't terminal
    follows; status_without_label: from the start on; response_not_recorded: an automatic closing.
    """
    known = F.min(F.when(F.col("role") != "unknown", F.struct("position", "status"))).over(by_case())
    later = F.max((F.col("role") != "terminal").cast("int")).over(in_order().rowsBetween(1, Window.unboundedFollowing))
    rows = intervals.withColumn("_k", known).withColumn("_l", later)
    inside = (F.col("_k.status") == intake) & (F.col("position") >= F.col("_k.position"))
    rule = F.when((F.col("position") == F.coalesce(F.col("_k.position"), F.lit(1))) & ~F.col("_k.status").eqNullSafe(F.lit(intake)), "starts_without_intake")
    rule = rule.when(inside & (F.col("role") == "terminal") & (F.col("_l") == 1), "terminal_in_middle").when(inside & (F.col("role") == "unknown"), "status_without_label")
    found = rows.select("case_id", rule.alias("rule"), "status", F.col("started").alias("at")).filter("rule is not null")
    closed = responses.filter("outcome = 'closed_automatically'").select("case_id", F.lit("response_not_recorded").alias("rule"), "status", F.col("started").alias("at"))
    both = found.unionByName(closed).distinct()
    key = F.sha2(F.concat_ws("|", F.col("case_id").cast("string"), "rule", F.coalesce("status", F.lit("None")), F.col("at").cast("string")), 256)
    return both.select(key.alias("error_id"), "case_id", "rule", "status", "at")


def base_name(name: Column, marks: tuple[str, ...]) -> Column:
    """A name without a closing mark in brackets, such as [adjusted 2]; folded."""
    return F.trim(F.regexp_replace(folded(name), rf"\s*[\[(](?:{'|'.join(marks)})[^\])]*[\])]\s*$", ""))


def related_originals(items: DataFrame, marks: tuple[str, ...]) -> DataFrame:
    """item, base, related, originals of the copies in items(item, name, is_copy).

    related is the one item of the same base name that is no copy; null where there are none or several.
    """
    named = items.select("item", base_name(F.col("name"), marks).alias("base"), "is_copy")
    originals = named.filter("not is_copy").groupBy("base").agg(F.count("*").alias("originals"), F.min("item").alias("_one"))
    joined = named.filter("is_copy").join(originals, "base", "left")
    n = F.coalesce("originals", F.lit(0).cast("long"))
    return joined.select("item", "base", F.when(n == 1, F.col("_one")).alias("related"), n.alias("originals"))


def chain_breaks(events: DataFrame) -> DataFrame:
    """Events(case_id, event_id, at, status, previous) that claim another status before them than the log has."""
    order = by_case().orderBy("at", "event_id")
    rows = events.withColumn("_b", F.lag(F.struct("status")).over(order))
    return rows.filter(F.col("_b").isNotNull() & ~F.col("_b.status").eqNullSafe(F.col("previous"))).select("case_id", "event_id", "previous", F.col("_b.status").alias("was"))


def divergences(register: DataFrame, intervals: DataFrame) -> DataFrame:
    """case_id, issue of register(case_id, status, active): where it and the log disagree, or it is incomplete."""
    last = intervals.groupBy("case_id").agg(F.max_by(F.struct("status"), "position").alias("_l"))
    rows = register.join(last, "case_id", "left")
    issues = _named({"no_history": F.col("_l").isNull(), "blank": F.col("status").isNull(), "differs": F.col("_l").isNotNull() & F.col("status").isNotNull() & ~F.col("_l.status").eqNullSafe(F.col("status")), "inactive": ~F.coalesce("active", F.lit(False))})
    return rows.select("case_id", F.explode(issues).alias("issue"))


def changes_within(stays: DataFrame, changes: DataFrame, cut: int) -> DataFrame:
    """case_id, event_id, changes, first_change: changes(at) that fall in stays, which run up to the cut if open.

    Changes are counted up to every instant at which a stay begins or ends; a stay has as many as lie
    between its two counts, and the first is the change that so many lie before.  No stay meets a change.
    """
    until = F.coalesce("ended", F.lit(cut))
    rows = stays.filter(until > F.col("started")).select("case_id", "event_id", "started", until.alias("_until"))
    edges = rows.select(F.explode(F.array("started", "_until")).alias("at")).distinct().withColumn("n", F.lit(0).cast("long"))
    dated = changes.filter(F.col("at") < cut).groupBy("at").agg(F.count("*").alias("n"))
    times = dated.unionByName(edges).groupBy("at").agg(F.sum("n").alias("n"))
    counted = running_total(times, "at", "n", part=F.floor(F.col("at") / HOUR)).select("at", "n", (F.col("upto") - F.col("n")).alias("before"))
    upto = lambda edge, name: counted.select(F.col("at").alias(edge), F.col("before").alias(name))
    met = rows.join(upto("started", "_a"), "started").join(upto("_until", "_b"), "_until").filter("_b > _a")
    firsts = counted.filter("n > 0").select(F.col("before").alias("_a"), F.col("at").alias("first_change"))
    return met.join(firsts, "_a").select("case_id", "event_id", (F.col("_b") - F.col("_a")).alias("changes"), "first_change")

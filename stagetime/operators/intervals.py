"""Intervals from change events: building, closing, splitting, visiting, as-of attributes, audits.

All of it partitions by the case, so one shuffle on case_id serves the windows of a plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..config import CalendarSpec
from ..functions.columns import DAY, business_micros, local_day


def by_case() -> WindowSpec:
    return Window.partitionBy("case_id")


def in_order() -> WindowSpec:
    return by_case().orderBy("started", "event_id")


def tie_order(created: Column, event_id: Column) -> list[Column]:
    """What puts events of one instant in order: creation time as a number, numeric ids by value, then ids of text.

    A creation time that isn't all digits counts as 0.  Numbers may have up to 38 digits.
    """
    number = lambda c: F.when(F.regexp_like(c, F.lit("^[0-9]{1,38}$")), c).cast("decimal(38,0)")
    text = event_id.cast("string")
    value = number(text)
    return [F.coalesce(number(created.cast("string")), F.lit(0).cast("decimal(38,0)")), value.isNull(), value, text]


def build_intervals(events: DataFrame, cut: int, ties: list[Column] | None = None) -> DataFrame:
    """One row for each stay: events(case_id, event_id, at, status, account) before cut.

    Events are ordered by time and id, or by time and ties; a repeat of the status before it changes nothing.
    A stay ends where the next begins; the last is open (ended null) and observed up to the cut.
    """
    ties = [F.col("event_id")] if ties is None else ties
    order = by_case().orderBy("at", *ties)
    before = F.lag(F.struct("status")).over(order)
    changed = events.filter(F.col("at") < cut).withColumn("_b", before).filter(F.col("_b").isNull() | ~F.col("_b.status").eqNullSafe(F.col("status")))
    return changed.select(
        "case_id", "event_id", "account", "status", F.col("at").alias("started"), F.lead("at").over(order).alias("ended"), F.row_number().over(order).alias("position"),
        F.row_number().over(Window.partitionBy("case_id", "status").orderBy("at", *ties)).alias("visit"),
    ).withColumn("seen_until", F.coalesce("ended", F.lit(cut)))


def split_days(intervals: DataFrame, zone: str, skipped: tuple[str, ...] = ()) -> DataFrame:
    """case_id, status, day, spent: microseconds of each local day; midnight belongs to the next day.

    Stays in a skipped status, such as the terminal ones, are left out.
    """
    intervals = intervals.filter(~F.coalesce(F.col("status").isin(*skipped), F.lit(False))) if skipped else intervals
    first, last = local_day(F.col("started"), zone), local_day(F.col("seen_until") - 1, zone)
    days = intervals.filter("seen_until > started").withColumn("day", F.explode(F.sequence(first, last)))
    start = day_start(F.col("day"), zone)
    end = day_start(F.date_add("day", 1), zone)
    spent = F.least("seen_until", end) - F.greatest("started", start)
    return days.withColumn("spent", spent).groupBy("case_id", "status", "day").agg(F.sum("spent").alias("spent"))


def day_start(day: Column, zone: str) -> Column:
    return F.unix_micros(F.to_utc_timestamp(F.timestamp_micros(F.unix_date(day).cast("long") * DAY), zone))


def as_of(left: DataFrame, right: DataFrame, value: str) -> DataFrame:
    """left(case_id, at, ...) with the last value of right(case_id, at, value) at or before it.

    Where there is none, the earliest value that the case has; `found` tells which.  One union and one
    window: no range join.
    """
    columns = left.columns
    a = left.select(*columns, F.lit(1).alias("_side"), F.lit(None).cast(right.schema[value].dataType).alias("_v"))
    b = right.select(*[(F.col(c) if c in ("case_id", "at") else F.lit(None).cast(left.schema[c].dataType).alias(c)) for c in columns], F.lit(0).alias("_side"), F.col(value).alias("_v"))
    both = a.unionByName(b)
    order = by_case().orderBy("at", "_side")
    seen = F.last(F.when(F.col("_side") == 0, F.struct("_v")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    first = F.first(F.when(F.col("_side") == 0, F.struct("_v")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    out = both.withColumn("_s", seen).withColumn("_f", first).filter("_side = 1")
    found = F.when(F.col("_s").isNotNull(), "as_of").when(F.col("_f").isNotNull(), "earliest").otherwise("none")
    return out.select(*columns, F.coalesce(F.col("_s._v"), F.col("_f._v")).alias(value), found.alias("found"))


def compact(snapshots: DataFrame, values: list[str]) -> DataFrame:
    """Snapshots(case_id, at, ...) that differ from the one before, and the latest of each case."""
    order = by_case().orderBy("at")
    state = F.struct(*values)
    rows = snapshots.withColumn("_was", F.lag(F.struct(state.alias("x"))).over(order)).withColumn("_next", F.lead("at").over(order))
    return rows.filter(F.col("_was").isNull() | ~F.col("_was.x").eqNullSafe(state) | F.col("_next").isNull()).drop("_was", "_next")


def permanences(intervals: DataFrame) -> DataFrame:
    """Islands of one status over neighbouring stays of a case, whatever the account."""
    change = F.coalesce((~F.col("status").eqNullSafe(F.lag("status").over(in_order()))).cast("int"), F.lit(1))
    islands = intervals.withColumn("_c", change).withColumn("island", F.sum("_c").over(in_order()))
    return islands.groupBy("case_id", "status", "island").agg(F.min("started").alias("started"), F.max("seen_until").alias("seen_until"), F.count("*").alias("stays"))


def trajectory(intervals: DataFrame, intake: str) -> DataFrame:
    """Reasons against each case's trajectory, from one pass over its stays."""
    rows = intervals.withColumn("_p", F.lag("seen_until").over(in_order())).withColumn("_a", F.lag("account").over(in_order())).withColumn("_first", F.row_number().over(in_order()) == 1)
    flags = rows.groupBy("case_id").agg(
        F.count("*").alias("stays"),
        F.bool_or(F.col("_first") & ~F.col("status").eqNullSafe(F.lit(intake))).alias("no_intake"),
        F.bool_or(F.col("_p") < F.col("started")).alias("gap"),
        F.bool_or(F.col("_p") > F.col("started")).alias("overlap"),
        F.bool_or(F.col("_a") != F.col("account")).alias("boundary"),
        F.bool_or(F.col("status").isNull()).alias("blank"),
    )
    reasons = F.array_compact(F.array(*[F.when(F.coalesce(F.col(c), F.lit(False)), F.lit(c)) for c in ("no_intake", "gap", "overlap", "boundary", "blank")], F.when(F.col("stays") == 1, "single_stay")))
    return flags.select("case_id", "stays", F.array_join(reasons, ",").alias("reasons"), (F.size(reasons) == 0).alias("sound"))


def closures(intervals: DataFrame) -> DataFrame:
    """Terminal closures, reopenings and the number of the cycle that each stay is in.

    A stay that isn't terminal and directly follows a terminal one, in an account, reopens the case.
    """
    inside = Window.partitionBy("case_id", "account").orderBy("started", "event_id")
    was, joined = F.lag("role").over(inside), F.lag("ended").over(inside) == F.col("started")
    reopening = (was == "terminal") & joined & ~F.col("role").isin("terminal", "unknown")
    rows = intervals.withColumn("reopening", F.coalesce(reopening, F.lit(False)))
    rows = rows.withColumn("cycle_number", F.sum(F.col("reopening").cast("int")).over(inside) + 1)
    part = Window.partitionBy("case_id", "account", "cycle_number").orderBy("started", "event_id")
    earlier = F.coalesce(F.max((F.col("role") == "terminal").cast("int")).over(part.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.withColumn("closes", (F.col("role") == "terminal") & (earlier == 0))


def close_at(intervals: DataFrame, cut: int) -> DataFrame:
    """intervals as they stood at an earlier cut: stays begun by then, the last of each case open again and seen up to the cut."""
    rows = intervals.filter(F.col("started") < cut)
    ended = F.when(F.col("ended") < cut, F.col("ended"))
    return rows.withColumn("ended", ended).withColumn("seen_until", F.coalesce(ended, F.lit(cut)))


def closing_totals(closed: DataFrame) -> DataFrame:
    """case_id, account, cycle_number, closed_at, total, stays of closures(...): how long each closed cycle was from its first stay to its closing.

    total is null where the cycle's stays before the closing don't join: what lies between is unknown.
    """
    part = Window.partitionBy("case_id", "account", "cycle_number").orderBy("started", "event_id")
    before = F.lag("ended").over(part)
    gap = F.coalesce((~before.eqNullSafe(F.col("started"))).cast("int"), F.lit(0))
    rows = closed.withColumn("_gap", F.when(F.row_number().over(part) > 1, gap).otherwise(0))
    upto = part.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_gaps", F.sum("_gap").over(upto)).withColumn("_first", F.min("started").over(upto)).withColumn("stays", F.count("*").over(upto))
    return rows.filter("closes").select("case_id", "account", "cycle_number", F.col("started").alias("closed_at"), F.when(F.col("_gaps") == 0, F.col("started") - F.col("_first")).alias("total"), "stays")


def gold(intervals: DataFrame, measured: tuple[str, ...]) -> DataFrame:
    """intervals with is_first, is_last, returns (the case has left this status before) and eligible (closed, known and measured)."""
    last = F.lead("event_id").over(in_order()).isNull()
    role = F.coalesce(F.col("role").isin(*measured), F.lit(False))
    return intervals.withColumn("is_first", F.col("position") == 1).withColumn("is_last", last).withColumn("returns", F.col("visit") > 1).withColumn("eligible", role & F.col("ended").isNotNull() & F.col("status").isNotNull() & (F.col("ended") > F.col("started")))


def sla_summary(intervals: DataFrame, intake: str, spec: CalendarSpec) -> DataFrame:
    """case_id, first_intake, finished, lead, lead_business: from the first intake to the terminal stay that the case stands in.

    A case that goes on has not finished; one that never was in the intake has no lead time.
    """
    got = intervals.groupBy("case_id").agg(F.min(F.when(F.col("status") == intake, F.col("started"))).alias("first_intake"), F.max_by(F.struct("role", "started"), "position").alias("l"))
    got = got.select("case_id", "first_intake", F.when(F.col("l.role") == "terminal", F.col("l.started")).alias("finished"))
    known = F.when(F.col("finished") >= F.col("first_intake"), F.col("finished"))
    return got.withColumn("lead", known - F.col("first_intake")).withColumn("lead_business", business_micros(F.col("first_intake"), known, spec))


def latest(snapshots: DataFrame, cut: int, values: list[str]) -> DataFrame:
    """case_id, first_seen, seen_at and values: each case's last snapshot at or before a cut, and when it was first seen."""
    return snapshots.filter(F.col("at") <= cut).groupBy("case_id").agg(F.min("at").alias("first_seen"), F.max("at").alias("seen_at"), F.max_by(F.struct(*values), "at").alias("_v")).select("case_id", "first_seen", "seen_at", *[F.col(f"_v.{v}").alias(v) for v in values])

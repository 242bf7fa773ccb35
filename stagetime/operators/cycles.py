"""Work cycles, pricing cycles and client responses as running counts over a case's stays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import StatusModel
from ..functions.columns import local_day, strict_sum
from .intervals import by_case, in_order


def gate(intervals: DataFrame, intake: str) -> DataFrame:
    """Stays of cases whose first known status is the intake, from that stay on.

    A terminal stay that some other stay follows is no ending; it is left out.
    """
    known = F.min(F.when(F.col("role") != "unknown", F.struct("position", "status"))).over(by_case())
    rows = intervals.withColumn("_k", known).filter((F.col("_k.status") == intake) & (F.col("position") >= F.col("_k.position"))).drop("_k")
    later = F.max((F.col("role") != "terminal").cast("int")).over(in_order().rowsBetween(1, Window.unboundedFollowing))
    return rows.withColumn("_l", F.coalesce(later, F.lit(0))).filter("role <> 'terminal' or _l = 0").drop("_l")


def assign_cycles(stays: DataFrame) -> DataFrame:
    """stays with cycle, its number in the case, and kind (first or rework); null outside cycles.

    A segment ends with a delivery or terminal stay.  A segment with work is a cycle from its first work
    stay on; the stay that closes it is no member.
    """
    closing = F.col("role").isin("delivery", "terminal")
    segment = F.coalesce(F.sum(closing.cast("int")).over(in_order().rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = stays.withColumn("segment", segment)
    part = Window.partitionBy("case_id", "segment")
    first = F.min(F.when(F.col("role") == "work", F.col("position"))).over(part)
    rows = rows.withColumn("_first", first)
    opens = (F.col("_first") == F.col("position")).cast("int")
    number = F.sum(F.coalesce(opens, F.lit(0))).over(in_order())
    member = F.col("_first").isNotNull() & (F.col("position") >= F.col("_first")) & ~closing
    rows = rows.withColumn("cycle", F.when(member, number)).drop("_first")
    return rows.withColumn("kind", F.when(F.col("cycle") == 1, "first").when(F.col("cycle") > 1, "rework"))


def cycle_table(stays: DataFrame) -> DataFrame:
    """One row for each cycle of assign_cycles(stays), with how and when it was delivered."""
    closing = stays.filter(F.col("role").isin("delivery", "terminal")).select("case_id", "segment", F.col("role").alias("ending"), F.col("started").alias("closed"))
    cycles = stays.filter("cycle is not null").groupBy("case_id", "segment", "cycle", "kind").agg(
        F.min("started").alias("started"), F.count("*").alias("stays"), strict_sum(F.when(F.col("ended").isNotNull(), F.col("ended") - F.col("started"))).alias("spent"),
        strict_sum(F.when(F.col("role") != "work", F.lit(0)).when(F.col("ended").isNotNull(), F.col("ended") - F.col("started"))).alias("worked"),
    )
    return cycles.join(closing, ["case_id", "segment"], "left").withColumn("state", F.when(F.col("ending") == "delivery", "delivered").when(F.col("ending") == "terminal", "closed").otherwise("open"))


def pricing_cycles(intervals: DataFrame, intake: str, paused: Column | None = None) -> DataFrame:
    """Runs from an intake to a delivery or terminal stay; a new intake restarts, pauses don't count.

    A run whose first stay isn't an intake is none; a run with an unknown stay has no totals.
    """
    paused = F.col("role") == "standby" if paused is None else paused
    closing = F.col("role").isin("delivery", "terminal")
    starts = (F.col("status") == intake).cast("int")
    before = F.coalesce(F.sum(closing.cast("int")).over(in_order().rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = intervals.withColumn("run", F.sum(F.coalesce(starts, F.lit(0))).over(in_order()) + before)
    length = F.when(~paused & ~closing, F.col("seen_until") - F.col("started")).otherwise(F.lit(0))
    runs = rows.groupBy("case_id", "run").agg(
        F.min_by("status", "position").alias("first_status"), F.min("started").alias("started"), F.bool_or(closing).alias("finished"),
        F.bool_or(F.col("role") == "unknown").alias("unknown"), F.sum(length).alias("net"), F.max(F.when(closing, F.col("started"))).alias("delivered"),
    ).filter(F.col("first_status") == intake)
    counts = F.col("finished") & ~F.col("unknown")
    return runs.select("case_id", "run", "started", "finished", "unknown", F.when(counts, F.col("net")).alias("net"), F.when(counts, F.col("delivered") - F.col("started")).alias("gross"))


def merged_deliveries(stays: DataFrame) -> DataFrame:
    """Delivery stays, those that go on in another account under the same status as one."""
    goes_on = (F.lag("role").over(in_order()) == "delivery") & (F.lag("status").over(in_order()) == F.col("status")) & (F.lag("account").over(in_order()) != F.col("account"))
    rows = stays.withColumn("_new", F.when((F.col("role") == "delivery") & F.coalesce(goes_on, F.lit(False)), 0).otherwise(1))
    rows = rows.withColumn("_island", F.sum("_new").over(in_order())).filter("role = 'delivery'")
    return rows.groupBy("case_id", "_island").agg(F.min("position").alias("position"), F.max("position").alias("last_position"), F.min("started").alias("started"), F.max_by("ended", "position").alias("ended")).drop("_island")


def with_responses(stays: DataFrame, model: StatusModel, zone: str, automatic: tuple[int, int] = (28, 31)) -> DataFrame:
    """stays with what came after each: outcome, next_status, counts, days, waited; they mean something for deliveries only."""
    after = in_order().rowsBetween(1, Window.unboundedFollowing)
    decisive = F.first(F.when(F.col("role").isin("work", "delivery", "terminal"), F.struct("role", "status", "started")), ignorenulls=True).over(after)
    rows = stays.withColumn("_d", decisive).withColumn("_p", F.lead(F.struct("role", "status", "started")).over(in_order()))
    rows = rows.withColumn("_n", F.coalesce("_d", "_p"))
    days = F.date_diff(local_day(F.col("_n.started"), zone), local_day(F.col("started"), zone))
    answer = F.when(days.between(*automatic), "closed_automatically").otherwise("closed")
    for status, name in model.answers:
        answer = F.when(F.col("_d.status") == status, name).otherwise(answer)
    outcome = F.when(F.col("_d.role") == "work", "changes").when(F.col("_d.role") == "delivery", "new_version").when(F.col("_d").isNotNull(), answer)
    outcome = outcome.when(F.col("_p").isNotNull(), "paused").otherwise("waiting")
    rows = rows.withColumn("outcome", outcome).withColumn("counts", ~F.col("outcome").isin("paused", "no_return", "closed_automatically"))
    return rows.select(*stays.columns, "outcome", F.col("_n.status").alias("next_status"), "counts", days.alias("days"), (F.col("_d.started") - F.col("started")).alias("waited"))


def client_responses(stays: DataFrame, model: StatusModel, zone: str, automatic: tuple[int, int] = (28, 31)) -> DataFrame:
    """What came after each delivery: the next decisive stay, or why there is none.

    Work means changes were asked for, another delivery a new version; a terminal status is the answer that
    the model names for it.  Any other terminal status is the automatic closing if it came so many local days
    after, else a closing.  With only pauses after it the delivery is paused, with nothing it is waiting.
    counts says whether the outcome is the client's own doing.
    """
    rows = with_responses(stays, model, zone, automatic).filter("role = 'delivery'")
    return rows.select("case_id", "position", "status", "started", "ended", "outcome", "next_status", "counts", "days", "waited")


def cycle_steps(stays: DataFrame) -> DataFrame:
    """One row for each cycle and status of assign_cycles(stays): visits, null-strict time, share of the cycle's work."""
    inside = Window.partitionBy("case_id", "cycle", "status").orderBy("position")
    rows = stays.filter("cycle is not null and status is not null").withColumn("_v", F.coalesce((F.lag("position").over(inside) != F.col("position") - 1).cast("int"), F.lit(1)))
    steps = rows.groupBy("case_id", "cycle", "kind", "status", "role").agg(F.sum("_v").alias("visits"), F.min("started").alias("first_entered"), strict_sum(F.col("ended") - F.col("started")).alias("spent"))
    whole, is_work = Window.partitionBy("case_id", "cycle"), F.col("role") == "work"
    unknown = F.max((is_work & F.col("spent").isNull()).cast("int")).over(whole)
    steps = steps.withColumn("worked", F.when(unknown == 0, F.coalesce(F.sum(F.when(is_work, F.col("spent"))).over(whole), F.lit(0).cast("long"))))
    share = F.when((F.col("role") == "work") & (F.col("worked") > 0), F.round(100.0 * F.col("spent") / F.col("worked"), 6))
    return steps.withColumn("share", share)

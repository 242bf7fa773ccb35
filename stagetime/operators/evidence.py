"""Observations from single and batch events, stays that evidence supports, gaps, and recovered labels.

Unknown or conflicting evidence interrupts a stay; it never bridges one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _only(value: Column) -> Column:
    """The one value that a group's known members agree on, else null."""
    return F.when(F.min(value) == F.max(value), F.min(value))


def operation(action: Column, event_id: Column) -> Column:
    """Events of one action are one operation; an event without an action stands alone."""
    return F.when(action.isNotNull(), F.concat(F.lit("action:"), action.cast("string"))).otherwise(F.concat(F.lit("event:"), event_id.cast("string")))


def observations(events: DataFrame) -> DataFrame:
    """One row for each item and operation of events(item, action, event_id, at, value, single).

    Single events decide the time if there are any.  A single event of unknown value isn't outvoted by a
    batch.  Null at or value: unknown.  Which events are behind an observation is in lineage(events), so
    that no group is ever gathered into one row.
    """
    single = F.col("single")
    own = events.withColumn("operation", operation(F.col("action"), F.col("event_id"))).groupBy("item", "operation").agg(
        F.count("*").alias("n_events"), F.coalesce(F.bool_or(single), F.lit(False)).alias("_single"), F.bool_or(F.col("action").isNotNull()).alias("_action"),
        _only(F.col("value")).alias("_value"), F.coalesce(F.bool_or(single & F.col("value").isNull()), F.lit(False)).alias("_open"),
        _only(F.when(single, F.col("at"))).alias("_single_at"), _only(F.col("at")).alias("_any_at"),
        F.count_if(single & F.col("at").isNull()).alias("_single_lost"), F.count_if(F.col("at").isNull()).alias("_lost"),
    )
    value = F.when(~F.col("_open"), F.col("_value"))
    at = F.when(F.col("_single"), F.when(F.col("_single_lost") == 0, F.col("_single_at"))).when(F.col("_lost") == 0, F.col("_any_at"))
    reasons = F.array(F.when(~F.col("_action"), "no_action"), F.when(value.isNull(), "status"), F.when(at.isNull(), "time"))
    return own.select("item", "operation", "n_events", value.alias("value"), at.alias("at"), F.when(F.col("_single"), "single").otherwise("batch").alias("evidence"), F.array_join(F.array_compact(reasons), ",").alias("reasons"))


def lineage(events: DataFrame) -> DataFrame:
    """item, operation, event_id: which events each observation rests on."""
    return events.select("item", operation(F.col("action"), F.col("event_id")).alias("operation"), "event_id").distinct()


def _moments(seen: DataFrame) -> DataFrame:
    """One row for each item and time; value is null where the evidence of that time conflicts."""
    lost = F.max(F.col("at").isNull()).over(Window.partitionBy("item"))
    located = seen.withColumn("_lost", lost).filter("not _lost")
    agreed = F.when(F.count("*") == F.count("value"), _only(F.col("value")))
    return located.groupBy("item", "at").agg(agreed.alias("value"))


def supported_stays(seen: DataFrame) -> DataFrame:
    """Stays of observations(...): item, value, started, ended, visit, quality.

    A repeat of the value supports the stay it is in.  Quality is closed, interrupted (a gap came next,
    ended unknown) or no_exit.  An item with an observation of unknown time has no stays at all.
    """
    order = Window.partitionBy("item").orderBy("at")
    rows = _moments(seen).withColumn("_was", F.lag(F.struct("value")).over(order))
    edges = rows.filter(F.col("value").isNull() | F.col("_was").isNull() | ~F.col("_was.value").eqNullSafe(F.col("value")))
    after = F.lead(F.struct("at", "value")).over(order)
    visit = F.row_number().over(Window.partitionBy("item", "value").orderBy("at"))
    quality = F.when(F.col("_n").isNull(), "no_exit").when(F.col("_n.value").isNull(), "interrupted").otherwise("closed")
    ended = F.when(F.col("_n.value").isNotNull(), F.col("_n.at"))
    return edges.withColumn("_n", after).filter("value is not null").select("item", "value", F.col("at").alias("started"), ended.alias("ended"), visit.alias("visit"), quality.alias("quality"))


def gaps(seen: DataFrame) -> DataFrame:
    """item, at, reason: conflicting moments, and items (at null) whose evidence can't be placed in time."""
    lost = seen.filter("at is null").select("item").distinct().select("item", F.lit(None).cast("long").alias("at"), F.lit("unlocated").alias("reason"))
    return _moments(seen).filter("value is null").select("item", "at", F.lit("conflict").alias("reason")).unionByName(lost)


def recovered_labels(stays: DataFrame, labels: DataFrame, exits: DataFrame) -> DataFrame:
    """stays(item, started, ended, ...) with label and label_from.

    labels(item, at, label) hold what was seen at a start; where there is none or it conflicts,
    exits(item, at, previous) say what the event that closed the stay found.  Conflicts give no label.
    """
    at_start = labels.groupBy("item", F.col("at").alias("started")).agg(_only(F.col("label")).alias("_start"))
    at_exit = exits.groupBy("item", F.col("at").alias("ended")).agg(_only(F.col("previous")).alias("_exit"))
    both = stays.join(at_start, ["item", "started"], "left").join(at_exit, ["item", "ended"], "left")
    source = F.when(F.col("_start").isNotNull(), "start").when(F.col("_exit").isNotNull(), "exit").otherwise("none")
    return both.select(*stays.columns, F.coalesce("_start", "_exit").alias("label"), source.alias("label_from"))

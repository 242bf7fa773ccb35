"""Stays from a stream of status events, with state that expires and late events derived again.

Events carry `at`, when the status changed (microseconds), and `seen`, when the event arrived (a timestamp).  The
watermark follows the arrivals, so an event may be as late as it likes without being dropped; it is told as late,
and its case is derived again from the stored log.  Only an event that arrives more than `delay` behind the watermark, as
when a file of old arrivals turns up after newer ones, is dropped, which the query's progress counts.  A case from which nothing has arrived for `idle` gives up its
state by a timer on that clock; its next event begins it anew, and it is derived again as well.
State lives in RocksDB, whose provider `stays` sets.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from ..operators.intervals import build_intervals

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUT = "kind string, case_id long, event_id long, account string, status string, started long, ended long"
_TOLD = Row("kind", "case_id", "event_id", "account", "status", "started", "ended")
_STATE = "status string, account string, started long, event_id long, last_at long, last_id long"


class Stays(StatefulProcessor):
    """One open stay for each case: the value state; when it is given up: a timer."""

    def __init__(self, idle_ms: int):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.open = handle, handle.getValueState("open", _STATE)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        case, latest = key[0], 0
        now = self.open.get() if self.open.exists() else None
        status, account, started, event_id, last_at, last_id = now if now else (None, None, None, None, None, None)
        for r in sorted(rows, key=lambda r: (r["at"], r["event_id"])):
            latest = max(latest, r["seen_ms"])
            if last_at is not None and (r["at"], r["event_id"]) <= (last_at, last_id):
                yield _TOLD("late", case, r["event_id"], r["account"], r["status"], r["at"], None)
                continue
            last_at, last_id = r["at"], r["event_id"]
            if started is not None and r["status"] == status:
                continue
            yield _TOLD("begun", case, r["event_id"], r["account"], r["status"], r["at"], None) if started is None else _TOLD("closed", case, event_id, account, status, started, r["at"])
            status, account, started, event_id = r["status"], r["account"], r["at"], r["event_id"]
        if last_at is not None:
            self.open.update((status, account, started, event_id, last_at, last_id))
        for old in list(self.handle.listTimers()):
            latest = max(latest, old - self.idle_ms)
            self.handle.deleteTimer(old)
        self.handle.registerTimer(latest + self.idle_ms)

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        status, account, started, event_id, _, _ = self.open.get()
        self.open.clear()
        yield _TOLD("idle", key[0], event_id, account, status, started, None)

    def close(self) -> None:
        pass


def stays(events: DataFrame, idle: str = "30 days", delay: str = "0 seconds") -> DataFrame:
    """kind, case_id, event_id, account, status, started, ended of a stream of events(case_id, event_id, account, at, status, seen).

    kind is begun (the first event of a case without state), closed (a stay that has ended), late (an event
    behind its case's last one; started is its time) or idle (a stay whose case gave up its state).  Events that come
    together are put in order of (at, event_id); one that repeats the status before it changes nothing.
    """
    spark = events.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    idle_ms = int(spark.range(1).select(F.unix_millis(F.timestamp_seconds(F.lit(0)) + F.expr(f"INTERVAL {idle}"))).first()[0])
    rows = events.withWatermark("seen", delay).withColumn("seen_ms", F.unix_millis("seen"))
    return rows.groupBy("case_id").transformWithState(Stays(idle_ms), OUT, "append", "EventTime")


def settled(told: DataFrame, log: DataFrame, cut: int) -> DataFrame:
    """case_id, event_id, account, status, started, ended of every stay that has ended, from what stays(...) told.

    Cases with a late event, and those begun more than once, are derived again from log(case_id, event_id, account,
    at, status); of all others the stream's own rows stand.
    """
    doubt = told.groupBy("case_id").agg(F.count_if(F.col("kind") == "late").alias("late"), F.count_if(F.col("kind") == "begun").alias("begun")).filter("late > 0 or begun > 1").select("case_id")
    columns = ["case_id", "event_id", "account", "status", "started", "ended"]
    sure = told.filter("kind = 'closed'").join(doubt, "case_id", "left_anti").select(*columns)
    again = build_intervals(log.join(doubt, "case_id", "left_semi"), cut).filter("ended is not null").select(*columns)
    return sure.unionByName(again)

"""Registered queries of runs, streams and proofs: increments, replay, recomputed contracts with planted breaks, cuts and upgrades."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import audits, cycles, live, proofs, rules
from ..sources import runs
from .analysis_queries import _DESTINATIONS, _MARK, _OVERLAP, _destinations
from .binding import CUT, events_sql, intervals_sql, status_events, stays_sql
from .binding import intervals as all_intervals
from .binding import stays as all_stays
from .evidence_queries import _CONSOLIDATED, _SCOPE, _sources
from .queries import _CYCLES, _PAIRS, LOCAL, ZONE, _pairs, query

DAY = C.DAY

# --- runs -----------------------------------------------------------------------------------------


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status_events(spark, sf_dir).select("event_id", "at", "case_id", "account", "status")


def _uses(raw: DataFrame, cut: int) -> dict[str, DataFrame]:
    return {"uses": raw.groupBy("account", "status").agg(F.count("*").alias("events"), F.max("at").alias("last_at"))}


@query(events_sql(f"""SELECT 1 AS version, count(*) AS read, count(*) AS new_rows, max("at") AS watermark FROM bound WHERE "at" < {_MARK}
UNION ALL SELECT 2, count(*), count_if("at" >= {_MARK})::BIGINT, max("at") FROM bound WHERE "at" < {CUT} AND "at" >= (SELECT max("at") FROM bound WHERE "at" < {_MARK}) - {_OVERLAP}
UNION ALL SELECT 3, count(*), 0, max("at") FROM bound WHERE "at" < {CUT} AND "at" >= (SELECT max("at") FROM bound WHERE "at" < {CUT}) - {_OVERLAP}"""))
def incremental_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs over the log: all before a mark, what came since, and nothing but the overlap."""
    root, source = runs.workspace(spark), _log(spark, sf_dir)
    for day, cut in (("first", _MARK), ("second", CUT), ("third", CUT + 1)):
        runs.advance(spark, root, source.filter(F.col("at") < CUT), runs.run_id("log", day), cut, _OVERLAP)
    rows = [(c["version"], c["read"], c["tables"][runs.RAW]["rows"], c["watermark"]) for c in runs.CommitLog(spark, root).commits()]
    return spark.createDataFrame(rows, "version int, read long, new_rows long, watermark long")


@query(events_sql(f"""SELECT account, status, count(*) AS events, max("at") AS last_at, true AS replayed FROM bound WHERE "at" < {_MARK} GROUP BY account, status"""))
def replayed_uses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A derived table as of the first run, after a second one, and whether its raw rows give it again."""
    root, source = runs.workspace(spark), _log(spark, sf_dir)
    for day, cut in (("first", _MARK), ("second", CUT)):
        runs.advance(spark, root, source, runs.run_id("log", day), cut, _OVERLAP, derive=_uses)
    same = runs.replay(spark, root, source.schema, _uses, version=1)
    return runs.table(spark, root, "uses", 1).withColumn("replayed", F.lit(same["uses"]))


@query(intervals_sql("SELECT case_id, event_id, account, status, started, ended FROM iv WHERE ended IS NOT NULL"))
def streamed_stays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stays from a stream of the log in three arrivals, one run for each; every seventh event arrives two days late."""
    from ..streaming import stays  # needs the Python package protobuf

    root = runs.workspace(spark)
    seen = F.timestamp_micros(F.when(F.col("event_id") % 7 == 0, F.col("at") + 2 * DAY).otherwise(F.col("at")))
    log = status_events(spark, sf_dir).filter(F.col("at") < CUT).select("case_id", "event_id", "account", "at", "status", seen.alias("seen"))
    edges = ["0001-01-02", "2024-01-11", "2024-01-21", "9999-12-31"]
    for start, end in zip(edges, edges[1:], strict=False):
        log.filter((F.col("seen") >= start) & (F.col("seen") < end)).write.mode("append").parquet(f"{root}/log")
        stream = spark.readStream.schema(log.schema).parquet(f"{root}/log")
        told = stays.stays(stream, idle="10 days").writeStream.format("parquet").option("path", f"{root}/told").option("checkpointLocation", f"{root}/state")
        told.trigger(availableNow=True).start().awaitTermination()
    stored = spark.read.schema(log.schema).parquet(f"{root}/log")
    return stays.settled(spark.read.schema(stays.OUT).parquet(f"{root}/told"), stored, CUT)


# --- recomputed contracts -------------------------------------------------------------------------


def _planted(derived: DataFrame, mark: Column, key: str, field: str, other: Column) -> DataFrame:
    """derived as if stored with faults: of every 97 marks one is missing, one there twice, one changed, one under another key too."""
    m = F.pmod(mark, F.lit(97))
    moved = F.when(m == 0, F.array().cast("array<boolean>")).when(m == 1, F.array(F.lit(False), F.lit(False))).when(m == 3, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    rows = derived.withColumn("_moved", moved).withColumn(field, F.when(m == 2, other).otherwise(F.col(field))).withColumn("_moved", F.explode("_moved"))
    return rows.withColumn(key, F.when(F.col("_moved"), -1 - F.col(key)).otherwise(F.col(key))).drop("_moved")


def _planted_sql(contract: str, source: str, mark: str, field: str) -> str:
    """What compared(...) must find of _planted(...)."""
    return f""" SELECT '{contract}' AS contract, kind, CASE kind WHEN 'changed' THEN '{field}' ELSE '' END AS fields, count(*) AS n
FROM (SELECT CASE ({mark}) % 97 WHEN 0 THEN 'missing' WHEN 1 THEN 'repeated' WHEN 2 THEN 'changed' WHEN 3 THEN 'extra' END AS kind FROM {source}) WHERE kind IS NOT NULL GROUP BY kind"""


def _contract(name: str, derived: DataFrame, key: list[str], mark: Column, field: str, other: Column) -> DataFrame:
    stored = _planted(derived, mark, key[0], field, other)
    return proofs.verdict(proofs.compared(stored, derived, key, [c for c in derived.columns if c not in key]), name)


@query(intervals_sql(_planted_sql("stays", "iv", "event_id", "position")))
def recomputed_stays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _contract("stays", all_intervals(spark, sf_dir), ["event_id"], F.col("event_id"), "position", F.col("position") + 1)


@query(stays_sql(_planted_sql("cycles", "cyc", "case_id * 7 + cycle", "worked"), _CYCLES))
def recomputed_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cycles held against their stays: a null total that becomes 0 counts as a change."""
    other = F.when(F.col("worked").isNotNull(), F.col("worked") + 1).otherwise(0)
    return _contract("cycles", cycles.cycle_table(all_stays(spark, sf_dir)), ["case_id", "cycle"], F.col("case_id") * 7 + F.col("cycle"), "worked", other)


@query(events_sql(_CONSOLIDATED + _planted_sql("consolidation", "(SELECT * FROM cx WHERE reasons = '')", "event_id", "spent")))
def recomputed_consolidation(spark: SparkSession, sf_dir: str) -> DataFrame:
    of, pairs = _sources(spark, sf_dir)
    other = F.when(F.col("spent").isNull(), 0).otherwise(F.col("spent") + 1)
    return _contract("consolidation", live.consolidate(of, pairs, _SCOPE)[0], ["event_id", "source", "item"], F.col("event_id"), "spent", other)


@query(_PAIRS + _planted_sql("identity", "c", "old_id * 31 + new_id", "seeds"))
def recomputed_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _contract("identity", _pairs(spark, sf_dir), ["old_id", "new_id"], F.col("old_id") * 31 + F.col("new_id"), "seeds", F.lit("by hand"))


@query(events_sql(_DESTINATIONS + _planted_sql("destinations", "ds", "case_id", "destination")))
def recomputed_destinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _contract("destinations", _destinations(spark, sf_dir), ["case_id"], F.col("case_id"), "destination", F.lit("elsewhere"))


_BROKEN = """, bk AS (SELECT case_id, event_id, account, status, started, CASE case_id % 5 WHEN 1 THEN ended - 1 WHEN 3 THEN CASE WHEN ended IS NOT NULL THEN started - 1 END WHEN 2 THEN NULL ELSE ended END AS ended,
  position + CASE case_id % 5 WHEN 0 THEN 1 ELSE 0 END AS position, visit, CASE WHEN case_id % 5 = 4 AND position = 1 THEN started - 86400000000 ELSE seen_until END AS seen_until FROM iv)"""


@query(intervals_sql(f"""{_BROKEN}, nx AS (SELECT *, lead(started) OVER (PARTITION BY case_id ORDER BY started, event_id) AS nx FROM bk), ca AS (SELECT case_id, count(*) AS n, max(position) AS top, count_if(ended IS NULL) AS o, sum(seen_until - started) AS s, max(seen_until) - min(started) AS sp,
  count_if(ended IS DISTINCT FROM nx) AS b, count_if(ended < started) AS neg FROM nx GROUP BY case_id),
dy AS (SELECT case_id, sum(least(seen_until {LOCAL}, d + 86400000000) - greatest(started {LOCAL}, d)) AS t FROM (SELECT *, unnest(range((started {LOCAL}) // 86400000000, (seen_until - 1 {LOCAL}) // 86400000000 + 1)) * 86400000000 AS d FROM bk WHERE seen_until > started) GROUP BY case_id)
SELECT unnest(['sequence', 'continuity', 'several open', 'negative', 'span', 'days']) AS "check", unnest([count_if(top <> n), count_if(b > 0), count_if(o > 1), count_if(neg > 0), count_if(s <> sp), count_if(coalesce(t, 0) <> s)])::BIGINT AS n FROM ca LEFT JOIN dy USING (case_id)"""))
def broken_stays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks of stays on stays that break each of them."""
    h, ended = F.col("case_id") % 5, F.col("ended")
    rows = all_intervals(spark, sf_dir)
    rows = rows.withColumn("seen_until", F.when((h == 4) & (F.col("position") == 1), F.col("started") - DAY).otherwise(F.col("seen_until")))
    rows = rows.withColumn("ended", F.when(h == 1, ended - 1).when(h == 3, F.when(ended.isNotNull(), F.col("started") - 1)).when(h != 2, ended))
    return audits.stay_checks(rows.withColumn("position", F.when(h == 0, F.col("position") + 1).otherwise(F.col("position"))), ZONE)


@query(stays_sql("""SELECT 'totals' AS "check", count_if(case_id % 4 IN (0, 2))::BIGINT AS n FROM cyc UNION ALL SELECT 'order', count_if(closed IS NOT NULL AND case_id % 4 = 1)::BIGINT FROM cyc
UNION ALL SELECT 'numbers', count(*) FROM (SELECT case_id FROM cyc WHERE case_id % 4 = 3 GROUP BY case_id)""", _CYCLES))
def broken_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks of cycles on cycles with other totals, endings before starts, and numbers that leave one out."""
    rows, h = all_stays(spark, sf_dir), F.col("case_id") % 4
    table = cycles.cycle_table(rows)
    table = table.withColumn("stays", F.when(h == 0, F.col("stays") + 1).otherwise(F.col("stays"))).withColumn("closed", F.when((h == 1) & F.col("closed").isNotNull(), F.col("started") - 1).otherwise(F.col("closed")))
    table = table.withColumn("started", F.when(h == 2, F.col("started") - 1).otherwise(F.col("started"))).withColumn("cycle", F.when(h == 3, F.col("cycle") + 1).otherwise(F.col("cycle")))
    # The stays are numbered alike, so that only the gap in the numbers is told of the last kind.
    stays = rows.withColumn("cycle", F.when(h == 3, F.col("cycle") + 1).otherwise(F.col("cycle")))
    return audits.cycle_checks(stays, table)


# --- cuts, upgrades, splits -----------------------------------------------------------------------

_CASES = """, dc AS (SELECT case_id, bool_or(coalesce(status = 'Declined', false)) AS declined, min(event_id) AS e FROM iv GROUP BY case_id)"""


def _fields(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != "case_id"]


@query(intervals_sql(_CASES + """ SELECT state, count(*) AS cases FROM (SELECT CASE WHEN declined THEN CASE WHEN case_id % 7 = 0 THEN 'still_there' ELSE 'left_out' END WHEN case_id % 53 = 1 THEN 'lost' WHEN case_id % 53 = 0 THEN 'changed' ELSE 'kept' END AS state FROM dc
UNION ALL SELECT 'unheard_of' FROM dc WHERE case_id % 61 = 5) GROUP BY state"""))
def recut_proof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cut to the cases that were never declined, with cases changed, lost, left in and made up."""
    before = all_intervals(spark, sf_dir)
    kept = rules.whole_case_filter(before, F.col("status") == "Declined")
    case = F.col("case_id")
    after = kept.filter(case % 53 != 1).withColumn("started", F.when(case % 53 == 0, F.col("started") + 1).otherwise(F.col("started")))
    after = after.unionByName(before.join(kept.select("case_id").distinct(), "case_id", "left_anti").filter(case % 7 == 0)).unionByName(before.filter(case % 61 == 5).withColumn("case_id", -1 - case))
    return proofs.recut(before, after, kept.select("case_id"), "case_id", _fields(before)).groupBy("state").agg(F.count("*").alias("cases"))


@query(stays_sql("""SELECT 'columns' AS "check", 1::BIGINT AS n UNION ALL SELECT 'groups lost', count_if(case_id % 41 = 0)::BIGINT FROM cyc UNION ALL SELECT 'groups new', count_if(case_id % 41 = 1)::BIGINT FROM cyc UNION ALL SELECT 'groups changed', count_if(case_id % 41 = 2)::BIGINT FROM cyc""", _CYCLES))
def upgrade_proof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An upgrade that adds one declared and one undeclared column, and loses, adds and changes cycles."""
    before, case = cycles.cycle_table(all_stays(spark, sf_dir)), F.col("case_id")
    after = before.filter(case % 41 != 0).unionByName(before.filter(case % 41 == 1).withColumn("case_id", -1 - case))
    after = after.withColumn("started", F.when(case % 41 == 2, F.col("started") + 1).otherwise(F.col("started"))).withColumn("days", F.floor((F.col("closed") - F.col("started")) / DAY)).withColumn("note", F.lit("?"))
    return proofs.upgrade(before, after, ["case_id", "cycle"], ["days"])


@query(intervals_sql(_CASES + """ SELECT state, count(*) AS cases FROM (SELECT CASE case_id % 59 WHEN 0 THEN CASE WHEN declined THEN 'both' ELSE 'published' END WHEN 1 THEN 'neither' WHEN 2 THEN 'changed' ELSE CASE WHEN declined THEN 'excluded' ELSE 'published' END END AS state FROM dc) GROUP BY state"""))
def split_proof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published and excluded cases held against their source, with excluded ones published, and cases lost and changed."""
    source, case = all_intervals(spark, sf_dir), F.col("case_id")
    good = rules.whole_case_filter(source, F.col("status") == "Declined")
    bad = source.join(good.select("case_id").distinct(), "case_id", "left_anti")
    published = good.unionByName(bad.filter(case % 59 == 0))
    spoilt = lambda df: df.filter(case % 59 != 1).withColumn("status", F.when(case % 59 == 2, F.lit("by hand")).otherwise(F.col("status")))
    return proofs.published_split(source, spoilt(published), spoilt(bad), "case_id", _fields(source)).groupBy("state").agg(F.count("*").alias("cases"))


@query(intervals_sql("""SELECT account, count(*) AS n_rows, (SELECT count(*) FROM iv) AS all_rows, true AS adds_up FROM iv GROUP BY account"""))
def account_prints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints by account, and whether together they are the fingerprint of the table."""
    rows = all_intervals(spark, sf_dir)
    prints = proofs.group_prints(rows, ["account"], rows.columns)
    whole = C.fingerprint(rows).select(F.col("n_rows").alias("all_rows"), F.col("digest").alias("_d"))
    total = proofs.combined(prints).join(F.broadcast(whole), F.lit(True)).select("all_rows", ((F.col("n_rows") == F.col("all_rows")) & (F.col("digest") == F.col("_d"))).alias("adds_up"))  # one row each
    return prints.drop("digest").crossJoin(F.broadcast(total))

"""The registered queries over the given tables, each beside the SQL that it is held against."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import cycles, identity, intervals, model, quality, quantiles, rules
from ..sources import logs
from .binding import CUT, MODEL, SPEC, events_sql, intervals_sql, read, stays_sql, status_events
from .binding import intervals as all_intervals
from .binding import stays as all_stays

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
ZONE = SPEC.zone
LOCAL = "- 10800000000"  # Sao Paulo in 2024


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


_HOLIDAYS = ", ".join(f"DATE '{d}'" for d in SPEC.holidays() if d.year in (2023, 2024))
_BUSINESS = f"""
SELECT case_id, event_id, coalesce(sum(greatest(0, least(seen_until {LOCAL}, d + w.b * 3600000000) - greatest(started {LOCAL}, d + w.a * 3600000000))), 0)::BIGINT AS business
FROM (SELECT case_id, event_id, started, seen_until, unnest(range((started {LOCAL}) // 86400000000, (seen_until {LOCAL}) // 86400000000 + 1)) * 86400000000 AS d FROM iv) x
CROSS JOIN (VALUES (10, 13), (14, 19)) w(a, b)
WHERE isodow(make_timestamp(d)) < 6 AND make_timestamp(d)::DATE NOT IN ({_HOLIDAYS})
GROUP BY case_id, event_id"""


@query(intervals_sql("SELECT case_id, event_id, account, status, started, ended, position, visit, seen_until, role FROM iv"))
def status_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_intervals(spark, sf_dir)


@query(intervals_sql(f", bh AS ({_BUSINESS}) SELECT iv.case_id, iv.event_id, coalesce(business, 0)::BIGINT AS business FROM iv LEFT JOIN bh USING (case_id, event_id)"))
def business_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_intervals(spark, sf_dir).select("case_id", "event_id", C.business_micros(F.col("started"), F.col("seen_until"), SPEC).alias("business"))


@query(intervals_sql(f""", bh AS ({_BUSINESS})
SELECT status, count(*) AS stays, count(ended) AS closed, round(avg((ended - started)::DOUBLE), 3) AS mean_us,
       round(quantile_cont((ended - started)::DOUBLE, 0.5), 3) AS median_us, round(quantile_cont((ended - started)::DOUBLE, 0.9), 3) AS p90_us,
       sum(coalesce(business, 0))::BIGINT AS business FROM iv LEFT JOIN bh USING (case_id, event_id) GROUP BY status"""))
def status_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = (F.col("ended") - F.col("started")).cast("double")
    rows = all_intervals(spark, sf_dir).withColumn("b", C.business_micros(F.col("started"), F.col("seen_until"), SPEC))
    got = rows.groupBy("status").agg(F.count("*").alias("stays"), F.count("ended").alias("closed"), F.round(F.avg(value), 3).alias("mean_us"), F.sum("b").alias("business"))
    return quantiles.with_quantiles(got, rows, ("status",), value, {"median_us": 0.5, "p90_us": 0.9})


@query(intervals_sql(f"""SELECT case_id, status, make_timestamp(d)::DATE AS day, sum(least(seen_until {LOCAL}, d + 86400000000) - greatest(started {LOCAL}, d))::BIGINT AS spent
FROM (SELECT *, unnest(range((started {LOCAL}) // 86400000000, (seen_until - 1 {LOCAL}) // 86400000000 + 1)) * 86400000000 AS d FROM iv WHERE seen_until > started) GROUP BY case_id, status, d"""))
def day_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.split_days(all_intervals(spark, sf_dir), ZONE)


def _snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last event of each case and day, seen at the day's end."""
    day = (F.floor(F.col("at") / 86_400_000_000) * 86_400_000_000 + 86_399_999_999).cast("long")
    rows = status_events(spark, sf_dir).withColumn("day", day)
    return rows.groupBy("case_id", "day").agg(F.max_by(F.struct("event_type", (F.col("k") % 3).alias("k")), F.struct("at", "event_id")).alias("x")).select("case_id", F.col("day").alias("at"), "x.event_type", "x.k")


_SNAPSHOTS = """, snap AS (SELECT case_id, "at" // 86400000000 * 86400000000 + 86399999999 AS "at", event_type, k % 3 AS k FROM bound
QUALIFY row_number() OVER (PARTITION BY case_id, "at" // 86400000000 ORDER BY "at" DESC, event_id DESC) = 1)"""


@query(events_sql(f"""{_SNAPSHOTS}, m AS (SELECT *, lag(event_type) OVER w AS e, lag(k) OVER w AS j, row_number() OVER w AS rn, lead("at") OVER w AS nxt FROM snap WINDOW w AS (PARTITION BY case_id ORDER BY "at"))
SELECT case_id, "at", event_type, k FROM m WHERE rn = 1 OR e IS DISTINCT FROM event_type OR j IS DISTINCT FROM k OR nxt IS NULL"""))
def snapshot_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.compact(_snapshots(spark, sf_dir), ["event_type", "k"])


@query(intervals_sql(f"""{_SNAPSHOTS} SELECT i.case_id, i.event_id, i.started AS "at",
coalesce((SELECT s.event_type FROM snap s WHERE s.case_id = i.case_id AND s."at" <= i.started ORDER BY s."at" DESC LIMIT 1),
         (SELECT s.event_type FROM snap s WHERE s.case_id = i.case_id ORDER BY s."at" LIMIT 1)) AS event_type,
CASE WHEN EXISTS (SELECT 1 FROM snap s WHERE s.case_id = i.case_id AND s."at" <= i.started) THEN 'as_of' WHEN EXISTS (SELECT 1 FROM snap s WHERE s.case_id = i.case_id) THEN 'earliest' ELSE 'none' END AS found FROM iv i"""))
def as_of_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = all_intervals(spark, sf_dir).select("case_id", "event_id", F.col("started").alias("at"))
    return intervals.as_of(left, _snapshots(spark, sf_dir), "event_type")


@query(intervals_sql("""SELECT case_id, status, min(started) AS started, max(seen_until) AS seen_until, count(*) AS stays FROM
(SELECT *, position - row_number() OVER (PARTITION BY case_id, status ORDER BY position) AS g FROM iv) GROUP BY case_id, status, g"""))
def status_permanences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.permanences(all_intervals(spark, sf_dir)).drop("island")


@query(intervals_sql(""", f AS (SELECT *, lag(account) OVER w AS a, lag(seen_until) OVER w AS p FROM iv WINDOW w AS (PARTITION BY case_id ORDER BY started, event_id)),
g AS (SELECT case_id, count(*) AS stays, bool_or(position = 1 AND status IS DISTINCT FROM 'Intake') AS ni, bool_or(coalesce(p < started, false)) AS gap, bool_or(coalesce(p > started, false)) AS ovl,
      bool_or(coalesce(a <> account, false)) AS bnd, bool_or(status IS NULL) AS bl FROM f GROUP BY case_id),
r AS (SELECT case_id, stays, concat_ws(',', CASE WHEN ni THEN 'no_intake' END, CASE WHEN gap THEN 'gap' END, CASE WHEN ovl THEN 'overlap' END, CASE WHEN bnd THEN 'boundary' END, CASE WHEN bl THEN 'blank' END, CASE WHEN stays = 1 THEN 'single_stay' END) AS reasons FROM g)
SELECT case_id, stays, reasons, reasons = '' AS sound FROM r"""))
def trajectory_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.trajectory(all_intervals(spark, sf_dir), MODEL.intake)


@query(intervals_sql(""", r AS (SELECT *, coalesce(lag(role) OVER w = 'terminal' AND lag(ended) OVER w = started AND role NOT IN ('terminal', 'unknown'), false) AS reopening FROM iv WINDOW w AS (PARTITION BY case_id, account ORDER BY started, event_id)),
c AS (SELECT *, 1 + sum(reopening::INT) OVER (PARTITION BY case_id, account ORDER BY started, event_id) AS cycle_number FROM r)
SELECT case_id, event_id, reopening, cycle_number::BIGINT AS cycle_number,
role = 'terminal' AND row_number() OVER (PARTITION BY case_id, account, cycle_number, role ORDER BY started, event_id) = 1 AS closes FROM c"""))
def terminal_closures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.closures(all_intervals(spark, sf_dir)).select("case_id", "event_id", "reopening", "cycle_number", "closes")


@query(stays_sql("SELECT case_id, event_id, position, role, segment, cycle, kind FROM stays"))
def work_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_stays(spark, sf_dir).select("case_id", "event_id", "position", "role", "segment", "cycle", "kind")


_CYCLES = """, closing AS (SELECT case_id, segment, role AS ending, started AS closed FROM stays WHERE role IN ('delivery', 'terminal')),
agg AS (SELECT case_id, segment, cycle, kind, min(started) AS started, count(*) AS stays, CASE WHEN count(*) = count(ended) THEN sum(ended - started) END::BIGINT AS spent,
        CASE WHEN count_if(role = 'work' AND ended IS NULL) = 0 THEN coalesce(sum(CASE WHEN role = 'work' THEN ended - started ELSE 0 END), 0) END::BIGINT AS worked FROM stays WHERE cycle IS NOT NULL GROUP BY ALL),
cyc AS (SELECT agg.*, ending, closed, CASE ending WHEN 'delivery' THEN 'delivered' WHEN 'terminal' THEN 'closed' ELSE 'open' END AS state FROM agg LEFT JOIN closing USING (case_id, segment))"""


@query(stays_sql("SELECT * FROM cyc", _CYCLES))
def cycle_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cycles.cycle_table(all_stays(spark, sf_dir))


@query(stays_sql("""SELECT kind, state, count(*) AS cycles, round(avg((closed - started)::DOUBLE), 3) AS mean_us, round(quantile_cont((closed - started)::DOUBLE, 0.5), 3) AS median_us,
round(avg(worked::DOUBLE), 3) AS mean_worked FROM cyc GROUP BY kind, state""", _CYCLES))
def delivery_by_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    took = (F.col("closed") - F.col("started")).cast("double")
    rows = cycles.cycle_table(all_stays(spark, sf_dir))
    got = rows.groupBy("kind", "state").agg(F.count("*").alias("cycles"), F.round(F.avg(took), 3).alias("mean_us"), F.round(F.avg(F.col("worked").cast("double")), 3).alias("mean_worked"))
    return quantiles.with_quantiles(got, rows, ("kind", "state"), took, {"median_us": 0.5})


@query(intervals_sql(""", t AS (SELECT *, (SELECT count(*) FROM iv a WHERE a.case_id = i.case_id AND a.position <= i.position AND a.status = 'Intake')
  + (SELECT count(*) FROM iv b WHERE b.case_id = i.case_id AND b.position < i.position AND b.role IN ('delivery', 'terminal')) AS run FROM iv i),
r AS (SELECT case_id, run, arg_min(coalesce(status, ''), position) AS f, min(started) AS started, bool_or(role IN ('delivery', 'terminal')) AS finished, bool_or(role = 'unknown') AS unknown,
  sum(CASE WHEN role NOT IN ('standby', 'delivery', 'terminal') THEN seen_until - started ELSE 0 END) AS net, max(CASE WHEN role IN ('delivery', 'terminal') THEN started END) AS delivered FROM t GROUP BY case_id, run)
SELECT case_id, run, started, finished, unknown, CASE WHEN finished AND NOT unknown THEN net END::BIGINT AS net, CASE WHEN finished AND NOT unknown THEN delivered - started END AS gross FROM r WHERE f = 'Intake'"""))
def pricing_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cycles.pricing_cycles(all_intervals(spark, sf_dir), MODEL.intake)


@query(stays_sql("""SELECT case_id, min(position) AS position, max(position) AS last_position, min(started) AS started, arg_max(ended, position) FILTER (WHERE true) AS ended FROM
(SELECT *, sum(n) OVER (PARTITION BY case_id ORDER BY started, event_id) AS island FROM (SELECT *, CASE WHEN role = 'delivery' AND coalesce(lag(role) OVER w = 'delivery' AND lag(status) OVER w = status AND lag(account) OVER w <> account, false) THEN 0 ELSE 1 END AS n
FROM stays WINDOW w AS (PARTITION BY case_id ORDER BY started, event_id))) WHERE role = 'delivery' GROUP BY case_id, island"""))
def merged_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cycles.merged_deliveries(all_stays(spark, sf_dir))


_RESPONSES = f""", nxt AS (SELECT s.case_id, s.position, s.status, s.started, s.ended, (SELECT min(n.position) FROM stays n WHERE n.case_id = s.case_id AND n.position > s.position AND n.role IN ('work', 'delivery', 'terminal')) AS d,
(SELECT min(n.position) FROM stays n WHERE n.case_id = s.case_id AND n.position > s.position) AS f FROM stays s WHERE s.role = 'delivery'),
rd AS (SELECT x.*, n.status AS next_status, n.role AS nr, (n.started {LOCAL}) // 86400000000 - (x.started {LOCAL}) // 86400000000 AS days, CASE WHEN d IS NOT NULL THEN n.started - x.started END AS waited
  FROM nxt x LEFT JOIN stays n ON n.case_id = x.case_id AND n.position = coalesce(x.d, x.f)),
ro AS (SELECT *, CASE WHEN d IS NULL THEN CASE WHEN f IS NULL THEN 'waiting' ELSE 'paused' END WHEN nr = 'work' THEN 'changes' WHEN nr = 'delivery' THEN 'new_version' WHEN next_status = 'Approved' THEN 'approved'
  WHEN next_status = 'Declined' THEN 'declined' WHEN next_status = 'No return' THEN 'no_return' WHEN days BETWEEN 28 AND 31 THEN 'closed_automatically' ELSE 'closed' END AS outcome FROM rd),
resp AS (SELECT case_id, position, status, started, ended, outcome, next_status, outcome NOT IN ('paused', 'no_return', 'closed_automatically') AS counts, days, waited FROM ro)"""


def _responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cycles.client_responses(all_stays(spark, sf_dir), MODEL, ZONE)


@query(stays_sql("SELECT * FROM resp", _RESPONSES))
def client_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _responses(spark, sf_dir)


@query(stays_sql("SELECT outcome, count(*) AS deliveries, round(avg(waited::DOUBLE), 3) AS mean_wait, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS share FROM resp GROUP BY outcome", _RESPONSES))
def outcome_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = _responses(spark, sf_dir).groupBy("outcome").agg(F.count("*").alias("deliveries"), F.round(F.avg(F.col("waited").cast("double")), 3).alias("mean_wait"))
    return got.withColumn("share", F.round(F.col("deliveries") * 100.0 / F.sum("deliveries").over(Window.partitionBy()), 6))


@query(stays_sql("""SELECT case_id, cycle, kind, status, role, sum(v)::BIGINT AS visits, min(started) AS first_entered, CASE WHEN count(*) = count(ended) THEN sum(ended - started) END::BIGINT AS spent, any_value(w)::BIGINT AS worked,
CASE WHEN role = 'work' AND any_value(w) > 0 THEN round(100.0::DOUBLE * CASE WHEN count(*) = count(ended) THEN sum(ended - started) END / any_value(w), 6) END AS share
FROM (SELECT *, CASE WHEN coalesce(lag(position) OVER (PARTITION BY case_id, cycle, status ORDER BY position) <> position - 1, true) THEN 1 ELSE 0 END AS v,
  CASE WHEN count_if(role = 'work' AND ended IS NULL) OVER c = 0 THEN coalesce(sum(CASE WHEN role = 'work' THEN ended - started END) OVER c, 0) END AS w
  FROM stays WHERE cycle IS NOT NULL AND status IS NOT NULL WINDOW c AS (PARTITION BY case_id, cycle)) GROUP BY case_id, cycle, kind, status, role"""))
def cycle_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cycles.cycle_steps(all_stays(spark, sf_dir))


_PROJECTS = f""", lastp AS (SELECT case_id, max(position) AS p FROM stays GROUP BY case_id),
proj AS (SELECT s.case_id, min(s.started) AS opened, count(*) AS stays, count_if(s.role = 'delivery')::BIGINT AS deliveries, count(DISTINCT s.cycle) AS cycles, min(CASE WHEN s.role = 'delivery' THEN s.started END) AS first_delivery,
  min(CASE WHEN s.role = 'delivery' THEN s.started END) - min(s.started) AS to_first_delivery, string_agg(DISTINCT s.account, '+' ORDER BY s.account) AS accounts, any_value(l.status) AS status,
  any_value(CASE WHEN l.role = 'terminal' THEN 'closed' WHEN l.role = 'delivery' THEN 'delivered' WHEN l.role IN ('standby', 'waiting') THEN 'waiting' WHEN l.role = 'unknown' THEN 'unknown' ELSE 'working' END) AS state,
  any_value(CASE WHEN l.role <> 'terminal' THEN {CUT} - l.started END) AS age
  FROM stays s JOIN lastp USING (case_id) JOIN stays l ON l.case_id = s.case_id AND l.position = lastp.p GROUP BY s.case_id)"""


@query(stays_sql("SELECT * FROM proj", _PROJECTS))
def project_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.projects(all_stays(spark, sf_dir), CUT)


@query(stays_sql("SELECT state, count(*) AS cases, sum(deliveries)::BIGINT AS deliveries, round(avg(to_first_delivery::DOUBLE), 3) AS mean_to_first FROM proj GROUP BY state", _PROJECTS))
def projects_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.projects(all_stays(spark, sf_dir), CUT).groupBy("state").agg(F.count("*").alias("cases"), F.sum("deliveries").alias("deliveries"), F.round(F.avg(F.col("to_first_delivery").cast("double")), 3).alias("mean_to_first"))


@query(stays_sql("""SELECT case_id, status, count(DISTINCT g) AS visits, count(*) AS stays, CASE WHEN count(*) = count(ended) THEN sum(ended - started) END::BIGINT AS total
FROM (SELECT *, position - row_number() OVER (PARTITION BY case_id, status ORDER BY position) AS g FROM stays) GROUP BY case_id, status"""))
def time_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.time_by_status(all_stays(spark, sf_dir))


@query(stays_sql("""SELECT s.case_id, s.position, s.started, s.seen_until - s.started AS spent, (SELECT p.status FROM stays p WHERE p.case_id = s.case_id AND p.position < s.position AND p.role <> 'standby' ORDER BY p.position DESC LIMIT 1) AS came_from, s.ended IS NULL AS is_open
FROM stays s WHERE s.role = 'standby'"""))
def standby_stays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.standby(all_stays(spark, sf_dir))


@query(stays_sql(f"SELECT case_id, status, role, started, {CUT} - started AS age FROM stays WHERE ended IS NULL AND role <> 'terminal'"))
def ongoing_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.ongoing(all_stays(spark, sf_dir), CUT)


_DAYS = f""", st AS (SELECT *, make_timestamp(started {LOCAL})::DATE AS d FROM stays), ce AS (SELECT case_id, min(started) AS opened, min(d) AS f, arg_max(role, position) = 'terminal' AS closed, arg_max(d, position) AS ld, arg_max(started, position) AS ls FROM st GROUP BY case_id),
cl AS (SELECT day::DATE AS day, epoch_us(day) AS m, isodow(day) < 6 AND day::DATE NOT IN ({_HOLIDAYS}) AS is_open FROM (SELECT unnest(generate_series(DATE '2023-12-25', DATE '2024-02-05', INTERVAL 1 DAY)) AS day)),
sp AS (SELECT *, unnest(generate_series(f, last_day, INTERVAL 1 DAY))::DATE AS day FROM (SELECT *, CASE WHEN closed THEN greatest(f, ld) ELSE DATE '2024-01-30' END AS last_day, CASE WHEN closed THEN ls ELSE {CUT} END AS stop FROM ce)),
wk AS (SELECT case_id, day, sum(greatest(0, least(seen_until {LOCAL}, m + w.b * 3600000000) - greatest(started {LOCAL}, m + w.a * 3600000000))) AS w FROM st JOIN cl ON is_open AND m < seen_until {LOCAL} AND m + 86400000000 > started {LOCAL} CROSS JOIN (VALUES (10, 13), (14, 19)) w(a, b) WHERE role = 'work' AND cycle IS NOT NULL GROUP BY ALL),
so AS (SELECT case_id, sp.day, sum(greatest(0, least(stop {LOCAL}, least(cl.m + w.b * 3600000000, epoch_us(sp.day) + 86400000000)) - greatest(opened {LOCAL}, cl.m + w.a * 3600000000))) AS s FROM sp JOIN cl ON is_open AND cl.day BETWEEN f AND sp.day CROSS JOIN (VALUES (10, 13), (14, 19)) w(a, b) GROUP BY ALL)"""


@query(stays_sql(f"""{_DAYS} SELECT x.case_id, x.day, (SELECT s.status FROM st s WHERE s.case_id = x.case_id AND s.d <= x.day ORDER BY s.position DESC LIMIT 1) AS status, (SELECT count(*) FROM st s WHERE s.case_id = x.case_id AND s.d <= x.day AND s.role = 'delivery') AS deliveries_to_date,
CASE WHEN NOT EXISTS (SELECT 1 FROM st s WHERE s.case_id = x.case_id AND s.d <= x.day AND s.role = 'unknown' AND s.cycle IS NOT NULL) THEN coalesce((SELECT sum(w) FROM wk WHERE wk.case_id = x.case_id AND wk.day <= x.day), 0)::BIGINT END AS worked,
coalesce(so.s, 0)::BIGINT AS since_opened, CASE WHEN closed AND x.day = last_day THEN 'closed' ELSE 'open' END AS state, cl.is_open AS is_business_day FROM sp x JOIN cl ON cl.day = x.day LEFT JOIN so ON so.case_id = x.case_id AND so.day = x.day"""))
def project_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.daily(all_stays(spark, sf_dir), SPEC, CUT)


@query(stays_sql("""SELECT case_id, to_first_delivery, round(cume_dist() OVER (ORDER BY to_first_delivery) * 100, 6) AS percent_rank, CASE WHEN to_first_delivery < 86400000000 THEN 'under a day' WHEN to_first_delivery < 604800000000 THEN 'under a week' ELSE 'a week or more' END AS band,
to_first_delivery > q.p75 + 1.5 * (q.p75 - q.p25) AS outlier FROM proj CROSS JOIN (SELECT quantile_cont(to_first_delivery::DOUBLE, 0.25) AS p25, quantile_cont(to_first_delivery::DOUBLE, 0.75) AS p75 FROM proj WHERE to_first_delivery IS NOT NULL) q WHERE to_first_delivery IS NOT NULL""", _PROJECTS))
def delivery_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.delivery_times(model.projects(all_stays(spark, sf_dir), CUT)).withColumn("percent_rank", F.round("percent_rank", 6))


_REFERENCES = _RESPONSES + f""", smp AS (SELECT status, ended - started AS v FROM stays WHERE ended IS NOT NULL AND role IN ('work', 'waiting') AND started >= {CUT - 365 * 86_400_000_000}
  UNION ALL SELECT status, ended - started FROM resp WHERE counts AND outcome <> 'waiting' AND ended IS NOT NULL AND started >= {CUT - 365 * 86_400_000_000}),
ref AS (SELECT status, count(*) AS samples, {', '.join(f"CASE WHEN count(*) >= 15 THEN round(quantile_cont(v::DOUBLE, 0.{p}), 3) END AS p{p}0" for p in (5, 8, 9))} FROM smp GROUP BY status)"""


def _references(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.references(cycles.with_responses(all_stays(spark, sf_dir), MODEL, ZONE), CUT)


@query(stays_sql("SELECT * FROM ref", _REFERENCES))
def status_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _references(spark, sf_dir)


@query(stays_sql(f"""SELECT s.case_id, s.status, {CUT} - s.started AS age, CASE WHEN p80 IS NULL THEN 'unknown' WHEN {CUT} - s.started > p90 THEN 'critical' WHEN {CUT} - s.started > p80 THEN 'attention' ELSE 'ok' END AS level
FROM stays s LEFT JOIN ref ON ref.status = s.status WHERE s.ended IS NULL AND s.role <> 'terminal'""", _REFERENCES))
def open_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.alerts(model.ongoing(all_stays(spark, sf_dir), CUT), _references(spark, sf_dir))


@query(stays_sql(f"""SELECT date_trunc('month', make_timestamp(started {LOCAL}))::DATE AS month, status, count(*) AS stays, count(ended) AS closed, round(avg((ended - started)::DOUBLE), 3) AS mean_us, round(quantile_cont((ended - started)::DOUBLE, 0.5), 3) AS median_us
FROM stays WHERE status IS NOT NULL GROUP BY 1, 2"""))
def monthly_bottlenecks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.bottlenecks(all_stays(spark, sf_dir), ZONE)


@query(stays_sql(f""", x AS (SELECT opened AS t, 'opened' AS w FROM proj UNION ALL SELECT started, 'delivered' FROM stays WHERE role = 'delivery' UNION ALL SELECT started, 'rework' FROM cyc WHERE kind = 'rework')
SELECT date_trunc('month', make_timestamp(t {LOCAL}))::DATE AS month, count_if(w = 'opened')::BIGINT AS opened, count_if(w = 'delivered')::BIGINT AS delivered, count_if(w = 'rework')::BIGINT AS rework FROM x GROUP BY 1""", _PROJECTS + _CYCLES))
def monthly_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = all_stays(spark, sf_dir)
    day = lambda c: C.local_day(F.col(c), ZONE)
    return model.by_month({"opened": (model.projects(rows, CUT), day("opened")), "delivered": (rows.filter("role = 'delivery'"), day("started")), "rework": (cycles.cycle_table(rows).filter("kind = 'rework'"), day("started"))})


@query(stays_sql("""SELECT source, count(*) AS cases FROM (SELECT case_id, CASE WHEN case_id IN (SELECT case_id FROM stays) THEN 'measured' ELSE 'no intake' END AS source FROM (SELECT DISTINCT case_id FROM iv)) GROUP BY source"""))
def case_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.coverage([("measured", all_stays(spark, sf_dir).select("case_id").distinct()), ("no intake", all_intervals(spark, sf_dir).select("case_id").distinct())])


@query(intervals_sql(f"SELECT status, role, count(*) AS uses, count_if(started >= {CUT - 365 * 86_400_000_000})::BIGINT AS uses_in_365_days, count_if(year(make_timestamp(started {LOCAL})) = 2024)::BIGINT AS uses_this_year, count(DISTINCT case_id) AS cases, min(started) AS first_use, max(started) AS last_use FROM iv WHERE status IS NOT NULL GROUP BY status, role"))
def status_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.status_dimension(all_intervals(spark, sf_dir), ZONE, CUT)


_NAMED = ", ".join(f"(DATE '{d}', '{n}')" for d, n in SPEC.named_holidays().items() if d.year == 2024)


@query(f"""SELECT day::DATE AS day, year(day) AS year, month(day) AS month, week(day) AS iso_week, isoyear(day) AS iso_year, isodow(day) AS iso_weekday, h.name AS holiday, isodow(day) < 6 AND h.name IS NULL AS is_business_day, '{SPEC.version()}' AS version
FROM (SELECT unnest(generate_series(min(ts)::DATE, max(ts)::DATE, INTERVAL 1 DAY)) AS day FROM events) LEFT JOIN (VALUES {_NAMED}) h(d, name) ON d = day::DATE""")
def calendar_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    span = read(spark, sf_dir, "events").agg(F.min("ts").cast("date").alias("a"), F.max("ts").cast("date").alias("b"))
    return model.calendar(F.col("a"), F.col("b"), span, SPEC)


@query("""SELECT DISTINCT p_partkey, trim(unnest(string_split_regex(p_name || ' / ' || p_brand || '; ' || p_type, '[,;\\n\\r+]|\\s[&/]\\s'))) AS name FROM part""")
def part_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "part").select("p_partkey", F.concat("p_name", F.lit(" / "), "p_brand", F.lit("; "), "p_type").alias("names"))
    return model.name_bridge(rows, "p_partkey", "names")


@query()
def probable_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names with their brands; every ninth lost a letter and every eleventh its brand."""
    k, name = F.col("p_partkey"), F.lower(F.concat_ws(" ", "p_name", "p_brand"))
    cut = F.concat(F.substring(name, F.lit(1), F.length(name) - 3), F.substring(name, F.length(name) - 1, F.lit(2)))
    names = read(spark, sf_dir, "part").select(F.when(k % 9 == 0, cut).when(k % 11 == 0, F.lower("p_name")).otherwise(name).alias("name"))
    return identity.probable_spellings(names.groupBy("name").agg(F.count("*").alias("uses")))


_PAIRS = """WITH o AS (SELECT s_suppkey AS id, s_nationkey AS nation, regexp_extract(s_name, '[0-9]+$') AS tail, round(s_acctbal) AS balance FROM supplier),
n AS (SELECT c_custkey AS id, c_nationkey AS nation, regexp_extract(c_name, '[0-9]+$') AS tail, round(c_acctbal) AS balance FROM customer),
few AS (SELECT nation, balance FROM (SELECT nation, balance, count(*) AS a FROM o GROUP BY ALL) JOIN (SELECT nation, balance, count(*) AS b FROM n GROUP BY ALL) USING (nation, balance) WHERE a * b <= 100),
p AS (SELECT o.id AS old_id, n.id AS new_id, 'balance' AS seed FROM o JOIN n USING (nation, balance) JOIN few USING (nation, balance) UNION ALL SELECT o.id, n.id, 'tail' FROM o JOIN n USING (tail)),
c AS (SELECT old_id, new_id, string_agg(DISTINCT seed, '+' ORDER BY seed) AS seeds FROM p GROUP BY old_id, new_id)"""


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    tail = lambda c: F.regexp_extract(c, "[0-9]+$", 0)
    old = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("nation"), tail("s_name").alias("tail"), F.round("s_acctbal").alias("balance"))
    new = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation"), tail("c_name").alias("tail"), F.round("c_acctbal").alias("balance"))
    return identity.candidate_pairs(old, new, {"tail": ["tail"], "balance": ["nation", "balance"]})


@query(_PAIRS + " SELECT * FROM c")
def identity_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir)


@query(_PAIRS + " SELECT * FROM c WHERE seeds LIKE '%tail%' QUALIFY count(*) OVER (PARTITION BY old_id) = 1 AND count(*) OVER (PARTITION BY new_id) = 1")
def identity_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.select_pairs(_pairs(spark, sf_dir), F.contains(F.col("seeds"), F.lit("tail")))


_TITLE = "CASE item_id % 5 WHEN 0 THEN ' [Internal] ' WHEN 1 THEN 'A test: ' WHEN 2 THEN '(Duplicate of a TÉMPLATE) ' ELSE '' END || text"


@query(f"""SELECT item_id, list_aggregate(list_sort(list_filter([CASE WHEN contains(t, 'test') THEN 'word:test' END, CASE WHEN contains(t, 'duplicate') THEN 'word:duplicate' END, CASE WHEN contains(t, 'template') THEN 'word:template' END, CASE WHEN starts_with(ltrim(t, '[({{ '), 'internal') THEN 'prefix:internal' END], lambda x: x IS NOT NULL)), 'string_agg', ',') AS reasons
FROM (SELECT item_id, trim(regexp_replace(strip_accents(lower({_TITLE})), '\\s+', ' ', 'g')) AS t FROM benchmark) WHERE contains(t, 'test') OR contains(t, 'duplicate') OR contains(t, 'template') OR starts_with(ltrim(t, '[({{ '), 'internal')""")
def title_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("item_id") % 5
    title = F.concat(F.when(k == 0, " [Internal] ").when(k == 1, "A test: ").when(k == 2, "(Duplicate of a TÉMPLATE) ").otherwise(""), "text")
    rows = read(spark, sf_dir, "benchmark").select("item_id", rules.title_reasons(title).alias("r"))
    return rows.filter("size(r) > 0").select("item_id", F.array_join("r", ",").alias("reasons"))


@query(intervals_sql("SELECT case_id, event_id, status FROM iv WHERE case_id NOT IN (SELECT case_id FROM iv WHERE status IS NULL)"))
def whole_case_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.whole_case_filter(all_intervals(spark, sf_dir), F.col("status").isNull()).select("case_id", "event_id", "status")


@query(intervals_sql(""", r AS (SELECT unnest(CASE WHEN len(x) = 0 THEN ['eligible'] ELSE x END) AS reason FROM (SELECT list_filter([CASE WHEN status IS NULL THEN 'no_status' END, CASE WHEN role NOT IN ('work', 'waiting') THEN 'not_measured' END, CASE WHEN ended IS NULL THEN 'open' END, CASE WHEN ended - started <= 0 THEN 'no_duration' END], lambda y: y IS NOT NULL) AS x FROM iv))
SELECT reason, count(*) AS n FROM r GROUP BY reason"""))
def kpi_eligibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = all_intervals(spark, sf_dir)
    reasons = rules.kpi_reasons(rows, ("work", "waiting"))
    return rows.select(F.explode(F.when(F.size(reasons) == 0, F.array(F.lit("eligible"))).otherwise(reasons)).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


@query("""SELECT 'negative price' AS rule, count_if(l_extendedprice < 0)::BIGINT AS n FROM lineitem UNION ALL SELECT 'discount over a tenth', count_if(l_discount > 0.1)::BIGINT FROM lineitem
UNION ALL SELECT 'null key', count_if(l_orderkey IS NULL OR l_linenumber IS NULL)::BIGINT FROM lineitem UNION ALL SELECT 'repeated key', coalesce(sum(n), 0)::BIGINT FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""")
def contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.violations(read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], {"negative price": F.col("l_extendedprice") < 0, "discount over a tenth": F.col("l_discount") > 0.1})


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey IS NOT NULL AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F')")
def orphan_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    parents = read(spark, sf_dir, "orders").filter("o_orderstatus <> 'F'")
    return quality.orphans(read(spark, sf_dir, "lineitem"), parents, {"l_orderkey": "o_orderkey"}).select("l_orderkey", "l_linenumber")


@query(" UNION ALL ".join(f"SELECT '{c}' AS name, count_if({c} IS NULL)::BIGINT AS nulls, count_if(trim({c}::VARCHAR) = '')::BIGINT AS blanks, count(DISTINCT {c}) AS n_distinct FROM orders" for c in ("o_custkey", "o_orderstatus", "o_orderpriority")))
def quality_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.profile(read(spark, sf_dir, "orders"), ["o_custkey", "o_orderstatus", "o_orderpriority"])


@query("""SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, min(epoch_us(ts)) AS first_seen FROM events GROUP BY user_id""")
def latest_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "events").withColumn("at", C.micros("ts"))
    half = F.col("ts") < F.expr("TIMESTAMP_NTZ'2024-01-16 00:00:00'")
    last = lambda df: df.groupBy("user_id").agg(F.max_by("event_type", F.struct("at", "event_id")).alias("event_type"), F.min("at").alias("first_seen"))
    return quality.upsert(last(rows.filter(half)), last(rows.filter(~half)), ["user_id"], "first_seen")


@query("""SELECT kind, count(*) AS n FROM (SELECT CASE WHEN a.c IS NULL THEN 'added' WHEN b.c IS NULL THEN 'removed' END AS kind, * FROM
(SELECT o_custkey AS c, o_orderstatus AS s, count(*) AS n FROM orders WHERE o_orderkey % 2 = 0 GROUP BY ALL) a FULL JOIN (SELECT o_custkey AS c, o_orderstatus AS s, count(*) AS n FROM orders WHERE o_orderkey % 2 = 1 GROUP BY ALL) b ON a.c = b.c AND a.s = b.s WHERE a.c IS NULL OR b.c IS NULL) GROUP BY kind
UNION ALL SELECT 'n', count(*) FROM (SELECT o_custkey AS c, o_orderstatus AS s, count_if(o_orderkey % 2 = 0) AS a, count_if(o_orderkey % 2 = 1) AS b FROM orders GROUP BY ALL) WHERE a > 0 AND b > 0 AND a <> b""")
def field_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders")
    counts = lambda odd: orders.filter(F.col("o_orderkey") % 2 == odd).groupBy("o_custkey", "o_orderstatus").agg(F.count("*").alias("n"))
    return quality.differences(counts(0), counts(1), ["o_custkey", "o_orderstatus"], ["n"])


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows of events: every seventh without an item, every eleventh with a time that can't be read, some twice."""
    rows, n = read(spark, sf_dir, "events"), F.col("event_id")
    item = F.when(n % 7 == 0, "none").otherwise(F.col("user_id").cast("string"))
    data = F.to_json(F.struct(item.alias("item"), F.struct(F.struct(F.col("event_type").alias("text")).alias("label")).alias("value")))
    data = F.when(n % 13 == 0, "{broken").otherwise(data)
    created = F.when(n % 11 == 0, "yesterday").otherwise(F.concat(C.micros("ts").cast("string"), F.lit("0")))
    raw = rows.select(n.cast("string").alias("id"), F.lit("change").alias("event"), created.alias("created_at"), data.alias("data"))
    return raw.unionByName(raw.filter("cast(id as long) % 10 = 0"))


_RAW = """WITH r AS (SELECT event_id::VARCHAR AS event_id, CASE WHEN event_id % 7 <> 0 AND event_id % 13 <> 0 THEN user_id END AS item_id, CASE WHEN event_id % 13 <> 0 THEN event_type END AS label, CASE WHEN event_id % 11 <> 0 THEN epoch_us(ts) END AS "at",
concat_ws(',', CASE WHEN event_id % 7 = 0 OR event_id % 13 = 0 THEN 'item' END, CASE WHEN event_id % 11 = 0 THEN 'time' END, CASE WHEN event_id % 13 = 0 THEN 'json' END) AS warnings FROM (SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_id % 10 = 0))"""


@query(_RAW + " SELECT * FROM r")
def typed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.typed_log(_raw(spark, sf_dir)).select("event_id", "item_id", "label", "at", "warnings")


@query(_RAW + ' SELECT count(DISTINCT event_id) AS events, count(*) - count(DISTINCT event_id) AS duplicates, count_if("at" IS NULL)::BIGINT AS bad_times, min("at") AS first_at, max("at") AS last_at FROM r')
def log_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.summary(logs.typed_log(_raw(spark, sf_dir)))


@query(_RAW + ' SELECT * FROM (SELECT DISTINCT * FROM r)')
def log_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.once(logs.typed_log(_raw(spark, sf_dir))).select("event_id", "item_id", "label", "at", "warnings")


@query("""SELECT event_id, CASE event_id % 3 WHEN 0 THEN epoch_us(ts) WHEN 1 THEN epoch_us(ts) + 10800000000 END AS "at", CASE WHEN event_id % 3 < 2 THEN strftime(make_timestamp(epoch_us(ts) + CASE event_id % 3 WHEN 1 THEN 10800000000 ELSE 0 END), '%Y-%m-%dT%H:%M:%S.%fZ') END AS text FROM events""")
def zoned_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with Z, with an offset, and without a zone; the last are no instants."""
    k, wall = F.col("event_id") % 3, F.col("ts").cast("string")
    text = F.concat(F.regexp_replace(wall, " ", "T"), F.when(k == 0, "Z").when(k == 1, "-03:00").otherwise(""))
    rows = read(spark, sf_dir, "events").select("event_id", C.zoned_micros(text).alias("at"))
    return rows.withColumn("text", C.iso_text(F.col("at")))


@query("""SELECT state, count(*) AS n FROM (SELECT CASE WHEN v IS NULL THEN 'missing' WHEN len(v) > 1 THEN 'conflict' WHEN list_contains(v, b.value) THEN 'agrees' ELSE 'differs' END AS state
FROM (SELECT user_id AS action, event_id % 10 AS item, (props->>'$.k')::BIGINT % 2 AS value FROM events WHERE event_type = 'view') b
LEFT JOIN (SELECT user_id AS action, event_id % 10 AS item, list(DISTINCT (props->>'$.k')::BIGINT % 2) AS v FROM events WHERE event_type = 'click' GROUP BY ALL) s USING (action, item)) GROUP BY state""")
def batch_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "events").select("event_type", F.col("user_id").alias("action"), (F.col("event_id") % 10).alias("item"), (F.get_json_object("props", "$.k").cast("long") % 2).alias("value"))
    return quality.batch_audit(rows.filter("event_type = 'view'").drop("event_type"), rows.filter("event_type = 'click'").drop("event_type"))


_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


@query(f"""SELECT c_custkey, sha256(coalesce(c_name, 'None') || '|' || coalesce(c_mktsegment, 'None')) AS sha_key FROM customer""")
def text_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").select("c_custkey", C.sha_key(F.col("c_name"), F.col("c_mktsegment")).alias("sha_key"))


@query()
def name_uuids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").select("c_custkey", C.uuid5(_NAMESPACE, F.col("c_name")).alias("uuid"))


@query("SELECT item_id, trim(regexp_replace(trim(regexp_replace(strip_accents(lower(text)), '\\s+', ' ', 'g')), '[^0-9a-z]+', ' ', 'g')) AS key FROM benchmark")
def catalogue_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "benchmark").select("item_id", C.catalogue_key(F.col("text")).alias("key"))


@query("""SELECT page_id, CASE WHEN lower(regexp_extract(url, '^([A-Za-z]+)://', 1)) IN ('http', 'https') AND regexp_extract(url, '^[A-Za-z]+://([^/?#]*)', 1) <> '' THEN lower(regexp_extract(url, '^([A-Za-z]+)://', 1)) || '://' || lower(regexp_extract(url, '^[A-Za-z]+://([^/?#]*)', 1)) || regexp_extract(url, '^[A-Za-z]+://[^/?#]*(.*)$', 1) END AS url FROM pages""")
def page_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "pages").select("page_id", C.normal_url(F.col("url")).alias("url"))


@query()
def table_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.fingerprint(read(spark, sf_dir, "orders"))


@query(intervals_sql("SELECT status, coalesce(nxt, '-') AS next_status, count(*) AS n FROM (SELECT status, lead(status) OVER (PARTITION BY case_id ORDER BY position) AS nxt FROM iv) GROUP BY 1, 2"))
def transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_intervals(spark, sf_dir).select("status", F.coalesce(F.lead("status").over(intervals.in_order()), F.lit("-")).alias("next_status")).groupBy("status", "next_status").agg(F.count("*").alias("n"))


@query(stays_sql(f"SELECT case_id, status, {CUT} - started AS age FROM stays WHERE ended IS NULL AND role <> 'terminal' ORDER BY age DESC, case_id LIMIT 20"))
def oldest_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.ongoing(all_stays(spark, sf_dir), CUT).select("case_id", "status", "age").orderBy(F.desc("age"), "case_id").limit(20)


@query(intervals_sql(f"SELECT date_trunc('week', make_timestamp(started {LOCAL}))::DATE AS week, role, count(*) AS stays, count(DISTINCT case_id) AS cases FROM iv GROUP BY 1, 2"))
def weekly_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    week = F.date_trunc("week", C.local_day(F.col("started"), ZONE)).cast("date")
    return all_intervals(spark, sf_dir).groupBy(week.alias("week"), "role").agg(F.count("*").alias("stays"), F.count_distinct("case_id").alias("cases"))


@query("""SELECT c_mktsegment AS segment, count(*) AS orders, count(DISTINCT o_custkey) AS customers, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS share FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY c_mktsegment""")
def demand_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = read(spark, sf_dir, "orders").join(read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count("*").alias("orders"), F.count_distinct("o_custkey").alias("customers"))
    return got.withColumn("share", F.round(F.col("orders") * 100.0 / F.sum("orders").over(Window.partitionBy()), 6))


@query(intervals_sql("SELECT case_id, count(DISTINCT account) AS accounts, count_if(account = 'A')::BIGINT AS stays_a, count_if(account = 'B')::BIGINT AS stays_b FROM iv GROUP BY case_id HAVING count(*) > 1"))
def account_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_intervals(spark, sf_dir).groupBy("case_id").agg(F.count("*").alias("n"), F.count_distinct("account").alias("accounts"), F.count_if(F.col("account") == "A").alias("stays_a"), F.count_if(F.col("account") == "B").alias("stays_b")).filter("n > 1").drop("n")


@query(stays_sql("""SELECT case_id, string_agg(coalesce(status, '-'), ' > ' ORDER BY position) AS path FROM iv WHERE case_id NOT IN (SELECT case_id FROM stays) GROUP BY case_id"""))
def paths_without_intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = all_intervals(spark, sf_dir).join(all_stays(spark, sf_dir).select("case_id").distinct(), "case_id", "left_anti")
    steps = F.array_sort(F.collect_list(F.struct("position", F.coalesce("status", F.lit("-")).alias("s"))))
    return rest.groupBy("case_id").agg(F.array_join(F.transform(steps, lambda x: x["s"]), " > ").alias("path"))


@query(intervals_sql("""SELECT (SELECT count(DISTINCT case_id) FROM iv) AS cases, (SELECT count(*) FROM iv) AS stays, (SELECT count(*) FROM iv WHERE status IS NULL) AS blanks, (SELECT count(*) FROM iv WHERE ended IS NULL) AS open_stays, (SELECT count(*) FROM events) AS events"""))
def trust_scoreboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = all_intervals(spark, sf_dir).agg(F.count_distinct("case_id").alias("cases"), F.count("*").alias("stays"), F.count_if(F.col("status").isNull()).alias("blanks"), F.count_if(F.col("ended").isNull()).alias("open_stays"))
    return a.crossJoin(read(spark, sf_dir, "events").agg(F.count("*").alias("events")))  # one row each

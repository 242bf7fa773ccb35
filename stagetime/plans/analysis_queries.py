"""Registered queries of analysis: waits, people, brands, cohorts, measures, destinations, errors, checks and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import audits, cycles, intervals, model, portfolio, quantiles
from .binding import CUT, MODEL, SPEC, events_sql, intervals_sql, read, status_events, stays_sql
from .binding import intervals as all_intervals
from .binding import stays as all_stays
from .evidence_queries import _LIVE, _TWO, _two_accounts, live_stays
from .queries import _CYCLES, _HOLIDAYS, _RESPONSES, LOCAL, ZONE, _pairs, _responses, query

DAY = C.DAY


def _spent() -> F.Column:
    return (F.col("ended") - F.col("started")).cast("double")


def _mean(c: str, name: str) -> F.Column:
    return F.round(F.avg(F.col(c).cast("double")), 3).alias(name)


# --- questions about waits, people and brands -----------------------------------------------------


@query(events_sql(_LIVE + " SELECT role, provenance, count(*) AS stays, count(DISTINCT case_id) AS cases, sum(spent)::BIGINT AS spent, round(avg(spent::DOUBLE), 3) AS mean_us FROM lv WHERE role IN ('waiting', 'standby', 'delivery') GROUP BY ALL"))
def waits_by_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = live_stays(spark, sf_dir).filter(F.col("role").isin("waiting", "standby", "delivery"))
    return rows.groupBy("role", "provenance").agg(F.count("*").alias("stays"), F.count_distinct("case_id").alias("cases"), F.sum("spent").alias("spent"), _mean("spent", "mean_us"))


@query(stays_sql("""SELECT person, status, count(*) AS stays, count(DISTINCT case_id) AS cases, round(avg((ended - started)::DOUBLE), 3) AS mean_us FROM
(SELECT *, unnest(list_distinct(['person ' || case_id // 10 % 23, 'person ' || case_id // 10 % 7])) AS person FROM stays WHERE role = 'work' AND ended IS NOT NULL) GROUP BY person, status HAVING count(*) >= 3"""))
def people_in_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stay counts for each of its people, so the rows don't add up."""
    user = F.floor(F.col("case_id") / 10)
    people = F.array_distinct(F.array(*[F.concat(F.lit("person "), (user % n).cast("string")) for n in (23, 7)]))
    rows = all_stays(spark, sf_dir).filter("role = 'work' and ended is not null").select("case_id", "status", _spent().alias("spent"), F.explode(people).alias("person"))
    return rows.groupBy("person", "status").agg(F.count("*").alias("stays"), F.count_distinct("case_id").alias("cases"), _mean("spent", "mean_us")).filter("stays >= 3")


def _brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user, brand: what a case's register says."""
    return read(spark, sf_dir, "customer").select((F.col("c_custkey") - 1).alias("user"), F.col("c_mktsegment").alias("brand"))


_BRAND = "JOIN (SELECT c_custkey - 1 AS u, c_mktsegment AS brand FROM customer) ON u = case_id // 10"


@query(stays_sql(f"""SELECT brand, count(*) AS responses, round(quantile_cont(waited::DOUBLE, 0.5), 3) AS median_us, round(quantile_cont(waited::DOUBLE, 0.9), 3) AS p90_us,
CASE WHEN count(*) < 5 THEN 'few' WHEN count(*) < 30 THEN 'some' ELSE 'many' END AS sample FROM resp {_BRAND} WHERE counts AND waited IS NOT NULL GROUP BY brand""", _RESPONSES))
def brand_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _responses(spark, sf_dir).filter("counts and waited is not null").withColumn("user", F.floor(F.col("case_id") / 10)).join(_brands(spark, sf_dir), "user")
    got = quantiles.quantiles(rows, ("brand",), F.col("waited"), {"median_us": 0.5, "p90_us": 0.9}).withColumnRenamed("n", "responses")
    return got.withColumn("sample", F.when(F.col("responses") < 5, "few").when(F.col("responses") < 30, "some").otherwise("many"))


@query(stays_sql(f"SELECT date_trunc('month', make_timestamp(started {LOCAL}))::DATE AS month, kind, count(*) AS cycles, count_if(state = 'delivered')::BIGINT AS delivered, count_if(state = 'open')::BIGINT AS still_open FROM cyc GROUP BY 1, 2", _CYCLES))
def cycle_cohorts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cycles.cycle_table(all_stays(spark, sf_dir)).withColumn("month", F.trunc(C.local_day(F.col("started"), ZONE), "month"))
    return rows.groupBy("month", "kind").agg(F.count("*").alias("cycles"), F.count_if(F.col("state") == "delivered").alias("delivered"), F.count_if(F.col("state") == "open").alias("still_open"))


@query(stays_sql(f"""SELECT date_trunc('month', make_timestamp(started {LOCAL}))::DATE AS month, count(*) AS deliveries, count(DISTINCT case_id) AS cases, min(case_id * 1000 + position) AS first_link FROM stays WHERE role = 'delivery' GROUP BY 1"""))
def deliveries_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = all_stays(spark, sf_dir).filter("role = 'delivery'").withColumn("month", F.trunc(C.local_day(F.col("started"), ZONE), "month"))
    return rows.groupBy("month").agg(F.count("*").alias("deliveries"), F.count_distinct("case_id").alias("cases"), F.min(F.col("case_id") * 1000 + F.col("position")).alias("first_link"))


@query(intervals_sql("""SELECT status, count(*) AS permanences, sum(n)::BIGINT AS stays, round(avg((t - s)::DOUBLE), 3) AS mean_us FROM (SELECT case_id, status, count(*) AS n, min(started) AS s, max(seen_until) AS t
FROM (SELECT *, position - row_number() OVER (PARTITION BY case_id, status ORDER BY position) AS g FROM iv) GROUP BY case_id, status, g) GROUP BY status"""))
def permanence_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = intervals.permanences(all_intervals(spark, sf_dir)).withColumn("spent", F.col("seen_until") - F.col("started"))
    return rows.groupBy("status").agg(F.count("*").alias("permanences"), F.sum("stays").alias("stays"), _mean("spent", "mean_us"))


# --- measures -------------------------------------------------------------------------------------


@query(intervals_sql("""SELECT count(DISTINCT case_id) AS cases, count(*) AS stays, count_if(visit > 1)::BIGINT AS returns, count_if(ended IS NULL AND role NOT IN ('terminal', 'delivery'))::BIGINT AS queue,
count(DISTINCT status) AS statuses, round(quantile_cont((ended - started)::DOUBLE, 0.5), 3) AS median_us, round(quantile_cont((ended - started)::DOUBLE, 0.95), 3) AS p95_us FROM iv"""))
def headline_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = all_intervals(spark, sf_dir)
    got = rows.agg(F.count_distinct("case_id").alias("cases"), F.count("*").alias("stays"), F.count_if(F.col("visit") > 1).alias("returns"), F.count_if(F.col("ended").isNull() & ~F.col("role").isin("terminal", "delivery")).alias("queue"), F.count_distinct("status").alias("statuses"))
    return got.crossJoin(quantiles.quantiles(rows, (), _spent(), {"median_us": 0.5, "p95_us": 0.95}).drop("n"))  # one row each


@query(intervals_sql("""SELECT status, count(*) AS stays, round(sum(ended - started) * 100.0::DOUBLE / sum(sum(ended - started)) OVER (), 6) AS exposure, round(quantile_cont((ended - started)::DOUBLE, 0.5), 3) AS p50,
round(quantile_cont((ended - started)::DOUBLE, 0.9), 3) AS p90 FROM iv WHERE ended IS NOT NULL GROUP BY status"""))
def stage_exposure(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = all_intervals(spark, sf_dir).filter("ended is not null")
    got = rows.groupBy("status").agg(F.count("*").alias("stays"), F.sum(F.col("ended") - F.col("started")).alias("_t"))
    whole = rows.agg(F.sum(F.col("ended") - F.col("started")).alias("_all"))
    shares = got.crossJoin(whole).select("status", "stays", F.round(F.col("_t") * 100.0 / F.col("_all"), 6).alias("exposure"))  # one row
    return quantiles.with_quantiles(shares, rows, ("status",), _spent(), {"p50": 0.5, "p90": 0.9})


@query(events_sql(_LIVE + " SELECT role, count(*) AS stays, count_if(provenance = 'estimated')::BIGINT AS estimated, round(count_if(provenance = 'estimated') * 100.0::DOUBLE / count(*), 6) AS share FROM lv GROUP BY role"))
def estimated_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = live_stays(spark, sf_dir).groupBy("role").agg(F.count("*").alias("stays"), F.count_if(F.col("provenance") == "estimated").alias("estimated"))
    return got.withColumn("share", F.round(F.col("estimated") * 100.0 / F.col("stays"), 6))


@query(intervals_sql(f"""SELECT case_id, event_id, status, isodow(make_timestamp(started {LOCAL})) AS weekday, hour(make_timestamp(started {LOCAL})) AS hour, CASE WHEN ended IS NOT NULL AND status IS NOT NULL THEN ended - started END AS label FROM iv WHERE position > 1"""))
def prediction_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is known at a stay's start, with a label only where its end was seen."""
    wall = C.local_micros(F.col("started"), ZONE)
    rows = all_intervals(spark, sf_dir).filter("position > 1")
    return rows.select("case_id", "event_id", "status", (F.weekday(C.local_day(F.col("started"), ZONE)) + 1).alias("weekday"), F.floor(F.pmod(wall, F.lit(DAY)) / C.HOUR).alias("hour"), F.when(F.col("status").isNotNull(), F.col("ended") - F.col("started")).alias("label"))


@query(events_sql(_LIVE + " SELECT status, provenance, count(*) AS stays, count(spent) AS known, round(avg(spent::DOUBLE), 3) AS mean_us FROM lv WHERE role <> 'terminal' GROUP BY ALL"))
def unified_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return live_stays(spark, sf_dir).filter("role <> 'terminal'").groupBy("status", "provenance").agg(F.count("*").alias("stays"), F.count("spent").alias("known"), _mean("spent", "mean_us"))


@query(stays_sql("""SELECT p.case_id, p.opened, c1.closed AS first_closed, c1.worked AS first_worked, r.waited AS first_wait, (SELECT count(*) FROM cyc WHERE cyc.case_id = p.case_id AND kind = 'rework') AS reworks
FROM (SELECT case_id, min(started) AS opened FROM stays GROUP BY case_id) p LEFT JOIN cyc c1 ON c1.case_id = p.case_id AND c1.cycle = 1
LEFT JOIN (SELECT case_id, arg_min(coalesce(waited, -1), position) AS w FROM resp GROUP BY case_id) f ON f.case_id = p.case_id LEFT JOIN (SELECT case_id, CASE WHEN arg_min(coalesce(waited, -1), position) >= 0 THEN arg_min(coalesce(waited, -1), position) END AS waited FROM resp GROUP BY case_id) r ON r.case_id = p.case_id""", _CYCLES + _RESPONSES))
def end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = all_stays(spark, sf_dir)
    table = cycles.cycle_table(rows).groupBy("case_id").agg(F.max(F.when(F.col("cycle") == 1, F.col("closed"))).alias("first_closed"), F.max(F.when(F.col("cycle") == 1, F.col("worked"))).alias("first_worked"), F.count_if(F.col("kind") == "rework").alias("reworks"))
    first = _responses(spark, sf_dir).groupBy("case_id").agg(F.min_by(F.struct("waited"), "position").alias("r"))
    got = rows.groupBy("case_id").agg(F.min("started").alias("opened")).join(table, "case_id", "left").join(first, "case_id", "left")
    return got.select("case_id", "opened", "first_closed", "first_worked", F.col("r.waited").alias("first_wait"), F.coalesce("reworks", F.lit(0).cast("long")).alias("reworks"))


# --- classes, destinations, errors ----------------------------------------------------------------

_CLASSES = _LIVE + f""", lb AS (SELECT case_id, event_id, sum(greatest(0, least(ended {LOCAL}, d + w.b * 3600000000) - greatest(started {LOCAL}, d + w.a * 3600000000)))::BIGINT AS bh
  FROM (SELECT case_id, event_id, started, ended, unnest(range((started {LOCAL}) // 86400000000, (ended {LOCAL}) // 86400000000 + 1)) * 86400000000 AS d FROM lv WHERE ended IS NOT NULL) CROSS JOIN (VALUES (10, 13), (14, 19)) w(a, b)
  WHERE isodow(make_timestamp(d)) < 6 AND make_timestamp(d)::DATE NOT IN ({_HOLIDAYS}) GROUP BY case_id, event_id),
kc AS (SELECT lv.*, CASE WHEN ended IS NOT NULL THEN coalesce(bh, 0) END AS bh, concat_ws(',', CASE WHEN status IS NULL THEN 'no_status' END, CASE WHEN role NOT IN ('work', 'waiting') THEN 'role_is_not_measured' END, CASE WHEN ended IS NULL THEN 'not_closed' END,
  CASE WHEN provenance = 'prefix' THEN 'before_start' END, CASE WHEN provenance NOT IN ('observed', 'prefix') THEN 'not_observed' END, CASE WHEN ended < started THEN 'ends_before_it_starts' END,
  CASE WHEN spent <> ended - started THEN 'duration_differs' END, CASE WHEN no_continuity THEN 'issue:no_continuity' END, CASE WHEN unknown_status THEN 'issue:unknown_status' END, CASE WHEN no_duration THEN 'issue:no_duration' END) AS reasons FROM lv LEFT JOIN lb USING (case_id, event_id)),
kk AS (SELECT *, CASE WHEN reasons = '' THEN 'approved' WHEN role = 'terminal' THEN 'closing' WHEN ended IS NULL THEN 'no_exit_observed' ELSE 'insufficient' END AS class FROM kc)"""


def _classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portfolio.kpi_classes(live_stays(spark, sf_dir), C.business_micros(F.col("started"), F.col("ended"), SPEC))


@query(events_sql(_CLASSES + " SELECT case_id, event_id, status, account, class, reasons, CASE WHEN class = 'approved' THEN bh END AS measure FROM kk"))
def stage_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classes(spark, sf_dir)


@query(events_sql(_CLASSES + " SELECT account, class, count(*) AS stays, count(DISTINCT case_id) AS cases, sum(CASE WHEN class = 'approved' THEN bh END)::BIGINT AS measure FROM kk GROUP BY ALL"))
def class_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classes(spark, sf_dir).groupBy("account", "class").agg(F.count("*").alias("stays"), F.count_distinct("case_id").alias("cases"), F.sum("measure").alias("measure"))


_PUBLIC = _LIVE + """, pb AS (SELECT case_id, event_id, status, CASE WHEN provenance <> 'prefix' THEN started END AS started, CASE WHEN provenance = 'observed' THEN ended END AS ended,
  CASE WHEN provenance = 'observed' THEN spent END AS spent, lead(event_id) OVER (PARTITION BY case_id ORDER BY lv.started, event_id) IS NULL AS is_last FROM lv)"""


@query(events_sql(_PUBLIC + " SELECT * FROM pb"))
def public_stays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portfolio.public_stays(live_stays(spark, sf_dir))


@query(events_sql(_PUBLIC + """ SELECT 'negative' AS rule, count_if(spent < 0)::BIGINT AS n FROM pb UNION ALL SELECT 'end without start', count_if(ended IS NOT NULL AND started IS NULL)::BIGINT FROM pb UNION ALL SELECT 'hidden start', count_if(started IS NULL)::BIGINT FROM pb
UNION ALL SELECT 'null key', count_if(case_id IS NULL OR event_id IS NULL)::BIGINT FROM pb UNION ALL SELECT 'repeated key', coalesce(sum(n), 0)::BIGINT FROM (SELECT count(*) AS n FROM pb GROUP BY case_id, event_id HAVING count(*) > 1)"""))
def public_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.quality import violations

    rules = {"negative": F.col("spent") < 0, "end without start": F.col("ended").isNotNull() & F.col("started").isNull(), "hidden start": F.col("started").isNull()}
    return violations(public_stays(spark, sf_dir), ["case_id", "event_id"], rules)


_DESTINATIONS = _TWO + f""", tq AS (SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY started, event_id) AS position, lag(ended) OVER w AS pe, lag(account) OVER w AS pa FROM ta WINDOW w AS (PARTITION BY case_id ORDER BY started, event_id)),
tf AS (SELECT case_id, min(position) AS f, arg_min(status, position) AS fs FROM tq WHERE status IS NOT NULL GROUP BY case_id),
reg AS (SELECT c AS case_id, status AS cs FROM tw WHERE status IS NOT NULL AND event_id % 2 = 0 QUALIFY row_number() OVER (PARTITION BY c ORDER BY "at" DESC, event_id DESC) = 1),
dg AS (SELECT tq.case_id, count(*) AS stays, count_if(position >= f) AS n, any_value(fs) AS fs, bool_or(coalesce(position >= f AND role = 'unknown', false)) AS u, bool_or(coalesce(position > f AND pe IS DISTINCT FROM started, false)) AS g,
  bool_or(coalesce(position > f AND pa <> account, false)) AS m, bool_or(ended IS NULL) AS o, max(started) AS l FROM tq LEFT JOIN tf USING (case_id) GROUP BY tq.case_id),
dr AS (SELECT dg.*, concat_ws(',', CASE WHEN fs IS NULL THEN 'no_known_status' END, CASE WHEN fs <> 'Intake' THEN 'first_is_not_intake' END, CASE WHEN u THEN 'unknown_after_start' END, CASE WHEN g THEN 'gap_or_overlap' END, CASE WHEN m THEN 'account_change' END,
  CASE WHEN n = 1 AND fs = 'Intake' AND NOT u AND NOT o THEN 'intake_ended_without_next' END, CASE WHEN n = 1 AND fs = 'Intake' AND NOT u AND o AND cs IS DISTINCT FROM 'Intake' THEN 'register_differs' END) AS reasons FROM dg LEFT JOIN reg USING (case_id)),
ds AS (SELECT case_id, stays, CASE WHEN reasons <> '' THEN 'quality' WHEN n = 1 THEN 'queue' ELSE 'measured' END AS destination, reasons, CASE WHEN reasons = '' AND n = 1 THEN {CUT} - l END AS waited FROM dr)"""


def _destinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _two_accounts(spark, sf_dir).withColumn("position", F.row_number().over(intervals.in_order()))
    case = F.col("user_id") * 4 + F.floor(F.pmod(F.floor(F.col("at") / C.HOUR), F.lit(24)) / 6)
    seen = status_events(spark, sf_dir).filter(f"at < {CUT} and status is not null and event_id % 2 = 0").select(case.alias("case_id"), "at", "event_id", "status")
    register = seen.groupBy("case_id").agg(F.max_by("status", F.struct("at", "event_id")).alias("current_status"))
    return portfolio.destinations(rows, register, MODEL.intake, CUT)


@query(events_sql(_DESTINATIONS + " SELECT * FROM ds"))
def case_destinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _destinations(spark, sf_dir)


@query(events_sql(_DESTINATIONS + " SELECT destination, count(*) AS cases, sum(stays)::BIGINT AS stays, (SELECT count(*) FROM ta) AS all_stays FROM ds GROUP BY destination"))
def destination_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = _destinations(spark, sf_dir).groupBy("destination").agg(F.count("*").alias("cases"), F.sum("stays").alias("stays"))
    return got.crossJoin(_two_accounts(spark, sf_dir).agg(F.count("*").alias("all_stays")))  # one row


@query(events_sql(_DESTINATIONS + " SELECT reason, count(*) AS cases FROM (SELECT unnest(string_split(reasons, ',')) AS reason FROM ds WHERE reasons <> '') GROUP BY reason"))
def quality_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _destinations(spark, sf_dir).filter("reasons <> ''").select(F.explode(F.split("reasons", ",")).alias("reason")).groupBy("reason").agg(F.count("*").alias("cases"))


@query(stays_sql("""SELECT case_id, CASE WHEN r = '' THEN 'complete' ELSE 'partial' END AS state, r AS reasons FROM (SELECT case_id, concat_ws(',', CASE WHEN bool_or(ended IS NULL AND role <> 'terminal') THEN 'open_stay' END, CASE WHEN bool_or(role = 'unknown') THEN 'unknown_status' END) AS r FROM stays GROUP BY case_id)
UNION ALL SELECT case_id, 'not_measured', concat_ws(',', CASE WHEN bool_or(status IS NULL) THEN 'blank_status' END, CASE WHEN NOT bool_or(status = 'Intake') OR bool_or(status = 'Intake') IS NULL THEN 'never_intake' END, 'no_intake_first') FROM iv WHERE case_id NOT IN (SELECT case_id FROM stays) GROUP BY case_id"""))
def quality_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portfolio.quality_states(all_intervals(spark, sf_dir), MODEL.intake)


_ERRORS = _RESPONSES + """, ke AS (SELECT case_id, min(position) AS p FROM iv WHERE role <> 'unknown' GROUP BY case_id), ks AS (SELECT iv.*, ke.p, (SELECT f.status FROM iv f WHERE f.case_id = iv.case_id AND f.position = ke.p) AS fs,
  EXISTS (SELECT 1 FROM iv l WHERE l.case_id = iv.case_id AND l.position > iv.position AND l.role <> 'terminal') AS later FROM iv LEFT JOIN ke ON ke.case_id = iv.case_id),
er AS (SELECT case_id, CASE WHEN position = coalesce(p, 1) AND fs IS DISTINCT FROM 'Intake' THEN 'starts_without_intake' WHEN fs = 'Intake' AND position >= p AND role = 'terminal' AND later THEN 'terminal_in_middle'
  WHEN fs = 'Intake' AND position >= p AND role = 'unknown' THEN 'status_without_label' END AS rule, status, started AS "at" FROM ks),
ea AS (SELECT DISTINCT * FROM (SELECT * FROM er WHERE rule IS NOT NULL UNION ALL SELECT case_id, 'response_not_recorded', status, started FROM resp WHERE outcome = 'closed_automatically'))"""


@query(stays_sql("""SELECT sha256(case_id || '|' || rule || '|' || coalesce(status, 'None') || '|' || "at") AS error_id, * FROM ea""", _ERRORS))
def case_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portfolio.case_errors(all_intervals(spark, sf_dir), _responses(spark, sf_dir), MODEL.intake)


_MARKS = ("adjusted", "new scope", "option")
_COPIES = """WITH i AS (SELECT p_partkey AS item, p_partkey % 7 = 0 AS is_copy, trim(regexp_replace(trim(lower(p_name || ' ' || p_brand)), '\\s+', ' ', 'g')) AS base FROM part),
o AS (SELECT base, count(*) AS originals, min(item) AS one FROM i WHERE NOT is_copy GROUP BY base)"""


@query(_COPIES + " SELECT i.item, i.base, CASE WHEN originals = 1 THEN one END AS related, coalesce(originals, 0) AS originals FROM i LEFT JOIN o USING (base) WHERE is_copy")
def related_originals(spark: SparkSession, sf_dir: str) -> DataFrame:
    mark = F.when(F.col("p_partkey") % 3 == 0, " [Adjusted 2]").when(F.col("p_partkey") % 3 == 1, " (new scope: more)").otherwise("")
    items = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("item"), F.concat("p_name", F.lit(" "), "p_brand", mark).alias("name"), (F.col("p_partkey") % 7 == 0).alias("is_copy"))
    return portfolio.related_originals(items, _MARKS)


@query(events_sql(""", n AS (SELECT *, lag(status) OVER w AS was, row_number() OVER w AS rn FROM bound WINDOW w AS (PARTITION BY case_id ORDER BY "at", event_id)), c AS (SELECT *, CASE WHEN event_id % 11 = 0 THEN 'Drafting' ELSE was END AS previous FROM n WHERE rn > 1)
SELECT case_id, event_id, previous, was FROM c WHERE previous IS DISTINCT FROM was"""))
def chain_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = status_events(spark, sf_dir)
    claimed = F.when(F.col("event_id") % 11 == 0, "Drafting").otherwise(F.lag("status").over(intervals.by_case().orderBy("at", "event_id")))
    return portfolio.chain_breaks(rows.withColumn("previous", claimed))


@query(intervals_sql(""", rg AS (SELECT c_custkey * 10 AS case_id, CASE c_nationkey % 4 WHEN 0 THEN 'Drafting' WHEN 1 THEN 'Closed' WHEN 2 THEN 'Intake' END AS status, c_acctbal > 0 AS active FROM customer),
li AS (SELECT case_id, status AS ls FROM iv QUALIFY row_number() OVER (PARTITION BY case_id ORDER BY position DESC) = 1)
SELECT case_id, unnest(list_filter([CASE WHEN li.case_id IS NULL THEN 'no_history' END, CASE WHEN rg.status IS NULL THEN 'blank' END, CASE WHEN li.case_id IS NOT NULL AND rg.status IS NOT NULL AND ls IS DISTINCT FROM rg.status THEN 'differs' END, CASE WHEN NOT active THEN 'inactive' END], lambda x: x IS NOT NULL)) AS issue
FROM (SELECT rg.case_id AS case_id, rg.status, rg.active FROM rg) rg LEFT JOIN li USING (case_id)""".replace("li.case_id IS NULL", "ls0 IS NULL").replace("li.case_id IS NOT NULL", "ls0 IS NOT NULL").replace("SELECT case_id, status AS ls FROM iv", "SELECT case_id, status AS ls, 1 AS ls0 FROM iv")))
def register_divergences(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("c_nationkey") % 4
    register = read(spark, sf_dir, "customer").select((F.col("c_custkey") * 10).alias("case_id"), F.when(kind == 0, "Drafting").when(kind == 1, "Closed").when(kind == 2, "Intake").alias("status"), (F.col("c_acctbal") > 0).alias("active"))
    return portfolio.divergences(register, all_intervals(spark, sf_dir))


@query(intervals_sql(f""", ch AS (SELECT "at" FROM bound WHERE event_type = 'error' AND k % 5 = 0 AND event_id % 4 = 0)
SELECT case_id, event_id, count(*) AS changes, min("at") AS first_change FROM iv JOIN ch ON ch."at" >= started AND (ended IS NULL OR ch."at" < ended) AND ch."at" < {CUT} GROUP BY case_id, event_id"""))
def changes_within_stays(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = status_events(spark, sf_dir).filter("event_type = 'error' and k % 5 = 0 and event_id % 4 = 0")
    return portfolio.changes_within(all_intervals(spark, sf_dir), changes, CUT)


# --- checks and reports ---------------------------------------------------------------------------


@query(intervals_sql(f""", nx AS (SELECT *, lead(started) OVER (PARTITION BY case_id ORDER BY started, event_id) AS nx FROM iv), ca AS (SELECT case_id, count(*) AS n, max(position) AS top, count_if(ended IS NULL) AS o, sum(seen_until - started) AS s, max(seen_until) - min(started) AS sp,
  count_if(ended IS DISTINCT FROM nx) AS b, count_if(ended < started) AS neg FROM nx GROUP BY case_id),
dy AS (SELECT case_id, sum(least(seen_until {LOCAL}, d + 86400000000) - greatest(started {LOCAL}, d)) AS t FROM (SELECT *, unnest(range((started {LOCAL}) // 86400000000, (seen_until - 1 {LOCAL}) // 86400000000 + 1)) * 86400000000 AS d FROM iv WHERE seen_until > started) GROUP BY case_id)
SELECT unnest(['sequence', 'continuity', 'several open', 'negative', 'span', 'days']) AS "check", unnest([count_if(top <> n), count_if(b > 0), count_if(o > 1), count_if(neg > 0), count_if(s <> sp), count_if(coalesce(t, 0) <> s)])::BIGINT AS n FROM ca LEFT JOIN dy USING (case_id)"""))
def stay_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.stay_checks(all_intervals(spark, sf_dir), ZONE)


@query(stays_sql("""SELECT 'totals' AS "check", count_if(c.stays IS DISTINCT FROM s.n OR c.started IS DISTINCT FROM s.st)::BIGINT AS n FROM cyc c FULL JOIN (SELECT case_id, cycle, count(*) AS n, min(started) AS st FROM stays WHERE cycle IS NOT NULL GROUP BY ALL) s USING (case_id, cycle)
UNION ALL SELECT 'order', count_if(closed < started)::BIGINT FROM cyc UNION ALL SELECT 'numbers', count_if(n <> top)::BIGINT FROM (SELECT count(*) AS n, max(cycle) AS top FROM cyc GROUP BY case_id)""", _CYCLES))
def cycle_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = all_stays(spark, sf_dir)
    return audits.cycle_checks(rows, cycles.cycle_table(rows))


@query(stays_sql("SELECT accounts, state, count(*) AS cases FROM (SELECT case_id, string_agg(DISTINCT account, '+' ORDER BY account) AS accounts, CASE WHEN bool_or(ended IS NULL AND role <> 'terminal') THEN 'open' ELSE 'ended' END AS state FROM stays GROUP BY case_id) GROUP BY ALL"))
def origin_crosstab(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = all_stays(spark, sf_dir).groupBy("case_id").agg(F.array_join(F.array_sort(F.collect_set("account")), "+").alias("accounts"), F.bool_or(F.col("ended").isNull() & (F.col("role") != "terminal")).alias("o"))
    return got.groupBy("accounts", F.when(F.col("o"), "open").otherwise("ended").alias("state")).agg(F.count("*").alias("cases"))


_OVERLAP = 2 * DAY
_MARK = 1_705_708_800_000_000  # 2024-01-20 UTC


@query(events_sql(f""", st AS (SELECT event_id, "at", event_type, CASE WHEN event_id % 50 = 0 THEN k + 1 ELSE k END AS k FROM bound WHERE "at" < {_MARK} AND event_id % 13 <> 0)
SELECT state, count(*) AS n FROM (SELECT CASE WHEN st.event_id IS NULL THEN 'new' WHEN st.k = b.k AND st.event_type = b.event_type THEN 'same' ELSE 'changed' END AS state FROM bound b LEFT JOIN st USING (event_id) WHERE b."at" >= (SELECT max("at") FROM st) - {_OVERLAP}) GROUP BY state"""))
def increment_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = status_events(spark, sf_dir).select("event_id", "at", "event_type", "k")
    stored = source.filter(f"at < {_MARK} and event_id % 13 <> 0").withColumn("k", F.when(F.col("event_id") % 50 == 0, F.col("k") + 1).otherwise(F.col("k")))
    return audits.increments(stored, source, _OVERLAP, "event_id", ["event_type", "k"])


@query(events_sql(f"""SELECT account, count(*) AS events, min("at") AS first_at FROM bound WHERE "at" >= {_MARK} GROUP BY account"""))
def events_beyond_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.beyond(status_events(spark, sf_dir), _MARK)[1].groupBy("account").agg(F.count("*").alias("events"), F.min("at").alias("first_at"))


@query(intervals_sql("""SELECT case_id, event_id, status, median, (ended - started) > median AS above FROM (SELECT *, quantile_cont((ended - started)::DOUBLE, 0.5) OVER (PARTITION BY status) AS median FROM iv WHERE ended IS NOT NULL AND status IS NOT NULL)"""))
def stays_against_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = all_intervals(spark, sf_dir).filter("ended is not null and status is not null").select("case_id", "event_id", "status", _spent().alias("spent"))
    return audits.against_group(rows, quantiles.quantiles(rows, ("status",), F.col("spent"), {"median": 0.5}), "status", F.col("spent"), "median").drop("spent")


@query("""WITH v AS (SELECT trim(regexp_replace(lower(p_name), '[^0-9a-z]+', ' ', 'g')) AS key, CASE p_partkey % 3 WHEN 0 THEN upper(p_name) WHEN 1 THEN replace(p_name, ' ', '-') ELSE p_name END AS name, p_partkey FROM part),
g AS (SELECT key, name, count(*) AS n, min(p_partkey) AS f FROM v GROUP BY ALL)
SELECT key, name, uses, variants FROM (SELECT *, sum(n) OVER (PARTITION BY key)::BIGINT AS uses, count(*) OVER (PARTITION BY key) AS variants, row_number() OVER (PARTITION BY key ORDER BY n DESC, f) AS r FROM g) WHERE r = 1""")
def common_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("p_partkey") % 3
    name = F.when(kind == 0, F.upper("p_name")).when(kind == 1, F.translate("p_name", " ", "-")).otherwise(F.col("p_name"))
    return audits.common_variants(read(spark, sf_dir, "part").select(C.catalogue_key(F.col("p_name")).alias("key"), name.alias("name"), F.col("p_partkey").alias("place")))


@query("WITH s AS (SELECT s_nationkey::VARCHAR AS nation, round(s_acctbal)::BIGINT::VARCHAR AS balance, regexp_extract(s_name, '[0-9]+$') AS tail FROM supplier), c AS (SELECT c_nationkey::VARCHAR AS nation, round(c_acctbal)::BIGINT::VARCHAR AS balance, regexp_extract(c_name, '[0-9]+$') AS tail FROM customer) SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{f}' AS field, count(*) AS common, count_if(a = 1 AND b = 1)::BIGINT AS one_to_one FROM (SELECT {f} AS v, count(*) AS a FROM s GROUP BY 1) JOIN (SELECT {f} AS v, count(*) AS b FROM c GROUP BY 1) USING (v)" for f in ("nation", "balance", "tail")) + ") WHERE common > 0")
def matching_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    side = lambda t, p: read(spark, sf_dir, t).select(F.col(f"{p}_nationkey").alias("nation"), F.round(f"{p}_acctbal").cast("long").alias("balance"), F.regexp_extract(f"{p}_name", "[0-9]+$", 0).alias("tail"))
    return audits.matching_fields(side("supplier", "s"), side("customer", "c"), ["nation", "balance", "tail"])


@query("""SELECT groups, count(*) AS n FROM (SELECT user_id, ts::DATE AS d, string_agg(DISTINCT event_type, '+' ORDER BY event_type) AS groups FROM events WHERE event_type IN ('view', 'click', 'purchase') GROUP BY 1, 2) GROUP BY groups""")
def item_triage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day"), "event_type")
    return audits.memberships({kind: rows.filter(F.col("event_type") == kind).select("user_id", "day") for kind in ("view", "click", "purchase")}, ["user_id", "day"])


@query("""SELECT event_type, count(*) AS events, count(DISTINCT (user_id, ts::DATE)) AS operations, count(DISTINCT CASE WHEN c_custkey IS NOT NULL THEN user_id END) AS known_users, count(DISTINCT CASE WHEN c_custkey IS NULL THEN user_id END) AS other_users
FROM events LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) ON c_custkey = user_id GROUP BY event_type""")
def batch_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = read(spark, sf_dir, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("known"))
    rows = read(spark, sf_dir, "events").join(known, F.col("known") == F.col("user_id"), "left")
    return rows.groupBy("event_type").agg(F.count("*").alias("events"), F.count_distinct("user_id", F.to_date("ts")).alias("operations"), F.count_distinct(F.when(F.col("known").isNotNull(), F.col("user_id"))).alias("known_users"), F.count_distinct(F.when(F.col("known").isNull(), F.col("user_id"))).alias("other_users"))


@query(intervals_sql("""SELECT account, count(*) AS stays_before, count(DISTINCT case_id) AS cases_before, count_if(ok)::BIGINT AS stays_after, count(DISTINCT CASE WHEN ok THEN case_id END) AS cases_after
FROM (SELECT *, NOT bool_or(coalesce(status = 'Declined', false)) OVER (PARTITION BY case_id) AS ok FROM iv) GROUP BY account"""))
def scope_impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.scope_impact(all_intervals(spark, sf_dir), F.col("status") == "Declined", "account")


@query(intervals_sql("""SELECT n AS statuses, count(*) AS cases FROM (SELECT case_id, count(DISTINCT CASE WHEN role <> 'terminal' THEN status END) AS n, arg_max(role, position) AS l FROM iv GROUP BY case_id) WHERE l = 'terminal' GROUP BY n"""))
def closed_diversity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.closed_diversity(all_intervals(spark, sf_dir))


@query(events_sql(f"""SELECT account, max("at") AS last_at, {CUT} - max("at") AS age, CASE WHEN {CUT} - max("at") <= {3 * DAY} THEN 'fresh' ELSE 'stale' END AS state FROM bound GROUP BY account"""))
def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.freshness(status_events(spark, sf_dir), "account", CUT, 3 * DAY)


@query(events_sql(_LIVE + """ SELECT 'stays by provenance' AS what, provenance AS value, count(*) AS n FROM lv GROUP BY provenance UNION ALL SELECT 'stays by role', role, count(*) FROM lv GROUP BY role UNION ALL SELECT 'reasons', unnest(['account_boundary', 'no_duration']), unnest([count_if(account_boundary), count_if(no_duration)])::BIGINT FROM lv"""))
def rehearsal_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = live_stays(spark, sf_dir)
    by = lambda what, c: rows.groupBy(F.col(c).alias("value")).agg(F.count("*").alias("n")).select(F.lit(what).alias("what"), "value", "n")
    flags = rows.agg(*[F.count_if(F.col(c)).alias(c) for c in ("account_boundary", "no_duration")])
    reasons = flags.select(F.explode(F.array(*[F.struct(F.lit(c).alias("value"), F.col(c).alias("n")) for c in ("account_boundary", "no_duration")])).alias("x")).select(F.lit("reasons").alias("what"), "x.*")
    return audits.stacked([by("stays by provenance", "provenance"), by("stays by role", "role"), reasons])


_REMEDIES = {"no_intake": "move it to the intake first", "gap": "add the missing stay", "overlap": "correct the dates", "boundary": "confirm the pair of items", "blank": "set a status", "single_stay": "wait for the next stay"}


@query(intervals_sql(f""", pf AS (SELECT *, lag(account) OVER (PARTITION BY case_id ORDER BY position) AS a FROM iv), pg AS (SELECT case_id, list_filter([CASE WHEN bool_or(position = 1 AND status IS DISTINCT FROM 'Intake') THEN 'no_intake' END, CASE WHEN bool_or(coalesce(a <> account, false)) THEN 'boundary' END,
CASE WHEN bool_or(status IS NULL) THEN 'blank' END, CASE WHEN count(*) = 1 THEN 'single_stay' END], lambda x: x IS NOT NULL) AS r FROM pf GROUP BY case_id)
SELECT case_id, reason, CASE reason {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in _REMEDIES.items())} END AS remedy FROM (SELECT case_id, unnest(r) AS reason FROM pg)"""))
def pending_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = intervals.trajectory(all_intervals(spark, sf_dir), MODEL.intake).filter("not sound").select("case_id", F.explode(F.split("reasons", ",")).alias("reason"))
    remedies = F.create_map(*[F.lit(x) for pair in _REMEDIES.items() for x in pair])
    return rows.withColumn("remedy", F.try_element_at(remedies, F.col("reason")))


@query("""WITH o AS (SELECT s_suppkey AS id, s_nationkey AS nation, regexp_extract(s_name, '[0-9]+$') AS tail, round(s_acctbal) AS balance FROM supplier), n AS (SELECT c_custkey AS id, c_nationkey AS nation, regexp_extract(c_name, '[0-9]+$') AS tail, round(c_acctbal) AS balance FROM customer),
few AS (SELECT nation, balance FROM (SELECT nation, balance, count(*) AS a FROM o GROUP BY ALL) JOIN (SELECT nation, balance, count(*) AS b FROM n GROUP BY ALL) USING (nation, balance) WHERE a * b <= 100),
p AS (SELECT o.id FROM o JOIN n USING (nation, balance) JOIN few USING (nation, balance) UNION SELECT o.id FROM o JOIN n USING (tail))
SELECT s_nationkey AS nation, count(*) AS items, count(p.id) AS paired, round(count(p.id) * 100.0 / count(*), 6)::DOUBLE AS share FROM supplier LEFT JOIN p ON p.id = s_suppkey GROUP BY 1""")
def identity_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    paired = _pairs(spark, sf_dir).select(F.col("old_id").alias("s_suppkey")).distinct().withColumn("hit", F.lit(1))
    got = read(spark, sf_dir, "supplier").join(paired, "s_suppkey", "left").groupBy(F.col("s_nationkey").alias("nation")).agg(F.count("*").alias("items"), F.count("hit").alias("paired"))
    return got.withColumn("share", F.round(F.col("paired") * 100.0 / F.col("items"), 6))


@query(stays_sql("SELECT case_id, count(DISTINCT cycle) AS cycles FROM stays GROUP BY case_id ORDER BY cycles DESC, case_id LIMIT 15"))
def most_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.projects(all_stays(spark, sf_dir), CUT).select("case_id", "cycles").orderBy(F.desc("cycles"), "case_id").limit(15)

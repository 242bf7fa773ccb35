"""Registered queries of the whole model: native items, routes, copies, pools, placing, filling errors, months, published destinations, estimates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import intervals, model, routing
from .analysis_queries import _DESTINATIONS, _ERRORS, _destinations
from .binding import CUT, MODEL, SPEC, events_sql, read, status_events, stays_sql
from .binding import intervals as all_intervals
from .binding import stays as all_stays
from .evidence_queries import _TWO, _two_accounts
from .queries import _BUSINESS, _PROJECTS, LOCAL, ZONE, _responses, query

DAY = C.DAY
_MARKS = ("adjusted",)
_STALE = 3


def _business_of(rows: str) -> str:
    """case_id, event_id, business of rows(case_id, event_id, started, seen_until) in SQL."""
    return _BUSINESS.replace("FROM iv)", f"FROM {rows})")


# --- native items ---------------------------------------------------------------------------------


def _title(c: Column) -> Column:
    base = F.concat(F.lit("Case "), F.floor(c / 30).cast("string"))
    title = F.when(c % 23 == 0, F.concat(base, F.lit(" test"))).when(c % 23 == 1, F.concat(F.lit("[Internal] "), base))
    return title.when((c % 4 == 0) & (F.floor(c / 4) % 4 < 2), F.concat(base, F.lit(" [Adjusted 2]"))).otherwise(base)


def _about(c: Column) -> list[Column]:
    names = F.when(c % 7 == 0, F.array().cast("array<string>")).when(c % 7 == 1, F.array(F.lit("Ana"), F.lit("Bo"))).when(c % 7 == 2, F.array(F.lit("Talent squad"))).otherwise(F.array(F.lit("Ana")))
    other = F.when(c % 7 == 3, "ANA").when(c % 7 == 4, "Zoe").otherwise("")
    kind = F.when(c % 6 == 5, "Other").when(c % 6 == 4, " ").otherwise("Brief")
    brand, owner = F.when(c % 13 == 0, " ").otherwise(F.concat(F.lit("Brand "), (c % 5).cast("string"))), F.when(c % 8 != 0, F.concat(F.lit("Owner "), (c % 4).cast("string")))
    return [kind.alias("input_kind"), names.alias("names"), other.alias("other"), brand.alias("brand"), owner.alias("owner")]


def _register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current register: most items that have moved, and every tenth customer as an item that never did."""
    last = status_events(spark, sf_dir).filter(f"at < {CUT} and case_id % 17 <> 0").groupBy("case_id").agg(F.max_by(F.struct("status"), F.struct("at", "event_id")).alias("l"))
    moved = last.select(F.col("case_id").alias("item"), F.when(F.col("case_id") % 5 != 0, F.col("l.status")).otherwise("Drafting").alias("current_status"))
    never = read(spark, sf_dir, "customer").filter("c_custkey % 10 = 0").select((F.col("c_custkey") + 1_000_000_000).alias("item"), F.lit("Intake").alias("current_status"))
    return moved.unionByName(never).select("item", "current_status", _title(F.col("item")).alias("title"), *_about(F.col("item")))


def _native(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Native items: every fourth was born with a status, which stands before its first stay, and every third has a pair."""
    rows, c = all_intervals(spark, sf_dir).withColumnRenamed("case_id", "item"), F.col("item")
    born = F.element_at(F.array(*map(F.lit, ("Closed", "Awaiting feedback", "Intake", "Archive"))), (F.floor(c / 4) % 4 + 1).cast("int"))
    none, same = F.lit(None).cast("long"), ("event_id", "position", "status", "started", "ended")
    stay = F.struct(*same, F.when(F.col("event_id") % 19 != 0, "observed").otherwise("inferred").alias("quality"))
    first = F.struct((-F.col("event_id")).alias("event_id"), F.lit(0).alias("position"), born.alias("status"), none.alias("started"), none.alias("ended"), F.lit("inferred").alias("quality"))
    both = F.when((F.col("position") == 1) & (c % 4 == 0), F.array(first, stay)).otherwise(F.array(stay))
    every = rows.select("item", *[x for x in rows.columns if x not in (*same, "item")], F.inline(both)).withColumn("title", _title(c))
    mapped = status_events(spark, sf_dir).filter("case_id % 3 = 0").select(F.col("case_id").alias("item"))
    return routing.native(every, _register(spark, sf_dir).drop("title"), mapped, MODEL, SPEC, CUT)


def _reasons_sql(c: str, found: str) -> str:
    return f"""list_sort(list_filter([CASE WHEN {c} % 23 = 0 THEN 'word:test' END, CASE WHEN {c} % 23 = 1 THEN 'prefix:internal' END, CASE WHEN {found} AND {c} % 6 = 5 THEN 'input_other' END, CASE WHEN NOT {found} OR {c} % 6 = 4 THEN 'input_blank' END,
  CASE WHEN NOT {found} THEN 'no_register' END, CASE WHEN {found} THEN CASE {c} % 7 WHEN 0 THEN 'none' WHEN 1 THEN 'several' WHEN 2 THEN 'squad' WHEN 4 THEN 'both_columns' END END], lambda x: x IS NOT NULL))"""


_TITLE = "CASE WHEN {0} % 23 = 0 THEN 'Case ' || {0} // 30 || ' test' WHEN {0} % 23 = 1 THEN '[Internal] Case ' || {0} // 30 WHEN {0} % 4 = 0 AND {0} // 4 % 4 < 2 THEN 'Case ' || {0} // 30 || ' [Adjusted 2]' ELSE 'Case ' || {0} // 30 END"
_NATIVE = f""", rl AS (SELECT case_id AS c, CASE WHEN case_id % 5 <> 0 THEN arg_max(coalesce(status, '?'), position) ELSE 'Drafting' END AS cs FROM iv GROUP BY case_id),
nc AS (SELECT c, c % 17 <> 0 AS found, CASE WHEN c % 17 <> 0 THEN nullif(cs, '?') END AS cs, CASE WHEN c % 4 = 0 THEN ['Closed', 'Awaiting feedback', 'Intake', 'Archive'][c // 4 % 4 + 1] END AS born, {_reasons_sql("c", "(c % 17 <> 0)")} AS r FROM rl WHERE c % 3 <> 0),
nd AS (SELECT *, len(r) > 0 AND len(list_filter(r, lambda x: x NOT IN ('several', 'squad', 'collective'))) = 0 AS is_pool, coalesce(born IN ('Closed', 'Awaiting feedback'), false) AS copied FROM nc),
ne AS (SELECT *, CASE WHEN len(r) > 0 AND NOT is_pool THEN r WHEN coalesce(born = 'Archive', false) THEN ['no_intake_first'] END AS against FROM nd),
np AS (SELECT case_id, event_id, position, status, role, started, ended, CASE WHEN ended IS NOT NULL AND event_id % 19 <> 0 THEN 'observed' WHEN ended IS NULL AND event_id % 19 <> 0 AND status = cs AND position = max(position) OVER (PARTITION BY case_id) THEN 'open_age' ELSE 'unavailable' END AS provenance FROM iv JOIN ne ON c = case_id AND against IS NULL),
nu AS (SELECT *, CASE provenance WHEN 'observed' THEN ended WHEN 'open_age' THEN {CUT} END AS seen_until FROM np), nb AS ({_business_of("nu WHERE seen_until IS NOT NULL")}),
pa AS (SELECT nu.*, CASE WHEN seen_until IS NOT NULL THEN coalesce(business, 0)::BIGINT END AS business FROM nu LEFT JOIN nb USING (case_id, event_id)),
kf AS (SELECT case_id, min(position) AS p, arg_min(status, position) AS s FROM np WHERE role <> 'unknown' GROUP BY case_id),
rt AS (SELECT c AS case_id, p, s, CASE WHEN s IS DISTINCT FROM 'Intake' THEN 'no_intake' WHEN copied THEN 'duplicate' WHEN is_pool THEN 'pool' ELSE 'measured' END AS route FROM ne LEFT JOIN kf ON kf.case_id = c WHERE against IS NULL)"""


@query(stays_sql("SELECT case_id AS item, event_id, position::INTEGER AS position, status, started, ended, provenance, seen_until AS until, seen_until - started AS elapsed, business FROM pa", _NATIVE))
def native_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _native(spark, sf_dir)[0].select("item", "event_id", "position", "status", "started", "ended", "provenance", "until", "elapsed", "business")


@query(stays_sql(f"""SELECT c AS item, {_TITLE.format("c")} AS title, CASE WHEN found THEN CASE WHEN c % 13 = 0 THEN ' ' ELSE 'Brand ' || c % 5 END END AS brand, CASE WHEN is_pool THEN array_to_string(r, ',') ELSE '' END AS pool, copied AS born_as_copy, CASE WHEN copied THEN born END AS copied_status FROM ne WHERE against IS NULL""", _NATIVE))
def native_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _native(spark, sf_dir)[1].select("item", "title", "brand", F.array_join("pool", ",").alias("pool"), "born_as_copy", "copied_status")


@query(stays_sql(f"""SELECT c AS item, {_TITLE.format("c")} AS title, array_to_string(against, ',') AS reasons, (SELECT count(*) FROM iv WHERE case_id = c) + CASE WHEN c % 4 = 0 THEN 1 ELSE 0 END AS stays, CASE WHEN born IS NOT NULL THEN born ELSE (SELECT status FROM iv WHERE case_id = c AND position = 1) END AS first_status FROM ne WHERE against IS NOT NULL""", _NATIVE))
def native_excluded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _native(spark, sf_dir)[2].withColumn("reasons", F.array_join("reasons", ","))


def _whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stays of native cases with roles, business time, what holds for the whole case, and its route."""
    return routing.routed(_native(spark, sf_dir)[0].withColumnRenamed("item", "case_id"), MODEL.intake)


@query(stays_sql("SELECT case_id, route, s AS first_status FROM rt", _NATIVE))
def case_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.routes(_whole(spark, sf_dir))


_COPIED = _NATIVE + """, bs AS (SELECT c AS case_id, 'case ' || c // 30 AS base, copied, born FROM ne WHERE against IS NULL), og AS (SELECT base, count(*) AS n, min(case_id) AS one FROM bs WHERE NOT copied GROUP BY base),
cp AS (SELECT case_id, min(CASE WHEN position >= p THEN started END) AS entered, arg_max(coalesce(status, '?'), position) AS status, count_if(position >= p AND role = 'delivery') AS deliveries, min(CASE WHEN position >= p AND role = 'delivery' THEN started END) AS first_delivery,
  CASE WHEN count_if(position >= p AND role = 'work') = count(CASE WHEN position >= p AND role = 'work' THEN business END) THEN sum(CASE WHEN position >= p AND role = 'work' THEN business END) END::BIGINT AS worked, string_agg(coalesce(status, '-'), ' > ' ORDER BY position) AS path
  FROM pa JOIN rt USING (case_id) WHERE route = 'duplicate' GROUP BY case_id),
dp AS (SELECT cp.* EXCLUDE (status), nullif(status, '?') AS status, bs.base, bs.born AS copied_status, coalesce(og.n, 0) AS originals, CASE WHEN og.n = 1 THEN one END AS related FROM cp JOIN bs USING (case_id) LEFT JOIN og ON og.base = bs.base)"""


@query(stays_sql(f"SELECT case_id, {_TITLE.format('case_id')} AS title, base, copied_status, entered, status, deliveries, first_delivery, worked, path, related, originals FROM dp", _COPIED))
def copied_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.duplicates(_whole(spark, sf_dir), _MARKS)


@query(stays_sql(f"""SELECT case_id, {_TITLE.format('case_id')} AS title, opened, status, state, deliveries, cycles, to_first_delivery, CASE case_id % 7 WHEN 1 THEN 'several' ELSE 'squad' END AS pool_reasons, CASE case_id % 7 WHEN 1 THEN '["Ana","Bo"]' ELSE '["Talent squad"]' END AS names
FROM proj WHERE case_id IN (SELECT case_id FROM rt WHERE route = 'pool')""", _NATIVE + _PROJECTS))
def pool_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.pool_cases(_whole(spark, sf_dir), MODEL, CUT)


_ALL_ITEMS = "rg AS (SELECT c FROM rl WHERE c % 17 <> 0 UNION ALL SELECT c_custkey + 1000000000 FROM customer WHERE c_custkey % 10 = 0)"


@query(stays_sql(f"""SELECT case_id AS item, route AS place, '' AS reasons FROM rt UNION ALL SELECT c, 'excluded', array_to_string(against, ',') FROM ne WHERE against IS NOT NULL
UNION ALL SELECT c, 'excluded', CASE WHEN len(x) > 0 THEN array_to_string(x, ',') ELSE 'no_history' END FROM (SELECT c, {_reasons_sql("c", "true")} AS x FROM rg WHERE c NOT IN (SELECT c FROM ne))""", _NATIVE + ", " + _ALL_ITEMS))
def placed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every item of the register once; those of pairs count here as items that nothing native is known of."""
    return routing.placed(_register(spark, sf_dir), routing.routes(_whole(spark, sf_dir)), _native(spark, sf_dir)[2])


_FILLED = _ERRORS + _COPIED + f""", {_ALL_ITEMS}, sg AS (SELECT *, min(CASE WHEN role = 'work' THEN position END) OVER s AS fw, max((role = 'work' AND status <> 'Intake')::INT) OVER s AS ow, position = max(position) OVER (PARTITION BY case_id) AS is_last
  FROM stays WHERE case_id IN (SELECT case_id FROM rt WHERE route = 'measured') WINDOW s AS (PARTITION BY case_id, segment)),
fe AS (SELECT case_id, NULL::BIGINT AS item, rule, status, "at" FROM ea UNION SELECT case_id, NULL, 'repeated_intake', status, started FROM sg WHERE role = 'work' AND status = 'Intake' AND position > fw UNION SELECT case_id, NULL, 'delivered_without_work', status, started FROM sg WHERE role = 'delivery' AND fw IS NOT NULL AND ow = 0
  UNION SELECT case_id, NULL, 'stuck_in_standby', status, started FROM sg WHERE is_last AND role = 'standby' AND {CUT} - started >= {(_STALE + 1) * DAY} UNION SELECT case_id, NULL, 'born_as_copy', 'Intake', entered FROM dp UNION SELECT case_id, NULL, 'ambiguous_original', 'Intake', entered FROM dp WHERE originals > 1
  UNION SELECT NULL, c, unnest(list_filter([CASE c % 7 WHEN 0 THEN 'none' WHEN 1 THEN 'several' WHEN 2 THEN 'squad' WHEN 4 THEN 'both_columns' END, CASE WHEN c % 13 = 0 THEN 'brand_blank' END, CASE WHEN c % 6 = 4 THEN 'input_blank' END, CASE WHEN c % 8 = 0 THEN 'owner_blank' END], lambda x: x IS NOT NULL)),
    CASE WHEN c >= 1000000000 THEN 'Intake' ELSE (SELECT nullif(cs, '?') FROM rl WHERE rl.c = rg.c) END, NULL FROM rg)"""
_SEVERITY = "CASE rule " + " ".join(f"WHEN '{r}' THEN '{s}'" for r, s in routing.ERRORS.items()) + " END"


@query(stays_sql(f"""SELECT sha256(rule || '|' || coalesce(case_id::VARCHAR, 'None') || '|' || coalesce(item::VARCHAR, 'None') || '|' || coalesce(status, 'None') || '|' || coalesce("at"::VARCHAR, 'None')) AS error_id, case_id, item, rule, {_SEVERITY} AS severity, status, "at" FROM fe""", _FILLED))
def filling_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filling_errors(spark, sf_dir)


def _filling_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _whole(spark, sf_dir)
    return routing.filling_errors(all_intervals(spark, sf_dir), _responses(spark, sf_dir), rows, routing.duplicates(rows, _MARKS), _register(spark, sf_dir), MODEL, CUT, _STALE)


@query(stays_sql("SELECT rule, severity, count(*) AS errors, count(DISTINCT case_id) AS cases, count(DISTINCT item) AS items FROM (SELECT *, " + _SEVERITY + " AS severity FROM fe) GROUP BY rule, severity", _FILLED))
def errors_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filling_errors(spark, sf_dir).groupBy("rule", "severity").agg(F.count("*").alias("errors"), F.count_distinct("case_id").alias("cases"), F.count_distinct("item").alias("items"))


# --- months, published destinations, estimates ----------------------------------------------------

_POPULATIONS = """, po AS (SELECT opened AS t, 'opened' AS w, false AS a, false AS b, false AS c, false AS d FROM proj UNION ALL SELECT first_delivery, 'first_delivered', cycles > 1, false, false, false FROM proj WHERE first_delivery IS NOT NULL UNION ALL SELECT started, 'delivered', false, false, false, false FROM resp
UNION ALL SELECT started + waited, 'answered', false, outcome = 'changes', outcome = 'closed_automatically', outcome IN ('approved', 'declined') FROM resp WHERE waited IS NOT NULL UNION ALL SELECT "at", 'errors', false, false, false, false FROM ea)"""


@query(stays_sql(f"""SELECT date_trunc('month', make_timestamp(t {LOCAL}))::DATE AS month, {', '.join(f"count_if(w = '{w}')::BIGINT AS {w}" for w in ('opened', 'first_delivered', 'delivered', 'answered', 'errors'))},
count_if(a)::BIGINT AS first_with_rework, count_if(b)::BIGINT AS change_requests, count_if(c)::BIGINT AS closed_automatically, count_if(d)::BIGINT AS decisions FROM po GROUP BY 1""", _PROJECTS + _ERRORS + _POPULATIONS))
def monthly_populations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five populations by month, each by its own date, with what happened in them."""
    from ..operators.portfolio import case_errors

    rows = all_stays(spark, sf_dir)
    projects, answers = model.projects(rows, CUT), _responses(spark, sf_dir)
    day = lambda c: C.local_day(c, ZONE)
    populations = {
        "opened": (projects, day(F.col("opened"))), "first_delivered": (projects.filter("first_delivery is not null"), day(F.col("first_delivery"))), "delivered": (answers, day(F.col("started"))),
        "answered": (answers.filter("waited is not null"), day(F.col("started") + F.col("waited"))), "errors": (case_errors(all_intervals(spark, sf_dir), answers, MODEL.intake), day(F.col("at"))),
    }
    outcome = F.col("outcome")
    measures = {"first_with_rework": ("first_delivered", F.col("cycles") > 1), "change_requests": ("answered", outcome == "changes"), "closed_automatically": ("answered", outcome == "closed_automatically"), "decisions": ("answered", outcome.isin("approved", "declined"))}
    return routing.monthly(populations, measures)


def _published(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    rows = _two_accounts(spark, sf_dir).withColumn("position", F.row_number().over(intervals.in_order()))
    case = F.col("user_id") * 4 + F.floor(F.pmod(F.floor(F.col("at") / C.HOUR), F.lit(24)) / 6)
    seen = status_events(spark, sf_dir).filter(f"at < {CUT} and status is not null and event_id % 2 = 0").select(case.alias("case_id"), "at", "event_id", "status")
    register = seen.groupBy("case_id").agg(F.max_by("status", F.struct("at", "event_id")).alias("current_status")).withColumn("captured_at", F.lit(CUT + 6 * C.HOUR)).withColumn("brand", F.concat(F.lit("Brand "), (F.col("case_id") % 5).cast("string")))
    return routing.destination_tables(rows, _destinations(spark, sf_dir), register, SPEC)


@query(events_sql(_DESTINATIONS + " SELECT case_id, event_id, account, status, role, started, ended, position::INTEGER AS position FROM tq JOIN ds USING (case_id) WHERE destination = 'measured'"))
def destination_measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _published(spark, sf_dir)[0]


_QUEUED = _DESTINATIONS + f""", qq AS (SELECT case_id, 0 AS event_id, max(started) AS started, {CUT + 6 * C.HOUR} AS seen_until, count(*) AS stays FROM (SELECT * FROM tq WHERE status IS NOT NULL) JOIN ds USING (case_id) WHERE destination = 'queue' GROUP BY case_id),
qb AS ({_business_of("qq")})"""


@query(events_sql(_QUEUED + f" SELECT case_id, (SELECT count(*) FROM tq WHERE tq.case_id = qq.case_id) AS stays, cs AS current_status, 'Brand ' || case_id % 5 AS brand, started AS queued_at, seen_until AS captured_at, seen_until - started AS waited, coalesce(business, 0)::BIGINT AS waited_business FROM qq JOIN reg USING (case_id) LEFT JOIN qb USING (case_id)"))
def destination_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _published(spark, sf_dir)[1]


@query(events_sql(_DESTINATIONS + """ SELECT ds.case_id, ds.stays, cs AS current_status, CASE WHEN cs IS NOT NULL THEN 'Brand ' || ds.case_id % 5 END AS brand, reasons, fs AS first_known, (SELECT min(started) FROM tq WHERE tq.case_id = ds.case_id AND status = 'Intake') AS first_intake, ds.stays::INTEGER AS evidence
FROM ds LEFT JOIN reg ON reg.case_id = ds.case_id LEFT JOIN tf ON tf.case_id = ds.case_id WHERE destination = 'quality'"""))
def destination_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _published(spark, sf_dir)[2].withColumn("evidence", F.size(F.from_json("evidence", "array<struct<position:int>>")))


_ESTIMATED = _TWO + f""", ov AS (SELECT *, coalesce(started < max(ended) OVER (PARTITION BY case_id ORDER BY started, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS o, lead(event_id) OVER w AS ne, lead(account) OVER w AS na, lead(status) OVER w AS ns, lead(started) OVER w AS nt FROM ta WINDOW w AS (PARTITION BY case_id ORDER BY started, event_id)),
eb AS (SELECT *, bool_or(o) OVER (PARTITION BY case_id) AS blocked FROM ov), eg AS (SELECT *, NOT blocked AND ended IS NULL AND account = 'A' AND coalesce(na = 'B', false) AND role NOT IN ('terminal', 'unknown') AND coalesce(lower(status) <> lower(ns) AND nt > started AND nt <= {CUT}, false) AS good FROM eb),
ez AS (SELECT case_id, event_id, started, nt AS seen_until FROM eg WHERE good), ey AS ({_business_of("ez")})"""


@query(events_sql(_ESTIMATED + """ SELECT case_id, event_id, CASE WHEN good THEN 'next_stay_of_other_account' WHEN blocked THEN 'blocked_by_overlap' ELSE 'not_applicable' END AS method, CASE WHEN good THEN nt END AS estimated_end, CASE WHEN good THEN nt - started END AS elapsed,
CASE WHEN good THEN coalesce(business, 0)::BIGINT END AS business, CASE WHEN good THEN ne END AS reference FROM eg LEFT JOIN ey USING (case_id, event_id)"""))
def estimated_exits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.estimates(_two_accounts(spark, sf_dir), SPEC, CUT, "A", "B")

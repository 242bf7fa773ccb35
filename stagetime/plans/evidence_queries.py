"""Registered queries of evidence, live cycles, consolidation, boards, people rules and errors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import evidence, live, quality, rules
from ..operators.intervals import build_intervals
from ..sources import boards
from .binding import CUT, MODEL, events_sql, read, status_events
from .queries import query

HOUR = 3_600_000_000


def _evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a case by the hour; those of six hours are one action, views are batches."""
    hour = (F.floor(F.col("at") / HOUR) * HOUR).cast("long")
    action = F.when(F.col("k") % 4 != 0, F.floor(F.col("at") / (6 * HOUR)).cast("long"))
    rows = status_events(spark, sf_dir)
    return rows.select(
        F.col("case_id").alias("item"), action.alias("action"), "event_id", F.when(F.col("k") % 97 != 0, hour).alias("at"), F.when(F.col("k") % 7 != 0, F.col("k") % 3).alias("value"), (F.col("event_type") != "view").alias("single")
    )


_EVIDENCE = f""", ee AS (SELECT case_id AS item, CASE WHEN k % 4 <> 0 THEN "at" // {6 * HOUR} END AS action, event_id, CASE WHEN k % 97 <> 0 THEN "at" // {HOUR} * {HOUR} END AS "at", CASE WHEN k % 7 <> 0 THEN k % 3 END AS value, event_type <> 'view' AS single FROM bound),
op AS (SELECT *, CASE WHEN action IS NULL THEN 'event:' || event_id ELSE 'action:' || action END AS operation FROM ee),
og AS (SELECT item, operation, count(*) AS n_events, bool_or(single) AS s, bool_or(action IS NOT NULL) AS a, CASE WHEN count(DISTINCT value) = 1 AND NOT bool_or(single AND value IS NULL) THEN min(value) END AS value,
  list(DISTINCT coalesce("at", -1)) FILTER (WHERE single) AS ts, list(DISTINCT coalesce("at", -1)) AS ta FROM op GROUP BY item, operation),
ot AS (SELECT *, CASE WHEN s THEN CASE WHEN len(ts) = 1 AND ts[1] >= 0 THEN ts[1] END ELSE CASE WHEN len(ta) = 1 AND ta[1] >= 0 THEN ta[1] END END AS "at" FROM og),
obs AS (SELECT item, operation, n_events, value, "at", CASE WHEN s THEN 'single' ELSE 'batch' END AS evidence, concat_ws(',', CASE WHEN NOT a THEN 'no_action' END, CASE WHEN value IS NULL THEN 'status' END, CASE WHEN "at" IS NULL THEN 'time' END) AS reasons FROM ot),
mom AS (SELECT item, "at", CASE WHEN count(*) = count(value) AND count(DISTINCT value) = 1 THEN min(value) END AS value FROM obs WHERE item NOT IN (SELECT item FROM obs WHERE "at" IS NULL) GROUP BY item, "at"),
mk AS (SELECT *, lag(value) OVER w AS was, row_number() OVER w AS rn FROM mom WINDOW w AS (PARTITION BY item ORDER BY "at")),
ed AS (SELECT * FROM mk WHERE value IS NULL OR rn = 1 OR was IS DISTINCT FROM value),
ps AS (SELECT item, value, "at" AS started, CASE WHEN nv IS NOT NULL THEN na END AS ended, row_number() OVER (PARTITION BY item, value ORDER BY "at") AS visit,
  CASE WHEN na IS NULL THEN 'no_exit' WHEN nv IS NULL THEN 'interrupted' ELSE 'closed' END AS quality
  FROM (SELECT *, lead("at") OVER w AS na, lead(value) OVER w AS nv FROM ed WINDOW w AS (PARTITION BY item ORDER BY "at")) WHERE value IS NOT NULL)"""


@query(events_sql(_EVIDENCE + " SELECT * FROM obs"))
def status_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evidence.observations(_evidence(spark, sf_dir))


@query(events_sql(_EVIDENCE + " SELECT * FROM ps"))
def supported_stays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evidence.supported_stays(evidence.observations(_evidence(spark, sf_dir)))


@query(events_sql(_EVIDENCE + """ SELECT item, "at", 'conflict' AS reason FROM mom WHERE value IS NULL UNION ALL SELECT DISTINCT item, NULL::BIGINT, 'unlocated' FROM obs WHERE "at" IS NULL"""))
def evidence_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evidence.gaps(evidence.observations(_evidence(spark, sf_dir)))


@query(events_sql(_EVIDENCE + f""", hb AS (SELECT case_id AS item, "at" // {HOUR} * {HOUR} AS "at", k, event_type FROM bound),
ls AS (SELECT item, "at" AS started, min(event_type) AS l FROM hb WHERE k % 2 = 0 GROUP BY ALL HAVING count(DISTINCT event_type) = 1), le AS (SELECT item, "at" AS ended, min(event_type) AS x FROM hb WHERE k % 2 = 1 GROUP BY ALL HAVING count(DISTINCT event_type) = 1)
SELECT ps.*, coalesce(l, x) AS label, CASE WHEN l IS NOT NULL THEN 'start' WHEN x IS NOT NULL THEN 'exit' ELSE 'none' END AS label_from FROM ps LEFT JOIN ls USING (item, started) LEFT JOIN le USING (item, ended)"""))
def recovered_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = status_events(spark, sf_dir).select(F.col("case_id").alias("item"), (F.floor(F.col("at") / HOUR) * HOUR).cast("long").alias("at"), "event_type", "k")
    even, odd = rows.filter("k % 2 = 0"), rows.filter("k % 2 = 1")
    return evidence.recovered_labels(supported_stays(spark, sf_dir), even.withColumnRenamed("event_type", "label"), odd.withColumnRenamed("event_type", "previous"))


def _two_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stays of a user's quarter of the day; each account sees only its own, so A's last has no end."""
    rows = status_events(spark, sf_dir).withColumn("whole", F.col("user_id") * 4 + F.floor(F.pmod(F.floor(F.col("at") / HOUR), F.lit(24)) / 6))
    apart = build_intervals(rows.withColumn("case_id", F.concat_ws("/", "whole", "account")), CUT)
    return apart.withColumn("case_id", F.split_part("case_id", F.lit("/"), F.lit(1)).cast("long")).withColumn("role", MODEL.role(F.col("status"))).drop("position", "visit", "seen_until")


_TWO = f""", tw AS (SELECT *, user_id * 4 + "at" // {HOUR} % 24 // 6 AS c FROM bound WHERE "at" < {CUT}),
tm AS (SELECT *, row_number() OVER w AS rn, lag(status) OVER w AS was FROM tw WINDOW w AS (PARTITION BY c, account ORDER BY "at", event_id)),
ta AS (SELECT c AS case_id, event_id, account, status, "at" AS started, lead("at") OVER (PARTITION BY c, account ORDER BY "at", event_id) AS ended,
  CASE WHEN status IN ('Intake', 'Drafting', 'In review') THEN 'work' WHEN status = 'Waiting on brand' THEN 'waiting' WHEN status = 'Standby' THEN 'standby' WHEN status = 'Awaiting feedback' THEN 'delivery' WHEN status IN ('Closed', 'Approved', 'Declined', 'No return') THEN 'terminal' ELSE 'unknown' END AS role
  FROM tm WHERE rn = 1 OR was IS DISTINCT FROM status)"""
_LIVE = _TWO + f""", tp AS (SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY started, event_id) AS p FROM ta),
tk AS (SELECT case_id, min(p) AS f FROM tp WHERE role <> 'unknown' GROUP BY case_id),
te AS (SELECT tp.*, f FROM tp JOIN tk USING (case_id) WHERE (SELECT i.status FROM tp i WHERE i.case_id = tp.case_id AND i.p = f) = 'Intake'),
tn AS (SELECT a.*, b.case_id IS NOT NULL AS hb, b.status AS bs, b.account AS ba, b.ended AS be, b.role AS br, b.started AS bst, n.account AS na, n.role AS nr, n.started AS ns FROM te a
  LEFT JOIN te b ON b.case_id = a.case_id AND b.p = a.p - 1 AND b.p >= a.f LEFT JOIN te n ON n.case_id = a.case_id AND n.p = a.p + 1),
tv AS (SELECT *, p >= f AND ended IS NULL AND coalesce(na <> account AND nr <> 'unknown' AND ns > started, false) AND role NOT IN ('terminal', 'unknown') AS car,
  hb AND be IS NULL AND coalesce(ba <> account, false) AND role <> 'unknown' AND br NOT IN ('terminal', 'unknown') AND started > bst AS fro FROM tn),
tx AS (SELECT *, CASE WHEN p < f THEN 'prefix' WHEN role = 'terminal' THEN 'terminal' WHEN ended IS NOT NULL THEN 'observed' WHEN car THEN 'estimated' WHEN ns IS NULL AND role <> 'unknown' THEN 'open_age' ELSE 'unavailable' END AS provenance FROM tv),
ty AS (SELECT *, CASE provenance WHEN 'observed' THEN ended WHEN 'estimated' THEN ns WHEN 'open_age' THEN {CUT} END - started AS spent, hb AND bs IS NOT DISTINCT FROM status AS continues,
  (SELECT count(*) FROM te q WHERE q.case_id = tx.case_id AND q.p >= q.f AND q.p < tx.p AND q.role IN ('delivery', 'terminal')) AS seg FROM tx),
tz AS (SELECT *, hb AND be IS DISTINCT FROM started AND fro AS estimated_transition, hb AND be IS DISTINCT FROM started AND NOT fro AS no_continuity, hb AND ba <> account AS account_boundary, p >= f AND role = 'unknown' AS unknown_status,
  p >= f AND role <> 'terminal' AND spent IS NULL AS no_duration, min(CASE WHEN p >= f AND role = 'work' THEN p END) OVER (PARTITION BY case_id, seg) AS fw,
  p >= f AND NOT continues AND sum((p >= f AND NOT continues)::INT) OVER (PARTITION BY case_id, status ORDER BY p) > 1 AS returns FROM ty),
lv AS (SELECT case_id, event_id, account, status, role, started, ended, provenance, spent, continues, returns, coalesce(p = fw, false) AS opens, estimated_transition, no_continuity, account_boundary, unknown_status, no_duration,
  CASE WHEN p >= fw THEN sum(coalesce(p = fw, false)::INT) OVER (PARTITION BY case_id ORDER BY p) END::BIGINT AS cycle FROM tz)"""


@query(events_sql(_LIVE + " SELECT * FROM lv"))
def live_stays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return live.live_stays(_two_accounts(spark, sf_dir), MODEL.intake, CUT)


@query(events_sql(_LIVE + """, lg AS (SELECT case_id, cycle, min(started) AS started, max(started) FILTER (WHERE role IN ('delivery', 'terminal')) AS closed, max(role) FILTER (WHERE role IN ('delivery', 'terminal')) AS e, count_if(role = 'work')::BIGINT AS work_stays,
  bool_or(estimated_transition AND NOT opens) AS a, bool_or(no_continuity AND NOT opens) AS b, bool_or(account_boundary AND NOT opens) AS c, bool_or(unknown_status) AS d, bool_or(no_duration AND role NOT IN ('delivery', 'terminal')) AS n,
  bool_or(provenance = 'estimated' AND role NOT IN ('delivery', 'terminal')) AS has_estimate, bool_or(provenance = 'open_age' AND role NOT IN ('delivery', 'terminal')) AS has_open_age, bool_and(provenance = 'observed' OR role IN ('delivery', 'terminal')) AS o,
  CASE WHEN count_if(role = 'work' AND spent IS NULL) = 0 THEN sum(CASE WHEN role = 'work' THEN spent ELSE 0 END) END::BIGINT AS w, CASE WHEN count_if(role = 'waiting' AND spent IS NULL) = 0 THEN sum(CASE WHEN role = 'waiting' THEN spent ELSE 0 END) END::BIGINT AS x,
  CASE WHEN count_if(role = 'standby' AND spent IS NULL) = 0 THEN sum(CASE WHEN role = 'standby' THEN spent ELSE 0 END) END::BIGINT AS y FROM lv WHERE cycle IS NOT NULL GROUP BY case_id, cycle),
lc AS (SELECT *, NOT (b OR d OR n) AS ok, NOT (b OR d OR n) AND w IS NOT NULL AS complete FROM lg)
SELECT case_id, cycle, CASE WHEN cycle = 1 THEN 'first' ELSE 'reopened' END AS kind, started, closed, CASE e WHEN 'delivery' THEN 'delivered' WHEN 'terminal' THEN 'stopped' ELSE 'ongoing' END AS state,
concat_ws(',', CASE WHEN a THEN 'estimated_transition' END, CASE WHEN b THEN 'no_continuity' END, CASE WHEN c THEN 'account_boundary' END, CASE WHEN d THEN 'unknown_status' END, CASE WHEN n THEN 'no_duration' END) AS reasons, work_stays, complete, has_estimate, has_open_age,
CASE WHEN complete THEN w END AS worked, CASE WHEN ok THEN x END AS waited, CASE WHEN ok THEN y END AS paused, coalesce(complete AND e = 'delivery' AND o AND NOT c, false) AS observed_delivery FROM lc"""))
def live_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return live.live_cycles(live_stays(spark, sf_dir))


def _sources(spark: SparkSession, sf_dir: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """Each account's rows under its own item ids, and the pairs of ids; every eighth case has none."""
    rows = _two_accounts(spark, sf_dir)
    of = {a: rows.filter(F.col("account") == a).select((F.col("case_id") + n).alias("item"), "event_id", "status", "started", "ended") for a, n in (("A", 0), ("B", 1_000_000_000))}
    cases = rows.filter("case_id % 8 <> 0").select(F.col("case_id").alias("project")).distinct()
    pairs = cases.select("project", F.explode(F.array(*[F.struct(F.lit(a).alias("source"), (F.col("project") + n).alias("item")) for a, n in (("A", 0), ("B", 1_000_000_000))])).alias("x")).select("project", "x.*")
    return of, pairs


_CONSOLIDATED = _TWO + """, cs AS (SELECT account AS source, case_id + CASE account WHEN 'B' THEN 1000000000 ELSE 0 END AS item, event_id, status, started, ended, CASE WHEN case_id % 8 <> 0 THEN case_id END AS project FROM ta),
cp AS (SELECT *, coalesce(lag(started) OVER (PARTITION BY project ORDER BY started, source, event_id) = started, false) AS tie FROM cs WHERE project IS NOT NULL),
cr AS (SELECT project, bool_or(coalesce(status = 'Closed' AND event_id % 3 = 0, false)) AS sc, bool_or(tie) AS ti FROM cp GROUP BY project),
cx AS (SELECT cs.*, CASE WHEN cs.project IS NULL THEN 'no_pair' ELSE concat_ws(',', CASE WHEN sc THEN 'scope' END, CASE WHEN ti THEN 'ambiguous_order' END) END AS reasons FROM cs LEFT JOIN cr ON cr.project = cs.project)"""
_SCOPE = {"scope": "status = 'Closed' and event_id % 3 = 0"}


@query(events_sql(_CONSOLIDATED + """ SELECT source, item, event_id, status, started, ended, project, position, "overlaps", CASE WHEN NOT "overlaps" THEN ended - started END AS spent FROM
(SELECT *, row_number() OVER w AS position, coalesce(lead(started) OVER w < ended, false) AS "overlaps" FROM cx WHERE reasons = '' WINDOW w AS (PARTITION BY project ORDER BY started, source, event_id))"""))
def consolidated_stays(spark: SparkSession, sf_dir: str) -> DataFrame:
    of, pairs = _sources(spark, sf_dir)
    return live.consolidate(of, pairs, _SCOPE)[0]


@query(events_sql(_CONSOLIDATED + " SELECT source, item, event_id, status, started, ended, project, reasons FROM cx WHERE reasons <> ''"))
def excluded_stays(spark: SparkSession, sf_dir: str) -> DataFrame:
    of, pairs = _sources(spark, sf_dir)
    return live.consolidate(of, pairs, _SCOPE)[1]


@query(events_sql(_CONSOLIDATED + " SELECT source, count(*) AS rows, count_if(reasons = '')::BIGINT AS published, count_if(reasons <> '')::BIGINT AS excluded, true AS adds_up FROM cx GROUP BY source"))
def consolidation_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    of, pairs = _sources(spark, sf_dir)
    return live.accounting(of, *live.consolidate(of, pairs, _SCOPE))


_ALIASES = {"fastener": ["small bolt", "large bolt"], "fitting": ["small", "cold"], "widget": ["red widget"]}


@query("""WITH c AS (SELECT DISTINCT p_name AS t, p_name AS id FROM part), f AS (SELECT 'fastener' AS field, id, CASE WHEN t IN ('small bolt', 'large bolt') THEN 0 END AS r FROM c
UNION ALL SELECT 'fitting', id, CASE WHEN t LIKE 'small%' OR t LIKE 'cold%' THEN 1 END FROM c UNION ALL SELECT 'widget', id, CASE WHEN t = 'red widget' THEN 0 WHEN t LIKE 'red widget%' THEN 1 END FROM c),
g AS (SELECT field, r, count(*) AS n, min(id) AS id FROM f WHERE r IS NOT NULL GROUP BY ALL)
SELECT field, CASE r WHEN 0 THEN 'title' ELSE 'prefix' END AS how, n, CASE WHEN n = 1 THEN id END AS column_id FROM g QUALIFY row_number() OVER (PARTITION BY field ORDER BY r) = 1""")
def board_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = read(spark, sf_dir, "part").select(F.col("p_name").alias("id"), F.col("p_name").alias("title")).distinct()
    return boards.discover(names, _ALIASES)


@query("""WITH e AS (SELECT event_id AS item_id, event_type, user_id AS u, (props->>'$.k')::BIGINT AS k FROM events)
SELECT item_id, CASE k % 4 WHEN 0 THEN 'Intake' WHEN 1 THEN 'Drafting' WHEN 2 THEN 'Closed' END AS status, CASE WHEN k % 5 <> 0 THEN CASE k % 2 WHEN 0 THEN 'film + radio' ELSE 'radio + film' END END AS media,
'person:' || u || ' + team:' || (k % 3) AS owner, CASE WHEN k % 6 <> 0 THEN event_type END AS note, CASE WHEN k % 4 = 3 THEN 'status' ELSE '' END AS unread FROM e""")
def board_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, text = F.get_json_object("props", "$.k").cast("long"), lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    cell = lambda name, value: F.struct(F.lit(name).alias("id"), value.alias("value"))
    cells = F.array(
        cell("c1", text('{"index":', k % 4, "}")), cell("c2", F.when(k % 5 != 0, F.when(k % 2 == 0, '{"ids":[1,2]}').otherwise('{"ids":[2,1]}'))),
        cell("c3", text('{"personsAndTeams":[{"id":"', k % 3, '","kind":"team"},{"id":"', F.col("user_id"), '","kind":"person"}]}')), cell("c4", F.when(k % 6 != 0, text('"', F.col("event_type"), '"')).otherwise("null")),
    )
    items = read(spark, sf_dir, "events").select(F.col("event_id").alias("item_id"), cells.alias("cells"))
    return boards.decode(items, {"status": ("c1", "status"), "media": ("c2", "dropdown"), "owner": ("c3", "people"), "note": ("c4", "text")}, {"c1": {"0": "Intake", "1": "Drafting", "2": "Closed"}, "c2": {"1": "film", "2": "radio"}})


@query("""WITH p AS (SELECT o_custkey AS id, min(o_orderkey)::VARCHAR AS title FROM orders WHERE o_orderstatus = 'F' GROUP BY 1), c AS (SELECT o_custkey AS id, max(o_orderkey)::VARCHAR AS title FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1)
SELECT coalesce(c.id, p.id) AS id, coalesce(c.title, p.title) AS title, CASE WHEN p.id IS NULL THEN 9 ELSE 1 END::BIGINT AS first_seen, CASE WHEN c.id IS NULL THEN 2 ELSE 9 END::BIGINT AS last_seen, c.id IS NOT NULL AS is_present FROM p FULL JOIN c ON p.id = c.id""")
def column_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders")
    was = orders.filter("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("id")).agg(F.min("o_orderkey").cast("string").alias("title")).select("id", "title", F.lit(1).cast("long").alias("first_seen"), F.lit(2).cast("long").alias("last_seen"))
    now = orders.filter("o_orderstatus <> 'F'").groupBy(F.col("o_custkey").alias("id")).agg(F.max("o_orderkey").cast("string").alias("title"))
    return boards.catalogue(was, now, 9).withColumn("first_seen", F.col("first_seen").cast("long")).withColumn("last_seen", F.col("last_seen").cast("long"))


@query("""WITH p AS (SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN [] WHEN 1 THEN [p_name] WHEN 2 THEN [p_name, p_brand] ELSE [p_name || ' & ' || p_type] END AS names, CASE p_partkey % 3 WHEN 0 THEN upper(p_name) WHEN 1 THEN 'Squad ' || p_brand ELSE '' END AS other FROM part),
x AS (SELECT *, list_filter(list_concat(names, [other]), lambda n: n <> '') AS every FROM p)
SELECT p_partkey, concat_ws(',', CASE WHEN len(names) > 0 AND other <> '' AND NOT (len(names) = 1 AND lower(names[1]) = lower(other)) THEN 'both_columns' END, CASE WHEN len(every) = 0 THEN 'none' END,
CASE WHEN len(names) > 1 OR len(list_filter(every, lambda n: contains(n, ' & '))) > 0 THEN 'several' END, CASE WHEN starts_with(other, 'Squad') THEN 'squad' END) AS reasons,
CASE WHEN len(names) = 0 AND other = '' THEN 'none' WHEN len(names) > 0 AND other <> '' THEN 'both' WHEN len(names) > 1 THEN 'several' ELSE 'single' END AS situation FROM x""")
def talent_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.when(F.col("p_size") % 4 == 0, F.array().cast("array<string>")).when(F.col("p_size") % 4 == 1, F.array("p_name")).when(F.col("p_size") % 4 == 2, F.array("p_name", "p_brand")).otherwise(F.array(F.concat("p_name", F.lit(" & "), "p_type")))
    other = F.when(F.col("p_partkey") % 3 == 0, F.upper("p_name")).when(F.col("p_partkey") % 3 == 1, F.concat(F.lit("Squad "), "p_brand")).otherwise("")
    return read(spark, sf_dir, "part").select("p_partkey", F.array_join(rules.talent_reasons(names, other), ",").alias("reasons"), rules.talent_situation(names, other).alias("situation"))


def _rules() -> dict[str, Column]:
    return {"cheap": F.col("o_totalprice") < 50_000, "no priority": F.col("o_orderpriority") == "4-NOT SPECIFIED", "open": F.col("o_orderstatus") == "O"}

_BROKEN = """WITH f AS (SELECT DISTINCT o_custkey, unnest(list_filter([CASE WHEN o_totalprice < 50000 THEN 'cheap' END, CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'no priority' END, CASE WHEN o_orderstatus = 'O' THEN 'open' END], lambda x: x IS NOT NULL)) AS rule FROM orders)"""


@query(_BROKEN + " SELECT sha256(o_custkey || '|' || rule) AS error_id, o_custkey, rule FROM f")
def registration_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.errors(read(spark, sf_dir, "orders"), "o_custkey", _rules())


@query(_BROKEN + """, a AS (SELECT date_trunc('month', o_orderdate)::DATE AS month, c_mktsegment AS owner, count(*) AS started FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus = 'F' GROUP BY ALL),
d AS (SELECT o_custkey, min(date_trunc('month', o_orderdate)::DATE) AS month FROM orders GROUP BY 1), e AS (SELECT month, c_mktsegment AS owner, rule, count(*) AS n FROM f JOIN d USING (o_custkey) JOIN customer ON c_custkey = o_custkey GROUP BY ALL),
b AS (SELECT month, owner, sum(n)::BIGINT AS errors, '{' || string_agg('"' || rule || '":' || n, ',' ORDER BY rule) || '}' AS rules FROM e GROUP BY ALL)
SELECT coalesce(a.month, b.month) AS month, coalesce(a.owner, b.owner) AS owner, coalesce(started, 0) AS started, coalesce(errors, 0) AS errors, coalesce(rules, '{}') AS rules FROM a FULL JOIN b ON a.month = b.month AND a.owner = b.owner""")
def fill_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").withColumn("month", F.trunc("o_orderdate", "month"))
    owners = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("owner"))
    found = quality.errors(orders, "o_custkey", _rules()).join(orders.groupBy("o_custkey").agg(F.min("month").alias("month")), "o_custkey").join(owners, "o_custkey")
    return quality.fill_quality(orders.filter("o_orderstatus = 'F'").join(owners, "o_custkey"), found, ["month", "owner"])

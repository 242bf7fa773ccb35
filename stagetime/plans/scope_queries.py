"""Registered queries of scope and reviews: cells, people, stages, evidence, names, starts, patches, pending rows, trends."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import audits, decisions, portfolio, proofs, quality, rules
from .analysis_queries import _DESTINATIONS, _destinations
from .binding import CUT, MODEL, SPEC, events_sql, intervals_sql, read, stays_sql
from .binding import intervals as all_intervals
from .binding import stays as all_stays
from .catalogue_queries import _decided
from .evidence_queries import _LIVE, live_stays
from .queries import LOCAL, ZONE, query

# --- cells, people, stages ------------------------------------------------------------------------


@query("""SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN 'unverified' WHEN p_partkey % 7 = 0 THEN 'blank' ELSE 'filled' END AS state,
CASE WHEN p_partkey % 5 = 0 THEN 'input_unverified' WHEN p_partkey % 7 = 0 THEN 'input_blank' WHEN lower(p_type) NOT IN ('economy', 'small') THEN 'input_other' ELSE '' END AS reasons FROM part""")
def input_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds of input; a cell that was never returned is unverified, and no blank one."""
    k = F.col("p_partkey")
    value, there = F.when(k % 7 == 0, " ").otherwise(F.col("p_type")), k % 5 != 0
    return read(spark, sf_dir, "part").select("p_partkey", rules.cell_state(there, value).alias("state"), F.array_join(rules.input_reasons(value, there, ("economy", "small")), ",").alias("reasons"))


@query("""SELECT item, role, CASE WHEN n IS NOT NULL THEN n WHEN t = 'Eva' THEN 'Eva' END AS names, CASE WHEN n IS NOT NULL THEN 'known' WHEN t = 'Eva' THEN 'text' WHEN t IS NOT NULL THEN 'several_texts' ELSE 'none' END AS situation
FROM (SELECT o_custkey AS item, o_orderstatus AS role, string_agg(DISTINCT s_name, ' + ' ORDER BY s_name) AS n, max(CASE o_custkey % 3 WHEN 0 THEN 'Eva' WHEN 1 THEN 'Eva & Bo' END) AS t FROM orders LEFT JOIN supplier ON s_suppkey = o_orderkey AND o_custkey % 2 = 0 GROUP BY 1, 2)""")
def people_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roles of orders: persons by id where they are known, else the cell's text if it names one."""
    k = F.col("o_custkey")
    cells = read(spark, sf_dir, "orders").select(k.alias("item"), F.col("o_orderstatus").alias("role"), F.when(k % 2 == 0, F.col("o_orderkey")).alias("person_id"), F.when(k % 3 == 0, "Eva").when(k % 3 == 1, "Eva & Bo").otherwise(" ").alias("text"))
    return rules.people_fields(cells, read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("person_id"), F.col("s_name").alias("name")))


_STAGES = (*MODEL.work, *MODEL.waiting, *MODEL.standby, *MODEL.delivery, *MODEL.terminal)


@query(intervals_sql(f"SELECT status, list_position([{', '.join(map(repr, _STAGES))}], status)::INTEGER AS stage, role = 'work' AS is_work, role IN ('waiting', 'standby') AS is_pause, role = 'terminal' AS is_terminal, count(*) AS stays FROM iv WHERE status IS NOT NULL GROUP BY status, role"))
def stage_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    role = F.col("role")
    got = all_intervals(spark, sf_dir).filter("status is not null").groupBy("status", "role").agg(F.count("*").alias("stays"))
    return got.select("status", rules.stage_number(F.col("status"), _STAGES).alias("stage"), (role == "work").alias("is_work"), role.isin("waiting", "standby").alias("is_pause"), (role == "terminal").alias("is_terminal"), "stays")


@query("""SELECT o_orderpriority AS priority, state, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY o_orderpriority), 6)::DOUBLE AS share FROM (SELECT o_orderpriority, CASE WHEN o_orderkey % 11 = 0 THEN 'denied' WHEN o_orderkey % 5 = 0 THEN 'unverified' WHEN o_orderkey % 3 = 0 THEN 'blank' ELSE 'filled' END AS state FROM orders) GROUP BY 1, 2""")
def input_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    cells = read(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("priority"), F.when(k % 3 == 0, "").otherwise("x").alias("value"), (k % 5 != 0).alias("present"), F.when(k % 11 == 0, True).alias("denied"))
    return audits.input_audit(cells, "priority", "value", "present", "denied")


# --- evidence, starts -----------------------------------------------------------------------------


@query(events_sql(_LIVE + """, ev2 AS (SELECT account, list_filter([CASE WHEN account = 'A' AND event_id % 5 > 1 THEN 'label_without_evidence' END, CASE WHEN account = 'A' AND (event_id % 7 = 0 OR event_id % 11 = 0 OR ended IS NULL) THEN 'boundary_event_missing' END,
CASE WHEN event_id % 17 = 0 THEN 'history_not_observed' END, CASE WHEN account = 'B' AND event_id % 19 < 2 THEN 'origin_not_eligible' END, CASE WHEN event_id % 13 = 0 THEN 'calendar_not_validated' END], lambda x: x IS NOT NULL) AS r FROM lv)
SELECT account, reason, count(*) AS stays FROM (SELECT account, unnest(CASE WHEN len(r) = 0 THEN ['borne'] ELSE r END) AS reason FROM ev2) GROUP BY ALL"""))
def stage_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stays by what their evidence lacks: labels, events at either end, history, approval, calendar."""
    n = F.col("event_id")
    quality_ = F.when(n % 5 == 0, "observed_at_exit").when(n % 5 == 1, "observed_at_start").when(n % 5 == 2, "guessed")
    none = F.array().cast("array<string>")
    rows = live_stays(spark, sf_dir).select("account", quality_.alias("label_quality"), F.when(n % 7 == 0, none).when(n % 11 == 0, F.array(n.cast("string"), F.lit(" "))).otherwise(F.array(n.cast("string"))).alias("entry_events"), F.when(F.col("ended").isNotNull(), F.array(F.lit("x"))).alias("exit_events"),
        F.when(n % 17 != 0, "observed").alias("history"), F.when(n % 19 == 0, F.lit(None)).otherwise(n % 19 != 1).alias("eligible"), F.when(n % 13 == 0, "old").otherwise(SPEC.version()).alias("calendar"))
    reasons = portfolio.evidence_reasons(SPEC.version())
    return rows.select("account", F.explode(F.when(F.size(reasons) == 0, F.array(F.lit("borne"))).otherwise(reasons)).alias("reason")).groupBy("account", "reason").agg(F.count("*").alias("stays"))


@query(intervals_sql("""SELECT account, what, count(*) AS cases, sum(n)::BIGINT AS stays FROM (SELECT case_id, count(*) AS n, arg_min(account, position) AS account, min(CASE WHEN status = 'Intake' THEN position END) AS i, min(CASE WHEN status IS NOT NULL THEN position END) AS k,
CASE WHEN i IS NULL THEN 'never_intake' WHEN i = 1 THEN 'intake_first' WHEN k = i THEN 'blank_then_intake' ELSE 'other_then_intake' END AS what FROM iv GROUP BY case_id) GROUP BY account, what"""))
def strict_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.strict_start(all_intervals(spark, sf_dir), MODEL.intake, "account")


# --- names ----------------------------------------------------------------------------------------

_SPELT = """WITH nm AS (SELECT p_partkey AS item, CASE p_partkey % 4 WHEN 0 THEN 'Jose' || chr(769) || ' ' || p_name WHEN 1 THEN 'José ' || p_name WHEN 2 THEN 'JOSE ' || upper(p_name) ELSE 'José-' || p_name END AS name, p_partkey % 3 = 0 AS exclusive FROM part UNION ALL SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN '??' ELSE p_brand END, false FROM part),
kn AS (SELECT *, trim(regexp_replace(strip_accents(lower(name)), '[^0-9a-z]+', ' ', 'g')) AS key FROM nm), ea AS (SELECT key, name, count(*) AS n, min(item) AS f FROM kn WHERE key <> '' GROUP BY ALL)"""


@query(_SPELT + """ SELECT key, arg_max(name, (n, -f)) AS name, to_json(list(struct_pack(name := name, n := n) ORDER BY n DESC, name))::VARCHAR AS variants, count(*) AS n_variants, u.is_exclusive, u.uses_exclusive, u.uses_other, u.items, u.items_in_model
FROM ea JOIN (SELECT key, bool_or(exclusive) AS is_exclusive, count_if(exclusive)::BIGINT AS uses_exclusive, count_if(NOT exclusive)::BIGINT AS uses_other, count(DISTINCT item) AS items, count(DISTINCT CASE WHEN item % 2 = 0 THEN item END) AS items_in_model FROM kn GROUP BY key) u USING (key) GROUP BY ALL""")
def name_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of parts as they are written: with composed and decomposed letters, in capitals, with dashes; and their brands."""
    k, parts = F.col("p_partkey"), read(spark, sf_dir, "part")
    name = F.when(k % 4 == 0, F.concat(F.lit("Jose\u0301 "), "p_name")).when(k % 4 == 1, F.concat(F.lit("José "), "p_name")).when(k % 4 == 2, F.concat(F.lit("JOSE "), F.upper("p_name"))).otherwise(F.concat(F.lit("José-"), "p_name"))
    names = parts.select(k.alias("item"), name.alias("name"), (k % 3 == 0).alias("exclusive"), k.alias("place")).union(parts.select(k, F.when(k % 5 == 0, "??").otherwise(F.col("p_brand")), F.lit(False), k))
    return audits.name_dimension(names, parts.filter("p_partkey % 2 = 0").select(k.alias("item"))).drop("duplicate_of")


@query("""WITH k AS (SELECT p_name, min(p_partkey) % 6 AS k FROM part GROUP BY 1), d AS (SELECT t AS entity_type, CASE k WHEN 1 THEN 'a' WHEN 2 THEN 'b' WHEN 4 THEN 'd' WHEN 5 THEN 'e' END AS i, p_name, k FROM k, (VALUES ('talent'), ('brand')) v(t)),
a AS (SELECT entity_type, CASE WHEN k = 2 THEN 'shared' WHEN k = 5 THEN ' ' ELSE i || ':' || p_name END AS id, array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS n FROM d WHERE k IN (2, 4, 5))
SELECT DISTINCT entity_type, id AS canonical_id, 'incomplete' AS issue FROM a WHERE id = ' ' UNION ALL SELECT entity_type, id, 'conflicting' FROM a WHERE id <> ' ' GROUP BY entity_type, id HAVING count(DISTINCT n) > 1""")
def catalogue_contradictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Approvals in force at 25, of which some share an id under several names and some have a blank one."""
    rows = _decided(spark, sf_dir)
    other = F.when(F.startswith("canonical_id", F.lit("b:")), "shared").when(F.startswith("canonical_id", F.lit("e:")), " ").otherwise(F.col("canonical_id"))
    return decisions.contradictions(rows.withColumn("canonical_id", other), 25)


# --- rebuilds, patches, reviews -------------------------------------------------------------------


@query(intervals_sql("""SELECT kind, fields, count(*) AS n FROM (SELECT CASE WHEN event_id % 71 = 1 THEN 'missing' WHEN event_id % 71 IN (2, 3) THEN 'changed' END AS kind, CASE event_id % 71 WHEN 2 THEN 'started' WHEN 3 THEN 'position' ELSE '' END AS fields FROM iv) WHERE kind IS NOT NULL GROUP BY ALL"""))
def label_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rebuild that may change labels only, and has lost rows and touched starts and positions."""
    before, n = all_intervals(spark, sf_dir), F.col("event_id") % 71
    after = before.filter(n != 1).withColumn("status", F.concat(F.coalesce("status", F.lit("")), F.lit(" (new)"))).withColumn("started", F.when(n == 2, F.col("started") + 1).otherwise(F.col("started"))).withColumn("position", F.when(n == 3, F.col("position") + 1).otherwise(F.col("position")))
    return proofs.only_allowed(before, after, ["case_id", "event_id"], ["status", "role"])


@query("""SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 AND c_custkey % 3 = 0 THEN 'PATCHED' ELSE c_mktsegment END AS segment FROM customer UNION ALL SELECT c_custkey + 1000000, 'PATCHED' FROM customer WHERE c_custkey % 50 = 0""")
def patched_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fourth customer is approved for a patch that has every third, and some that are new."""
    base = read(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"))
    new = base.filter("c_custkey % 50 = 0").select((F.col("c_custkey") + 1_000_000).alias("c_custkey"))
    patch = base.filter("c_custkey % 3 = 0").select("c_custkey").union(new).withColumn("segment", F.lit("PATCHED"))
    return proofs.patched(base, patch, base.filter("c_custkey % 4 = 0").select("c_custkey").union(new), ["c_custkey"])


_REASONS = "(SELECT case_id, unnest(string_split(reasons, ',')) AS issue, stays FROM ds WHERE reasons <> '')"
_TOLD = {"first_is_not_intake": "move it to the intake first", "unknown_after_start": "set a status", "gap_or_overlap": "correct the dates", "account_change": "confirm the pair of items"}


@query(events_sql(_DESTINATIONS + f" SELECT sha256(case_id || '|' || issue) AS review_id, row_number() OVER (PARTITION BY issue ORDER BY stays, case_id)::INTEGER AS place, case_id, issue, CASE issue {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in _TOLD.items())} END AS remedy FROM {_REASONS}"))
def review_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reviews(spark, sf_dir)


def _reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    issues = _destinations(spark, sf_dir).filter("reasons <> ''").select("case_id", "stays", F.explode(F.split("reasons", ",")).alias("reason"))
    return audits.review_rows(issues, ["case_id"], "reason", ["stays"], _TOLD)


@query(events_sql(_DESTINATIONS + f""" SELECT 'no remedy' AS rule, coalesce(sum(CASE WHEN issue NOT IN ({', '.join(map(repr, _TOLD))}) THEN CASE WHEN case_id % 9 = 0 THEN 2 ELSE 1 END ELSE 0 END), 0)::BIGINT AS n FROM {_REASONS} UNION ALL SELECT 'no case', 0 UNION ALL SELECT 'null key', 0 UNION ALL SELECT 'repeated key', 2 * count_if(case_id % 9 = 0)::BIGINT FROM {_REASONS}"""))
def review_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract of review rows, some of which stand twice."""
    rows = _reviews(spark, sf_dir)
    return quality.violations(rows.unionByName(rows.filter("case_id % 9 = 0")), ["review_id"], {"no remedy": F.col("remedy").isNull(), "no case": F.col("case_id").isNull()})


@query(stays_sql("""SELECT reason, count(*) AS cases, count(s.case_id) AS measured FROM (SELECT case_id, unnest(list_filter([CASE WHEN bool_or(status IS NULL) THEN 'blank' END, CASE WHEN count(*) = 1 THEN 'single_stay' END, CASE WHEN count(DISTINCT account) > 1 THEN 'boundary' END, 'any'], lambda x: x IS NOT NULL)) AS reason FROM iv GROUP BY case_id) r LEFT JOIN (SELECT DISTINCT case_id FROM stays) s USING (case_id) GROUP BY reason"""))
def reasons_by_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each reason against how many of its cases are measured all the same."""
    cases = all_intervals(spark, sf_dir).groupBy("case_id").agg(F.array_compact(F.array(F.when(F.bool_or(F.col("status").isNull()), "blank"), F.when(F.count("*") == 1, "single_stay"), F.when(F.count_distinct("account") > 1, "boundary"), F.lit("any"))).alias("r"))
    measured = all_stays(spark, sf_dir).select("case_id").distinct().withColumn("m", F.lit(1))
    return cases.select("case_id", F.explode("r").alias("reason")).join(measured, "case_id", "left").groupBy("reason").agg(F.count("*").alias("cases"), F.count("m").alias("measured"))


@query(stays_sql(f"""SELECT week, count(*) AS opened, sum(deliveries)::BIGINT AS deliveries FROM (SELECT date_trunc('week', make_timestamp(min(started) {LOCAL}))::DATE AS week, count_if(role = 'delivery') AS deliveries FROM stays GROUP BY case_id)
WHERE week >= date_trunc('week', make_timestamp({CUT} {LOCAL}))::DATE - 84 AND week < date_trunc('week', make_timestamp({CUT} {LOCAL}))::DATE GROUP BY week"""))
def last_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases by the week of their opening, over the last twelve weeks that are over at the cut."""
    week = lambda at: F.trunc(C.local_day(at, ZONE), "week")
    cases = all_stays(spark, sf_dir).groupBy("case_id").agg(week(F.min("started")).alias("week"), F.count_if(F.col("role") == "delivery").alias("d"))
    now = week(F.lit(CUT))
    return cases.filter((F.col("week") >= F.date_sub(now, 84)) & (F.col("week") < now)).groupBy("week").agg(F.count("*").alias("opened"), F.sum("d").alias("deliveries"))

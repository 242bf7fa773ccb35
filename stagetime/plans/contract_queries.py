"""Registered queries of contracts: trajectories, confirmed ages, bundles of cycles, snapshots, exports, releases, frozen inputs, chains of versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import contracts, cycles, decisions, intervals, model
from ..sources import boards
from .analysis_queries import _DESTINATIONS, _destinations
from .binding import CUT, MODEL, SPEC, events_sql, intervals_sql, read, status_events, stays_sql
from .binding import intervals as all_intervals
from .binding import stays as all_stays
from .catalogue_queries import _boards
from .evidence_queries import _LIVE, _TWO, _two_accounts, live_stays
from .queries import _CYCLES, LOCAL, ZONE, query

# --- trajectories ---------------------------------------------------------------------------------

_TRAJECTORY = _TWO + """, tj AS (SELECT *, row_number() OVER w AS p, lag(started) OVER w AS ps, lag(ended) OVER w AS pe, lag(account) OVER w AS pa, lead(event_id) OVER w IS NULL AS is_last FROM ta WINDOW w AS (PARTITION BY case_id ORDER BY started, event_id)),
tl AS (SELECT case_id, count(*) AS stays, count(DISTINCT status) AS statuses, count_if(p > 1 AND pe IS DISTINCT FROM started)::BIGINT AS gaps, count_if(p > 1 AND pa <> account)::BIGINT AS boundaries, bool_and(role = 'terminal') AS only_terminal,
  list_filter([CASE WHEN bool_or(ps = started) THEN 'tied_start' END, CASE WHEN bool_or(ended < started) THEN 'ends_before_start' END, CASE WHEN bool_or(role = 'unknown') THEN 'unclassified' END, CASE WHEN bool_or(p > 1 AND pe IS DISTINCT FROM started) THEN 'no_continuity' END,
    CASE WHEN bool_or(pe > started) THEN 'overlap' END, CASE WHEN bool_or(pa <> account) THEN 'account_boundary' END, CASE WHEN count(*) = 1 THEN 'single_stay' END, CASE WHEN NOT bool_or(p = 1 AND status IS NOT DISTINCT FROM 'Intake') THEN 'start_not_observed' END,
    CASE WHEN NOT bool_or(is_last AND role = 'terminal') THEN 'end_not_observed' END], lambda x: x IS NOT NULL) AS l FROM tj GROUP BY case_id)"""


@query(events_sql(_TRAJECTORY + " SELECT case_id, stays, statuses, gaps, boundaries, only_terminal, array_to_string(l, ',') AS limits FROM tl"))
def case_trajectories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contracts.trajectories(_two_accounts(spark, sf_dir), MODEL.intake).withColumn("limits", F.array_join("limits", ","))


@query(events_sql(_TRAJECTORY + " SELECT case_id, event_id, status, is_last, stays AS case_stays, CASE WHEN len(l) > 0 THEN 'limited' ELSE 'no_limit_found' END AS trajectory, to_json(l)::VARCHAR AS limits FROM tj JOIN tl USING (case_id)"))
def stays_with_trajectory(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _two_accounts(spark, sf_dir)
    return contracts.with_trajectory(rows, contracts.trajectories(rows, MODEL.intake)).select("case_id", "event_id", "status", "is_last", "case_stays", "trajectory", "limits")


@query(events_sql(_TRAJECTORY + """ SELECT "limit", count(*) AS cases, sum(stays)::BIGINT AS stays, sum(gaps)::BIGINT AS gaps, sum(boundaries)::BIGINT AS boundaries FROM (SELECT *, unnest(list_concat(CASE WHEN len(l) = 0 THEN ['none'] ELSE l END, ['all'])) AS "limit" FROM tl) GROUP BY 1"""))
def trajectory_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contracts.trajectory_report(contracts.trajectories(_two_accounts(spark, sf_dir), MODEL.intake))


# --- open ages ------------------------------------------------------------------------------------

_CONFIRMED = _LIVE + """, co AS (SELECT *, provenance = 'open_age' AND NOT (account = 'B' AND event_id % 13 <> 0 AND event_id % 7 <> 0 AND event_id % 11 <> 0 AND event_id % 5 <> 0) AS gone FROM lv)"""


def _confirmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, n = live_stays(spark, sf_dir), F.col("event_id")
    record = _two_accounts(spark, sf_dir).filter(n % 13 != 0).select("event_id", "case_id", F.when(n % 7 != 0, "observed").alias("history"), F.col("ended").isNull().alias("is_open"), F.lit(True).alias("is_last"), F.when(n % 5 != 0, False).otherwise(F.when(n % 10 != 0, True)).alias("diverges"),
        (F.lit(CUT) - F.col("started")).alias("spent"), F.when(n % 11 != 0, SPEC.version()).otherwise("old").alias("calendar"), F.lit(CUT).alias("cut"), F.upper("status").alias("status"), "started")
    return contracts.confirmed_open(rows, record, CUT, SPEC.version(), "B")


@query(events_sql(_CONFIRMED + " SELECT case_id, event_id, CASE WHEN gone THEN 'unavailable' ELSE provenance END AS provenance, CASE WHEN NOT gone THEN spent END AS spent, no_duration OR gone AS no_duration, cycle FROM co"))
def confirmed_stays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open stays whose age the new account's record confirms at the cut; it lacks some, and others differ."""
    return _confirmed(spark, sf_dir).select("case_id", "event_id", "provenance", "spent", "no_duration", "cycle")


# --- the bundle of cycles -------------------------------------------------------------------------

_BUNDLE = _LIVE + _DESTINATIONS.removeprefix(_TWO) + """, bw AS (SELECT case_id, list_sort(list_distinct(flatten(list(list_filter([CASE WHEN estimated_transition THEN 'estimated_transition' END, CASE WHEN no_continuity THEN 'no_continuity' END, CASE WHEN account_boundary THEN 'account_boundary' END, CASE WHEN unknown_status THEN 'unknown_status' END, CASE WHEN no_duration THEN 'no_duration' END], lambda x: x IS NOT NULL))))) AS r FROM lv GROUP BY case_id),
bc AS (SELECT case_id, count(*) AS stays, arg_min(status, (started, event_id)) FILTER (WHERE role <> 'unknown') AS first_known, min(started) FILTER (WHERE status = 'Intake') AS first_intake FROM ta GROUP BY case_id),
bq AS (SELECT bc.*, array_to_string(CASE WHEN first_known IS NULL THEN ['no_known_status'] WHEN first_known <> 'Intake' THEN ['first_is_not_intake'] ELSE r END, ',') AS reasons FROM bc LEFT JOIN bw USING (case_id)),
bu AS (SELECT case_id, waited FROM ds JOIN bc USING (case_id) WHERE destination = 'queue' AND first_known = 'Intake')"""


def _bundle(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    rows = _two_accounts(spark, sf_dir).withColumn("position", F.row_number().over(intervals.in_order()))
    return rows, contracts.cycle_bundle(rows, _destinations(spark, sf_dir), MODEL, CUT)


@query(events_sql(_BUNDLE + " SELECT case_id, stays, first_known, first_intake, reasons, stays::INTEGER AS evidence FROM bq WHERE reasons <> ''"))
def bundle_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What speaks against each case, excluded or not; evidence is the number of stays that it holds."""
    return _bundle(spark, sf_dir)[1]["quality"].withColumn("evidence", F.size(F.from_json("evidence", "array<struct<position:int>>")))


@query(events_sql(_BUNDLE + """ SELECT 'passages' AS name, count(*) AS n_rows, count(DISTINCT case_id) AS cases FROM lv UNION ALL SELECT 'cycles', count(*), count(DISTINCT case_id) FROM (SELECT DISTINCT case_id, cycle FROM lv WHERE cycle IS NOT NULL)
UNION ALL SELECT 'queue', count(*), count(*) FROM bu UNION ALL SELECT 'quality', count(*), count(*) FROM bq WHERE reasons <> ''"""))
def bundle_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contracts.bundle_report(_bundle(spark, sf_dir)[1])


@query(events_sql(_BUNDLE + """, bo AS (SELECT b.case_id, first_known = 'Intake' AS a, b.case_id % 31 AS m, (SELECT count(*) FROM lv WHERE lv.case_id = b.case_id) AS n, EXISTS (SELECT 1 FROM lv WHERE lv.case_id = b.case_id AND cycle IS NOT NULL AND role = 'work') AS c, reasons <> '' AS q FROM bq b),
br AS (SELECT unnest(list_filter([CASE WHEN a AND m = 1 THEN 'lost' END, CASE WHEN a AND m IN (2, 3) THEN 'stays_differ' END, CASE WHEN NOT coalesce(a, false) AND m = 4 THEN 'queue_not_accepted' END, CASE WHEN c AND m = 5 THEN 'cycles_differ' END, CASE WHEN c AND m = 1 THEN 'cycles_differ' END, CASE WHEN q AND m = 6 THEN 'evidence_differs' END], lambda x: x IS NOT NULL)) AS rule FROM bo)
SELECT rule, count(*) AS cases FROM br GROUP BY rule"""))
def bundle_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bundle with accepted cases taken out, stays moved and doubled, an excluded case in the queue, cycles lost and evidence miscounted."""
    rows, bundle = _bundle(spark, sf_dir)
    m = F.col("case_id") % 31
    passages = bundle["passages"].filter(m != 1).withColumn("started", F.when(m == 2, F.col("started") + 1).otherwise(F.col("started")))
    twice = passages.filter((m == 3) & F.col("cycle").isNull()).unionByName(passages.filter((m == 3) & F.col("cycle").isNotNull()).withColumn("cycle", F.lit(None).cast("long")))
    other = bundle["quality"].filter("reasons in ('first_is_not_intake', 'no_known_status')").filter(m == 4).select("case_id", F.lit(0).cast("long").alias("waited"))
    planted = {
        "passages": passages.unionByName(twice), "cycles": bundle["cycles"].filter(m != 5), "queue": bundle["queue"].filter((m != 1) & (m != 4)).unionByName(other),
        "quality": bundle["quality"].withColumn("stays", F.when(m == 6, F.col("stays") + 1).otherwise(F.col("stays"))),
    }
    return contracts.bundle_violations(rows, planted, MODEL)


# --- snapshots, exports, releases, inputs ---------------------------------------------------------


@query("""SELECT 'columns' AS rule, 1::BIGINT AS n UNION ALL SELECT 'empty', 0 UNION ALL SELECT 'missing', count_if(c_custkey % 7 = 0) + count_if(c_custkey % 35 = 0)::BIGINT FROM customer UNION ALL SELECT 'id', (SELECT count_if(c_custkey <= 0) + count_if(c_custkey % 35 = 0 AND c_custkey <= 0) FROM customer) UNION ALL SELECT 'of another', count_if(c_custkey % 11 = 0) + count_if(c_custkey % 385 = 0)::BIGINT FROM customer
UNION ALL SELECT 'repeated', 2 * count_if(c_custkey % 35 = 0)::BIGINT FROM customer UNION ALL SELECT 'several instants', 1 UNION ALL SELECT 'goes back', count_if(c_custkey % 13 = 0) + count_if(c_custkey % 455 = 0)::BIGINT FROM customer""")
def snapshot_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a snapshot with blank names, another board's rows, an earlier instant, repeats, and a column that isn't declared."""
    k = F.col("c_custkey")
    rows = read(spark, sf_dir, "customer").select(k.alias("item_id"), F.when(k % 11 != 0, 7).otherwise(8).cast("long").alias("board_id"), F.when(k % 7 != 0, F.col("c_name")).alias("title"), F.when(k % 13 != 0, CUT).otherwise(CUT - 1).alias("captured_at"), F.col("c_mktsegment").alias("segment"))
    declared = {"item_id": "bigint", "board_id": "bigint", "title": "string", "captured_at": "bigint"}
    return contracts.snapshot_checks(rows.unionByName(rows.filter("item_id % 35 = 0")), declared, ("item_id", "board_id", "title"), ("item_id", "board_id"), "item_id", {"board_id": 7}, "captured_at", CUT)


@query("""SELECT CASE WHEN k % 10 <> 3 THEN CASE WHEN k % 10 <> 4 THEN k END END AS id, CASE WHEN k % 10 NOT IN (3, 5) THEN o_totalprice END AS price, CASE WHEN k % 10 NOT IN (3, 6) THEN epoch_us(o_orderdate) END AS seen_at, CASE WHEN k % 10 NOT IN (3, 7) THEN o_orderdate::DATE END AS day, CASE WHEN k % 10 <> 3 THEN o_orderpriority END AS priority,
CASE k % 10 WHEN 3 THEN '(no object)' WHEN 4 THEN 'id' WHEN 5 THEN 'price' WHEN 6 THEN 'seen_at' WHEN 7 THEN 'day' WHEN 8 THEN 'more' ELSE '' END AS problems FROM (SELECT *, o_orderkey AS k FROM orders)""")
def typed_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as lines of an export with numbers as text, two forms of time, misfits in each field, an undeclared one, and broken lines."""
    k = F.col("o_orderkey")
    time, day = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), F.date_format("o_orderdate", "yyyy-MM-dd")
    row = F.struct(
        F.when(k % 10 == 4, "x1").otherwise(k.cast("string")).alias("id"), F.when(k % 10 == 5, "dear").otherwise(F.col("o_totalprice").cast("string")).alias("price"),
        F.when(k % 10 == 6, time).when(k % 2 == 0, F.concat(time, F.lit(" UTC"))).otherwise(F.concat(time, F.lit("Z"))).alias("seen_at"), F.when(k % 10 == 7, "soon").otherwise(day).alias("day"),
        F.col("o_orderpriority").alias("priority"), F.when(k % 10 == 8, "?").alias("more"),
    )
    lines = read(spark, sf_dir, "orders").select(F.when(k % 10 == 3, F.lit('{"id":')).otherwise(F.to_json(row)).alias("value"))
    return contracts.typed_export(lines, {"id": "int", "price": "num", "seen_at": "time", "day": "date", "priority": "text"})


@query(events_sql(f"""SELECT event_type, count_if("at" < {CUT} AND status IS NOT NULL)::BIGINT AS accepted, count_if("at" < {CUT} AND status IS NULL)::BIGINT AS rejected, count_if("at" >= {CUT})::BIGINT AS late, rejected > 0 AS blocks FROM bound GROUP BY event_type"""))
def release_blockers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds of events with some that no rule gives a status: they keep a candidate from release."""
    return contracts.release_blockers(status_events(spark, sf_dir), F.col("status").isNotNull(), CUT)


_PAGES = """WITH it AS (SELECT c_custkey AS item, c_custkey // 50 AS page, c_custkey % 5 <> 0 AS present, CASE WHEN c_custkey % 7 = 0 THEN ' ' ELSE c_mktsegment END AS value FROM customer WHERE c_custkey // 50 % 6 <> 5)"""


def _frozen(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    k = F.col("c_custkey")
    page = F.floor(k / 50)
    cell = F.struct(k.alias("id"), (k % 5 != 0).alias("present"), F.when(k % 7 == 0, " ").otherwise(F.col("c_mktsegment")).alias("value"))
    pages = read(spark, sf_dir, "customer").groupBy(page.alias("page")).agg(F.collect_list(cell).alias("items"))  # of 50 items at most
    items = F.when(F.col("page") % 4 == 2, F.concat("items", F.slice("items", 1, 1))).otherwise(F.col("items"))
    pages = pages.select("page", F.lit(7).alias("board_id"), F.when(F.col("page") % 6 != 5, "old").alias("source"), (F.size("items") + (F.col("page") % 4 == 2).cast("int") + (F.col("page") % 3 == 0).cast("int")).alias("n_items"), items.alias("items"))
    return contracts.frozen_inputs(pages, 7, "old")


@query(_PAGES + " SELECT item, CASE WHEN NOT present THEN 'unverified' WHEN value = ' ' THEN 'blank' ELSE 'filled' END AS state, CASE WHEN present AND value <> ' ' THEN value END AS value FROM it")
def frozen_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _frozen(spark, sf_dir)[0]


@query(_PAGES + """ SELECT 'other origin' AS rule, count(DISTINCT c_custkey // 50)::BIGINT AS n FROM customer WHERE c_custkey // 50 % 6 = 5 UNION ALL SELECT 'items differ', count(DISTINCT page) FROM it WHERE page % 3 = 0 UNION ALL SELECT 'repeated item', count(DISTINCT page) FROM it WHERE page % 4 = 2""")
def frozen_input_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of which some are of another origin, some claim an item too many, and some hold one twice."""
    return _frozen(spark, sf_dir)[1]


_REVIEWED = """WITH rv AS (SELECT p_partkey, p_name, concat_ws(',', CASE WHEN p_partkey % 13 = 0 THEN 'no_alias' END, CASE WHEN p_partkey % 5 > 1 THEN 'not_reviewed' END, CASE WHEN p_partkey % 7 = 0 THEN 'no_instant' END, CASE WHEN p_partkey % 7 <> 0 AND p_partkey % 11 = 0 THEN 'after_now' END) AS reasons FROM part)"""


def _reviewed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    k = F.col("p_partkey")
    status = F.when(k % 5 == 0, "approved").when(k % 5 == 1, "quarantined").when(k % 5 == 2, "pending").when(k % 5 == 3, " approved")
    at = F.when(k % 7 == 0, "2024-01-05T10:00:00").when(k % 11 == 0, "2024-02-01T00:00:00Z").otherwise("2024-01-05T10:00:00-03:00")
    raw = read(spark, sf_dir, "part").select(F.lit("brand").alias("entity_type"), F.when(k % 13 == 0, " ").otherwise(F.concat(F.lit("  "), F.upper("p_name"), F.lit(" "), k.cast("string"))).alias("source_text"), k.cast("string").alias("canonical_id"), F.col("p_name").alias("canonical_name"), F.lit("company").alias("entity_kind"), status.alias("review_status"), at.alias("updated_at"))
    return decisions.reviewed(raw.unionByName(raw.filter("canonical_id like '%0'")), CUT)


@query(_REVIEWED + " SELECT lower(p_name) || ' ' || p_partkey AS source_key, p_partkey::VARCHAR AS canonical_id, CASE p_partkey % 5 WHEN 0 THEN 'approved' ELSE 'quarantined' END AS review_status, 1704459600000000 AS decided_at FROM rv WHERE reasons = ''")
def reviewed_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions of reviewers' files: those that may enter the catalogue, each once."""
    return _reviewed(spark, sf_dir)[0].select("source_key", "canonical_id", "review_status", "decided_at")


@query(_REVIEWED + " SELECT reasons, (count(*) + count_if(p_partkey % 10 = 0))::BIGINT AS n FROM rv WHERE reasons <> '' GROUP BY reasons")
def refused_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reviewed(spark, sf_dir)[1].groupBy("reasons").agg(F.count("*").alias("n"))


# --- chains of versions, labels of the board ------------------------------------------------------


@query(stays_sql("""SELECT 'v2' AS step, 'columns' AS "check", 0::BIGINT AS n UNION ALL SELECT 'v3', 'columns', 2 UNION ALL SELECT 'v4', 'columns', 1 UNION ALL SELECT 'v2', 'lost', 0 UNION ALL SELECT 'v2', 'new', 0 UNION ALL SELECT 'v2', 'changed', count_if(case_id % 41 = 2)::BIGINT FROM cyc
UNION ALL SELECT 'v3', 'lost', count_if(case_id % 41 = 3)::BIGINT FROM cyc UNION ALL SELECT 'v3', 'new', 0 UNION ALL SELECT 'v3', 'changed', 0 UNION ALL SELECT 'v4', 'lost', 0 UNION ALL SELECT 'v4', 'new', count_if(case_id % 41 = 4)::BIGINT FROM cyc UNION ALL SELECT 'v4', 'changed', count_if(case_id % 41 = 5)::BIGINT FROM cyc""", _CYCLES))
def version_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four versions of the cycles: each adds a column, and one changes, loses, or makes up cycles, or renames what it declared."""
    m = F.col("case_id") % 41
    v1 = cycles.cycle_table(all_stays(spark, sf_dir)).drop("worked")
    v2 = v1.withColumn("started", F.when(m == 2, F.col("started") + 1).otherwise(F.col("started"))).withColumn("days", F.floor((F.col("closed") - F.col("started")) / 86_400_000_000))
    v3 = v2.filter(m != 3).withColumn("hours", F.col("days") * 24)
    v4 = v3.withColumn("days", F.when(m == 5, F.lit(-1)).otherwise(F.col("days"))).withColumn("note", F.lit("x")).drop("ending")
    v4 = v4.unionByName(v4.filter(m == 4).withColumn("case_id", -1 - F.col("case_id")))
    return contracts.upgrade_chain([("v1", v1, []), ("v2", v2, ["days"]), ("v3", v3, ["minutes"]), ("v4", v4, ["note"])], ["case_id", "cycle"])


_LABELS = "lb AS (SELECT DISTINCT label FROM (SELECT '  ' || upper(status) AS label FROM bound WHERE status IS NOT NULL AND k % 3 <> 1 AND event_id % 4 = 0 AND event_type <> 'click' UNION ALL SELECT unnest(['Open in ' || r_name, 'Done in ' || r_name, 'Paused', 'Never']) FROM region))"


@query(intervals_sql(f"""{', ' + _LABELS}, sd AS (SELECT status, role, count(*) AS uses, count_if(started >= {CUT - 365 * 86_400_000_000})::BIGINT AS uses_in_365_days, count_if(year(make_timestamp(started {LOCAL})) = 2024)::BIGINT AS uses_this_year, count(DISTINCT case_id) AS cases, min(started) AS first_use, max(started) AS last_use FROM iv WHERE status IS NOT NULL GROUP BY status, role),
lk AS (SELECT lower(trim(label)) AS key, min(label) AS label FROM lb GROUP BY 1)
SELECT coalesce(status, label) AS status, role, coalesce(uses, 0) AS uses, coalesce(uses_in_365_days, 0) AS uses_in_365_days, coalesce(uses_this_year, 0) AS uses_this_year, coalesce(cases, 0) AS cases, first_use, last_use, label IS NOT NULL AS on_board FROM sd FULL JOIN lk ON key = lower(status)"""))
def labelled_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statuses that were used, and the labels of all boards, in other writing, that nothing has used."""
    told = boards.board_columns(_boards(spark, sf_dir)).filter("column_id = 's1'").select(F.explode(F.map_values("labels")).alias("label"))
    k = F.col("k")
    used = status_events(spark, sf_dir).filter("status is not null and event_id % 4 = 0 and event_type <> 'click'").filter(k % 3 != 1).select(F.concat(F.lit("  "), F.upper("status")).alias("label"))
    return contracts.labelled_dimension(model.status_dimension(all_intervals(spark, sf_dir), ZONE, CUT), told.unionByName(used))

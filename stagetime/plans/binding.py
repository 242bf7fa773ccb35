"""How the given tables become a status log: events are changes, a user's five days are a case."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CalendarSpec, StatusModel
from ..functions.columns import micros
from ..operators.cycles import assign_cycles, gate
from ..operators.intervals import build_intervals

#: 2024-01-31 00:00 in Sao Paulo.
CUT = 1_706_670_000_000_000
MODEL, SPEC = StatusModel(), CalendarSpec()


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def status_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """case_id, event_id, at (microseconds), account, status, user_id."""
    k = F.get_json_object("props", "$.k").cast("long")
    kind = F.col("event_type")
    status = F.when(kind == "signup", "Intake").when(kind == "view", F.when(k % 2 == 0, "Drafting").otherwise("In review"))
    status = status.when(kind == "click", F.when(k % 3 == 0, "Standby").when(k % 3 == 1, "Waiting on brand").otherwise("Drafting"))
    status = status.when(kind == "purchase", "Awaiting feedback").when((kind == "error") & (k % 5 != 0), F.when(k % 5 == 1, "Approved").when(k % 5 == 2, "Declined").when(k % 5 == 3, "No return").otherwise("Closed"))
    case = F.col("user_id") * 10 + F.floor((F.dayofmonth("ts") - 1) / 5)
    account = F.when(F.col("ts") < F.expr("TIMESTAMP_NTZ'2024-01-16 00:00:00'"), "A").otherwise("B")
    return read(spark, sf_dir, "events").select(case.alias("case_id"), "event_id", micros("ts").alias("at"), account.alias("account"), status.alias("status"), "user_id", k.alias("k"), "event_type")


def intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_intervals(status_events(spark, sf_dir), CUT).withColumn("role", MODEL.role(F.col("status")))


def stays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stays of measured cases with their cycles."""
    return assign_cycles(gate(intervals(spark, sf_dir), MODEL.intake))


#: The same in DuckDB SQL, as a chain of common table expressions.
_EVENTS = """
ev AS (SELECT event_id, user_id, epoch_us(ts) AS "at", user_id * 10 + (day(ts) - 1) // 5 AS case_id, event_type,
       CASE WHEN ts < TIMESTAMP '2024-01-16 00:00:00' THEN 'A' ELSE 'B' END AS account, (props->>'$.k')::BIGINT AS k FROM events),
bound AS (SELECT *, CASE event_type WHEN 'signup' THEN 'Intake' WHEN 'purchase' THEN 'Awaiting feedback'
       WHEN 'view' THEN CASE WHEN k % 2 = 0 THEN 'Drafting' ELSE 'In review' END
       WHEN 'click' THEN CASE k % 3 WHEN 0 THEN 'Standby' WHEN 1 THEN 'Waiting on brand' ELSE 'Drafting' END
       WHEN 'error' THEN CASE k % 5 WHEN 1 THEN 'Approved' WHEN 2 THEN 'Declined' WHEN 3 THEN 'No return' WHEN 4 THEN 'Closed' END END AS status FROM ev)"""
_INTERVALS = (
    _EVENTS
    + f""",
marked AS (SELECT *, row_number() OVER w AS rn, lag(status) OVER w AS was FROM bound WHERE "at" < {CUT} WINDOW w AS (PARTITION BY case_id ORDER BY "at", event_id)),
changed AS (SELECT * FROM marked WHERE rn = 1 OR was IS DISTINCT FROM status),
iv AS (SELECT case_id, event_id, account, status, "at" AS started, lead("at") OVER w AS ended, row_number() OVER w AS position,
       row_number() OVER (PARTITION BY case_id, status ORDER BY "at", event_id) AS visit, coalesce(lead("at") OVER w, {CUT}) AS seen_until,
       CASE WHEN status IN ('Intake', 'Drafting', 'In review') THEN 'work' WHEN status = 'Waiting on brand' THEN 'waiting' WHEN status = 'Standby' THEN 'standby'
            WHEN status = 'Awaiting feedback' THEN 'delivery' WHEN status IN ('Closed', 'Approved', 'Declined', 'No return') THEN 'terminal' ELSE 'unknown' END AS role
       FROM changed WINDOW w AS (PARTITION BY case_id ORDER BY "at", event_id))"""
)
_STAYS = (
    _INTERVALS
    + """,
known AS (SELECT case_id, min(position) AS p FROM iv WHERE role <> 'unknown' GROUP BY case_id),
entered AS (SELECT iv.* FROM iv JOIN known k USING (case_id) JOIN iv f ON f.case_id = iv.case_id AND f.position = k.p WHERE f.status = 'Intake' AND iv.position >= k.p),
gated AS (SELECT e.* FROM entered e WHERE e.role <> 'terminal' OR NOT EXISTS (SELECT 1 FROM entered l WHERE l.case_id = e.case_id AND l.position > e.position AND l.role <> 'terminal')),
seg AS (SELECT *, (SELECT count(*) FROM gated c WHERE c.case_id = g.case_id AND c.position < g.position AND c.role IN ('delivery', 'terminal')) AS segment FROM gated g),
opens AS (SELECT case_id, segment, min(position) AS first_work, dense_rank() OVER (PARTITION BY case_id ORDER BY segment) AS number FROM seg WHERE role = 'work' GROUP BY case_id, segment),
stays AS (SELECT s.*, CASE WHEN s.position >= o.first_work AND s.role NOT IN ('delivery', 'terminal') THEN o.number END AS cycle,
          CASE WHEN s.position >= o.first_work AND s.role NOT IN ('delivery', 'terminal') THEN CASE WHEN o.number = 1 THEN 'first' ELSE 'rework' END END AS kind
          FROM seg s LEFT JOIN opens o USING (case_id, segment))"""
)


def events_sql(query: str) -> str:
    return f"WITH {_EVENTS.strip()} {query}"


def intervals_sql(query: str) -> str:
    return f"WITH {_INTERVALS.strip()} {query}"


def stays_sql(query: str, more: str = "") -> str:
    return f"WITH {_STAYS.strip()}{more} {query}"

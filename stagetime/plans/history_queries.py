"""Registered queries of history and questions: earlier cuts, closing totals, summaries, flags, clocks, cross tables, samples, stages by week."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import cycles, intervals, model, quantiles
from .analysis_queries import _mean
from .binding import CUT, MODEL, SPEC, intervals_sql, stays_sql
from .binding import intervals as all_intervals
from .binding import stays as all_stays
from .model_queries import _business_of
from .queries import _CYCLES, _PROJECTS, _SNAPSHOTS, LOCAL, ZONE, _snapshots, query

_EARLIER = 1_705_708_800_000_000  # 2024-01-20 UTC


@query(intervals_sql(f"SELECT case_id, event_id, status, started, CASE WHEN ended < {_EARLIER} THEN ended END AS ended, position, visit, CASE WHEN ended < {_EARLIER} THEN ended ELSE {_EARLIER} END AS seen_until FROM iv WHERE started < {_EARLIER}"))
def stays_at_earlier_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.close_at(all_intervals(spark, sf_dir), _EARLIER).select("case_id", "event_id", "status", "started", "ended", "position", "visit", "seen_until")


@query(intervals_sql(""", r AS (SELECT *, coalesce(lag(role) OVER w = 'terminal' AND lag(ended) OVER w = started AND role NOT IN ('terminal', 'unknown'), false) AS reopening FROM iv WINDOW w AS (PARTITION BY case_id, account ORDER BY started, event_id)),
c AS (SELECT *, 1 + sum(reopening::INT) OVER (PARTITION BY case_id, account ORDER BY started, event_id) AS cycle_number FROM r),
g AS (SELECT *, row_number() OVER w AS n, CASE WHEN row_number() OVER w > 1 AND lag(ended) OVER w IS DISTINCT FROM started THEN 1 ELSE 0 END AS gap, role = 'terminal' AND row_number() OVER (PARTITION BY case_id, account, cycle_number, role ORDER BY started, event_id) = 1 AS closes FROM c WINDOW w AS (PARTITION BY case_id, account, cycle_number ORDER BY started, event_id)),
t AS (SELECT *, sum(gap) OVER w AS gaps, min(started) OVER w AS f FROM g WINDOW w AS (PARTITION BY case_id, account, cycle_number ORDER BY started, event_id ROWS UNBOUNDED PRECEDING))
SELECT case_id, account, cycle_number::BIGINT AS cycle_number, started AS closed_at, CASE WHEN gaps = 0 THEN started - f END AS total, n AS stays FROM t WHERE closes"""))
def closing_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.closing_totals(intervals.closures(all_intervals(spark, sf_dir)))


_SUMMARY = f""", sm AS (SELECT case_id, min(CASE WHEN status = 'Intake' THEN started END) AS first_intake, CASE WHEN arg_max(role, position) = 'terminal' THEN arg_max(started, position) END AS finished FROM iv GROUP BY case_id),
sk AS (SELECT *, CASE WHEN finished >= first_intake THEN finished END AS k FROM sm), sx AS (SELECT case_id, 0 AS event_id, first_intake AS started, k AS seen_until FROM sk WHERE k IS NOT NULL), sb AS ({_business_of("sx")})"""


@query(intervals_sql(_SUMMARY + " SELECT case_id, first_intake, finished, k - first_intake AS lead, CASE WHEN k IS NOT NULL THEN coalesce(business, 0)::BIGINT END AS lead_business FROM sk LEFT JOIN sb USING (case_id)"))
def sla_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.sla_summary(all_intervals(spark, sf_dir), MODEL.intake, SPEC)


@query(intervals_sql(f'{_SNAPSHOTS} SELECT case_id, min("at") AS first_seen, max("at") AS seen_at, arg_max(event_type, "at") AS event_type, arg_max(k, "at") AS k FROM snap WHERE "at" <= {_EARLIER} GROUP BY case_id'))
def item_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items with the attributes that they had at an earlier cut."""
    return intervals.latest(_snapshots(spark, sf_dir), _EARLIER, ["event_type", "k"])


@query(intervals_sql("SELECT case_id, event_id, position = 1 AS is_first, position = max(position) OVER (PARTITION BY case_id) AS is_last, visit > 1 AS returns, role IN ('work', 'waiting') AND ended IS NOT NULL AND status IS NOT NULL AND ended > started AS eligible FROM iv"))
def gold_stays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.gold(all_intervals(spark, sf_dir), ("work", "waiting")).select("case_id", "event_id", "is_first", "is_last", "returns", F.coalesce("eligible", F.lit(False)).alias("eligible"))


@query(intervals_sql(f"""SELECT case_id, status, make_timestamp(d)::DATE AS day, sum(least(seen_until {LOCAL}, d + 86400000000) - greatest(started {LOCAL}, d))::BIGINT AS spent
FROM (SELECT *, unnest(range((started {LOCAL}) // 86400000000, (seen_until - 1 {LOCAL}) // 86400000000 + 1)) * 86400000000 AS d FROM iv WHERE seen_until > started AND role <> 'terminal') GROUP BY case_id, status, d"""))
def open_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of stays that aren't terminal: a closed case stays closed for ever, which is no work."""
    return intervals.split_days(all_intervals(spark, sf_dir), ZONE, MODEL.terminal)


_CLOCKS = f""", cz AS (SELECT case_id, cycle AS event_id, started, closed AS seen_until FROM cyc WHERE closed IS NOT NULL), cb AS ({_business_of("cz")})"""


@query(stays_sql("SELECT kind, state, count(*) AS cycles, round(avg((closed - started)::DOUBLE), 3) AS mean_us, round(avg(CASE WHEN closed IS NOT NULL THEN coalesce(business, 0) END::DOUBLE), 3) AS mean_business, round(quantile_cont(CASE WHEN closed IS NOT NULL THEN coalesce(business, 0) END::DOUBLE, 0.5), 3) AS median_business FROM cyc LEFT JOIN cb ON cb.case_id = cyc.case_id AND cb.event_id = cyc.cycle GROUP BY kind, state", _CYCLES + _CLOCKS))
def delivery_clocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time to deliver by kind of cycle on both clocks."""
    rows = cycles.cycle_table(all_stays(spark, sf_dir)).withColumn("took", F.col("closed") - F.col("started")).withColumn("business", C.business_micros(F.col("started"), F.col("closed"), SPEC))
    got = rows.groupBy("kind", "state").agg(F.count("*").alias("cycles"), _mean("took", "mean_us"), _mean("business", "mean_business"))
    return quantiles.with_quantiles(got, rows, ("kind", "state"), F.col("business").cast("double"), {"median_business": 0.5})


@query(stays_sql("""SELECT brand, talent, count(*) AS cases, sum(deliveries)::BIGINT AS deliveries, sum(n)::BIGINT AS stays FROM (SELECT case_id, 'Brand ' || case_id % 5 AS brand, 'Talent ' || case_id // 10 % 4 AS talent, count_if(role = 'delivery') AS deliveries, count(*) AS n FROM stays GROUP BY case_id) GROUP BY GROUPING SETS ((brand, talent), (brand), ())"""))
def brand_by_talent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases by brand and talent, by brand, and in all."""
    case = F.col("case_id")
    cases = all_stays(spark, sf_dir).groupBy("case_id").agg(F.count_if(F.col("role") == "delivery").alias("d"), F.count("*").alias("n"))
    rows = cases.select(F.concat(F.lit("Brand "), (case % 5).cast("string")).alias("brand"), F.concat(F.lit("Talent "), (F.floor(case / 10) % 4).cast("string")).alias("talent"), "d", "n")
    got = rows.groupingSets([["brand", "talent"], ["brand"], []], "brand", "talent").agg(F.count("*").alias("cases"), F.sum("d").alias("deliveries"), F.sum("n").alias("stays"))
    return got.select("brand", "talent", "cases", "deliveries", "stays")


@query(stays_sql("""SELECT accounts, rank::INTEGER AS rank, case_id, stays FROM (SELECT *, row_number() OVER (PARTITION BY accounts ORDER BY stays DESC, case_id) AS rank FROM (SELECT case_id, string_agg(DISTINCT account, '+' ORDER BY account) AS accounts, count(*) AS stays FROM stays GROUP BY case_id)) WHERE rank <= 3"""))
def account_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three longest cases of each account and of both, to look at."""
    cases = all_stays(spark, sf_dir).groupBy("case_id").agg(F.array_join(F.array_sort(F.collect_set("account")), "+").alias("accounts"), F.count("*").alias("stays"))
    best = Window.partitionBy("accounts").orderBy(F.desc("stays"), "case_id")
    return cases.withColumn("rank", F.row_number().over(best)).filter("rank <= 3").select("accounts", "rank", "case_id", "stays")


_WEEKS = f""", wz AS (SELECT case_id, event_id, started, ended AS seen_until FROM stays WHERE ended IS NOT NULL), wb AS ({_business_of("wz")})"""


@query(stays_sql(f"""SELECT date_trunc('week', make_timestamp(s.started {LOCAL}))::DATE AS week, status, count(*) AS stays, count(ended) AS closed, round(avg(CASE WHEN ended IS NOT NULL THEN coalesce(business, 0) END::DOUBLE), 3) AS mean_business, round(avg((ended - s.started)::DOUBLE), 3) AS mean_us
FROM stays s LEFT JOIN wb USING (case_id, event_id) WHERE status IS NOT NULL AND role IN ('work', 'waiting') GROUP BY 1, 2""", _WEEKS))
def stages_by_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = all_stays(spark, sf_dir).filter("status is not null and role in ('work', 'waiting')").withColumn("business", C.business_micros(F.col("started"), F.col("ended"), SPEC)).withColumn("took", F.col("ended") - F.col("started"))
    return rows.groupBy(F.trunc(C.local_day(F.col("started"), ZONE), "week").alias("week"), "status").agg(F.count("*").alias("stays"), F.count("ended").alias("closed"), _mean("business", "mean_business"), _mean("took", "mean_us"))


_STATES = _PROJECTS + f""", yz AS (SELECT case_id, 0 AS event_id, opened AS started, first_delivery AS seen_until FROM proj WHERE first_delivery IS NOT NULL), yb AS ({_business_of("yz")})"""


@query(stays_sql("SELECT state, count(*) AS cases, count(first_delivery) AS delivered, round(quantile_cont(CASE WHEN first_delivery IS NOT NULL THEN coalesce(business, 0) END::DOUBLE, 0.5), 3) AS median_business FROM proj LEFT JOIN yb USING (case_id) GROUP BY state", _STATES))
def state_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases and the median business time to the first delivery by state."""
    rows = model.projects(all_stays(spark, sf_dir), CUT).withColumn("business", C.business_micros(F.col("opened"), F.col("first_delivery"), SPEC))
    got = rows.groupBy("state").agg(F.count("*").alias("cases"), F.count("first_delivery").alias("delivered"))
    return quantiles.with_quantiles(got, rows, ("state",), F.col("business").cast("double"), {"median_business": 0.5})

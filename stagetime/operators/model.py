"""The consumption model: project, cycle, daily, reference, alert, monthly, coverage and dimension tables."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import SEPARATORS, CalendarSpec
from ..functions.columns import business_micros, folded, local_day, strict_sum
from .intervals import by_case, day_start, in_order
from .quantiles import quantiles, running_total, with_quantiles

DAY = 86_400_000_000


def projects(stays: DataFrame, cut: int) -> DataFrame:
    """One row for each case: where it stands, how often it was delivered, how long it took."""
    last = F.max_by(F.struct("status", "role", "started", "ended"), "position")
    out = stays.groupBy("case_id").agg(
        F.min("started").alias("opened"), F.count("*").alias("stays"), F.sum((F.col("role") == "delivery").cast("long")).alias("deliveries"),
        F.count_distinct("cycle").alias("cycles"), F.min(F.when(F.col("role") == "delivery", F.col("started"))).alias("first_delivery"), last.alias("l"),
        F.array_join(F.array_sort(F.collect_set("account")), "+").alias("accounts"),
    )
    state = F.when(F.col("l.role") == "terminal", "closed").when(F.col("l.role") == "delivery", "delivered").when(F.col("l.role").isin("standby", "waiting"), "waiting").when(F.col("l.role") == "unknown", "unknown").otherwise("working")
    age = F.when(F.col("l.role") != "terminal", F.lit(cut) - F.col("l.started"))
    return out.select("case_id", "opened", "stays", "deliveries", "cycles", "first_delivery", (F.col("first_delivery") - F.col("opened")).alias("to_first_delivery"), "accounts", F.col("l.status").alias("status"), state.alias("state"), age.alias("age"))


def time_by_status(stays: DataFrame) -> DataFrame:
    """Visits and stays of each case in each status, and the null-strict total of what is closed."""
    visit = F.coalesce((F.lag("position").over(Window.partitionBy("case_id", "status").orderBy("position")) != F.col("position") - 1).cast("int"), F.lit(1))
    rows = stays.withColumn("_v", visit)
    return rows.groupBy("case_id", "status").agg(F.sum("_v").alias("visits"), F.count("*").alias("stays"), strict_sum(F.col("ended") - F.col("started")).alias("total"))


def standby(stays: DataFrame) -> DataFrame:
    """Standby stays with the status that the case came from."""
    came = F.last(F.when(F.col("role") != "standby", F.struct("status")), ignorenulls=True).over(in_order().rowsBetween(Window.unboundedPreceding, -1))
    return stays.withColumn("_p", came).filter("role = 'standby'").select("case_id", "position", "started", (F.col("seen_until") - F.col("started")).alias("spent"), F.col("_p.status").alias("came_from"), F.col("ended").isNull().alias("is_open"))


def ongoing(stays: DataFrame, cut: int) -> DataFrame:
    """Open stays that aren't terminal, with their age at the cut."""
    return stays.filter("ended is null and role <> 'terminal'").select("case_id", "status", "role", "started", (F.lit(cut) - F.col("started")).alias("age"))


def daily(stays: DataFrame, spec: CalendarSpec, cut: int) -> DataFrame:
    """One row for each case and local day from its opening to its end: how it stood when the day was over.

    A case that ended with a terminal stay has its last row on that stay's day, any other one on the day
    before the cut.  status is that of the last stay begun by then; worked is the business time of work in
    cycles up to the end of the day, and null from the day on which a stay of unknown status began to count;
    since_opened is the business time since the opening; state is open but on the last day of a closed case.
    """
    zone = spec.zone
    case = stays.groupBy("case_id").agg(F.min("started").alias("opened"), F.max_by(F.struct("role", "started"), "position").alias("l"))
    closed = F.col("l.role") == "terminal"
    case = case.select("case_id", "opened", closed.alias("closed"), F.when(closed, F.col("l.started")).otherwise(F.lit(cut)).alias("stop"))
    first, last = local_day(F.col("opened"), zone), local_day(F.col("stop") - F.when(F.col("closed"), 0).otherwise(1), zone)
    spine = case.select("*", F.explode(F.sequence(first, F.greatest(first, last))).alias("day"), F.greatest(first, last).alias("last_day"))

    begun = stays.withColumn("day", local_day(F.col("started"), zone)).groupBy("case_id", "day").agg(F.max_by(F.struct("status"), "position").alias("s"), F.count_if(F.col("role") == "delivery").alias("d"), F.count_if((F.col("role") == "unknown") & F.col("cycle").isNotNull()).alias("u"))
    work = stays.filter("role = 'work' and cycle is not null and seen_until > started")
    days = F.sequence(local_day(F.col("started"), zone), local_day(F.col("seen_until") - 1, zone))
    pieces = work.select("case_id", "started", "seen_until", F.explode(days).alias("day"))
    inside = business_micros(F.greatest("started", day_start(F.col("day"), zone)), F.least("seen_until", day_start(F.date_add("day", 1), zone)), spec)
    spent = pieces.select("case_id", "day", inside.alias("w")).groupBy("case_id", "day").agg(strict_sum(F.col("w")).alias("w"))

    rows = spine.join(begun, ["case_id", "day"], "left").join(spent, ["case_id", "day"], "left")
    order = by_case().orderBy("day")
    unknown = F.sum(F.coalesce("u", F.lit(0))).over(order) > 0
    end = F.least(F.col("stop"), day_start(F.date_add("day", 1), zone))
    return rows.select(
        "case_id", "day", F.last("s", ignorenulls=True).over(order)["status"].alias("status"), F.sum(F.coalesce("d", F.lit(0))).over(order).alias("deliveries_to_date"),
        F.when(~unknown, F.sum(F.coalesce("w", F.lit(0))).over(order)).alias("worked"), business_micros(F.col("opened"), end, spec).alias("since_opened"),
        F.when(F.col("closed") & (F.col("day") == F.col("last_day")), "closed").otherwise("open").alias("state"),
        (business_micros(day_start(F.col("day"), zone), day_start(F.date_add("day", 1), zone), spec) > 0).alias("is_business_day"),
    )


def grow(dimension: DataFrame, seen: DataFrame, scope: str, terminal: tuple[str, ...], run: int) -> DataFrame:
    """dimension(status_id, label, label_key, is_terminal, since) with what seen(index, label) has and it hasn't.

    An id is the scope and the status' index, or, without one, a hash of the folded label.  What is there
    stays as it is, whatever the label reads now; of several new labels of one id the least one enters.
    """
    key = folded(F.coalesce(F.nullif(F.trim("label"), F.lit("")), F.lit("No status")))
    suffix = F.coalesce(F.col("index").cast("string"), F.concat(F.lit("label_"), F.substring(F.sha2(key, 256), 1, 16)))
    named = seen.select(F.concat(F.lit(f"{scope}:"), suffix).alias("status_id"), F.coalesce(F.nullif(F.trim("label"), F.lit("")), F.lit("No status")).alias("label"))
    new = named.groupBy("status_id").agg(F.min("label").alias("label")).join(dimension.select("status_id"), "status_id", "left_anti")
    label_key = folded(F.col("label"))
    return dimension.unionByName(new.select("status_id", "label", label_key.alias("label_key"), label_key.isin(*[t.lower() for t in terminal]).alias("is_terminal"), F.lit(run).alias("since")))


def delivery_times(projects: DataFrame) -> DataFrame:
    """Percent rank, band and box-plot outlier of the time to the first delivery."""
    done = projects.filter("to_first_delivery is not null").select("case_id", "to_first_delivery")
    counts = done.groupBy("to_first_delivery").agg(F.count("*").alias("n"))
    below = running_total(counts, "to_first_delivery", "n")
    box = quantiles(done, (), F.col("to_first_delivery"), {"p25": 0.25, "p75": 0.75}, 9).select("p25", "p75")
    rows = done.join(below, "to_first_delivery").crossJoin(F.broadcast(box))  # one row
    days = F.col("to_first_delivery") / DAY
    band = F.when(days < 1, "under a day").when(days < 7, "under a week").otherwise("a week or more")
    return rows.select("case_id", "to_first_delivery", (F.col("upto") * 100.0 / F.col("total")).alias("percent_rank"), band.alias("band"), (F.col("to_first_delivery") > F.col("p75") + 1.5 * (F.col("p75") - F.col("p25"))).alias("outlier"))


def references(stays: DataFrame, cut: int, days: int = 365, least: int = 15) -> DataFrame:
    """P50, P80 and P90 by status over the stays of with_responses(...) that began in the days before the cut, null under least samples.

    Samples are closed work and waiting stays, and deliveries whose response counts: an automatic closing
    would measure the automation.
    """
    recent = (F.col("ended").isNotNull()) & (F.col("started") >= cut - days * DAY)
    answered = (F.col("role") == "delivery") & F.col("counts") & (F.col("outcome") != "waiting")
    own = stays.filter(recent & (F.col("role").isin("work", "waiting") | answered)).select("status", "started", "ended")
    got = quantiles(own, ("status",), F.col("ended") - F.col("started"), {"p50": 0.5, "p80": 0.8, "p90": 0.9})
    return got.select("status", F.col("n").alias("samples"), *[F.when(F.col("n") >= least, F.col(p)).alias(p) for p in ("p50", "p80", "p90")])


def alerts(open_stays: DataFrame, references: DataFrame) -> DataFrame:
    """Level of each open stay against its status' reference; unknown where there is none."""
    rows = open_stays.join(references, "status", "left")
    level = F.when(F.col("p80").isNull(), "unknown").when(F.col("age") > F.col("p90"), "critical").when(F.col("age") > F.col("p80"), "attention").otherwise("ok")
    return rows.select("case_id", "status", "age", level.alias("level"))


def bottlenecks(stays: DataFrame, zone: str) -> DataFrame:
    """By month of start and status: stays, closed ones, mean and median time."""
    value = (F.col("ended") - F.col("started")).cast("double")
    rows = stays.filter("status is not null").select(F.trunc(local_day(F.col("started"), zone), "month").alias("month"), "status", "started", "ended")
    got = rows.groupBy("month", "status").agg(F.count("*").alias("stays"), F.count("ended").alias("closed"), F.round(F.avg(value), 3).alias("mean_us"))
    return with_quantiles(got, rows, ("month", "status"), value, {"median_us": 0.5})


def by_month(populations: dict[str, tuple[DataFrame, Column]]) -> DataFrame:
    """Counts of several populations, each by its own date, side by side by month."""
    parts = [df.groupBy(F.trunc(day, "month").alias("month")).agg(F.count("*").alias("n")).select("month", F.lit(name).alias("what"), "n") for name, (df, day) in populations.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("month").agg(*[F.coalesce(F.sum(F.when(F.col("what") == name, F.col("n"))), F.lit(0)).alias(name) for name in populations])


def coverage(sources: list[tuple[str, DataFrame]]) -> DataFrame:
    """Each case counted once, in the first of the sources that has it."""
    parts = [df.select("case_id", F.lit(i).alias("rank")) for i, (_, df) in enumerate(sources)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    names = F.array(*[F.lit(n) for n, _ in sources])
    return out.groupBy("case_id").agg(F.min("rank").alias("rank")).groupBy(F.element_at(names, F.col("rank") + 1).alias("source")).agg(F.count("*").alias("cases"))


def status_dimension(intervals: DataFrame, zone: str, cut: int) -> DataFrame:
    """Use of each status: in all, in the 365 days before the cut and in its year; first and last use."""
    last = local_day(F.lit(cut - 1), zone)
    recent, this_year = F.col("started") >= cut - 365 * DAY, F.year(local_day(F.col("started"), zone)) == F.year(last)
    return intervals.filter("status is not null").groupBy("status", "role").agg(
        F.count("*").alias("uses"), F.count_if(recent).alias("uses_in_365_days"), F.count_if(this_year).alias("uses_this_year"), F.count_distinct("case_id").alias("cases"), F.min("started").alias("first_use"), F.max("started").alias("last_use")
    )


def calendar(first: Column, last: Column, one_row: DataFrame, spec: CalendarSpec) -> DataFrame:
    """One row for each day: parts of the date, the holiday's name, whether it is a business day, the calendar's version."""
    names = spec.named_holidays()
    known = F.from_json(F.lit(json.dumps({str(d): n for d, n in names.items()})), "map<string,string>")
    days = one_row.select(F.explode(F.sequence(first, last)).alias("day")).withColumn("holiday", F.try_element_at(known, F.col("day").cast("string")))
    parts = F.year("day").alias("year"), F.month("day").alias("month"), F.weekofyear("day").alias("iso_week"), F.extract(F.lit("YEAROFWEEK"), "day").cast("int").alias("iso_year"), (F.weekday("day") + 1).alias("iso_weekday")
    return days.select("day", *parts, "holiday", ((F.weekday("day") < 5) & F.col("holiday").isNull()).alias("is_business_day"), F.lit(spec.version()).alias("version"))


def name_bridge(rows: DataFrame, key: str, names: str) -> DataFrame:
    """key and each name of a list in one text, split at commas, semicolons, plus signs, line ends, & and /."""
    return rows.select(key, F.explode(F.split(names, SEPARATORS)).alias("name")).select(key, F.trim("name").alias("name")).filter("name <> ''").distinct()

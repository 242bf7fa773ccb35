"""Where every item goes: adapters of native items, routing of cases, copies, pools, completion, and all filling errors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import CalendarSpec, StatusModel
from ..functions.columns import DAY, business_micros, folded
from . import portfolio, rules
from .cycles import assign_cycles, gate
from .intervals import by_case, in_order

#: Reasons that send a case to the pool of several persons instead of excluding it.
POOL = ("several", "squad", "collective")
#: Severity of each filling error: error, attention (to be looked at) or process (the way of working).
ERRORS = {
    "starts_without_intake": "error", "terminal_in_middle": "error", "status_without_label": "error", "delivered_without_work": "attention", "repeated_intake": "attention",
    "response_not_recorded": "process", "stuck_in_standby": "attention", "born_as_copy": "attention", "ambiguous_original": "attention",
    "none": "error", "several": "process", "both_columns": "error", "squad": "process", "brand_blank": "error", "input_blank": "attention", "owner_blank": "attention",
}


def register_reasons(title: Column, kind: Column, names: Column, other: Column, found: Column, measured: tuple[str, ...]) -> Column:
    """Why an item is out of scope, sorted: its title, its kind of input, its people, or that the register hasn't it."""
    people = F.when(found, rules.talent_reasons(names, other)).otherwise(F.array(F.lit("no_register")))
    return F.array_sort(F.array_distinct(F.concat(rules.title_reasons(title), rules.input_reasons(kind, F.lit(True), measured), people)))


def judged(stays: DataFrame, register: DataFrame, mapped: DataFrame, model: StatusModel, inputs: tuple[str, ...] = ("brief",)) -> DataFrame:
    """stays of the items that no pair of accounts is known for, with about: what holds for the whole item.

    One shuffle by item serves everything: the item's first and last stay are windows, and the register joins on
    the same key.  about has title, brand, owner, input_kind, names, current_status, pool, born_as_copy, copied_status,
    against (reasons that exclude the item, else null), stays, first_status and last (a position).
    """
    whole = Window.partitionBy("item")
    rows = stays.join(mapped.select("item").distinct(), "item", "left_anti")
    case = F.struct(
        F.max_by("title", "position").over(whole).alias("title"), F.min_by(F.struct("status", "started"), "position").over(whole).alias("first"),
        F.count("*").over(whole).alias("stays"), F.count("started").over(whole).alias("dated"), F.max("position").over(whole).alias("last"),
    )
    rows = rows.withColumn("_c", case).join(register.select("item", F.struct(F.lit(True).alias("found"), "input_kind", "names", "other", "brand", "owner", "current_status").alias("_r")), "item", "left")
    title, first, none = F.col("_c.title"), F.col("_c.first"), F.array().cast("array<string>")
    reasons = register_reasons(title, F.col("_r.input_kind"), F.col("_r.names"), F.col("_r.other"), F.coalesce(F.col("_r.found"), F.lit(False)), inputs)
    last = F.col("position") == F.col("_c.last")
    rows = rows.withColumn("_why", F.first(F.when(last, reasons), ignorenulls=True).over(whole))  # worked out once for each item
    born = F.when(first["started"].isNull(), first["status"])
    copied = F.coalesce((born != model.intake) & model.role(born).isin("delivery", "terminal", "work", "waiting"), F.lit(False))
    odd = F.coalesce((born != model.intake) & ~copied, F.lit(False))
    pool = F.when(rules.is_pool(F.col("_why"), list(POOL)), F.col("_why")).otherwise(none)
    against = F.when((F.size("_why") > 0) & (F.size(pool) == 0), F.col("_why")).when(odd, F.array(F.lit("no_intake_first"))).when(F.col("_c.dated") == 0, F.array(F.lit("no_dated_event")))
    about = [title.alias("title"), *[F.col(f"_r.{c}").alias(c) for c in ("brand", "owner", "input_kind", "names", "current_status")], pool.alias("pool"), copied.alias("born_as_copy"), F.when(copied, born).alias("copied_status")]
    about += [against.alias("against"), F.col("_c.stays").alias("stays"), first["status"].alias("first_status"), F.col("_c.last").alias("last")]
    return rows.withColumn("about", F.struct(*about)).select(*stays.columns, "about")


def native(stays: DataFrame, register: DataFrame, mapped: DataFrame, model: StatusModel, spec: CalendarSpec, cut: int, inputs: tuple[str, ...] = ("brief",)) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(passages, attributes, excluded) of the items that no pair of accounts is known for.

    stays(item, event_id, position, status, title, started, ended, quality) may begin with a status that has no start: what
    the item was born with; a position stands once in an item.  register(item, input_kind, names, other, brand, owner,
    current_status) is the current one, a row for each item; mapped(item) has the items of pairs.  An item with a reason
    against it is excluded, unless all its reasons are of the pool; so is one born with an unknown status other than the
    intake, and one without a dated stay.  A passage ends where it was seen to end; the last one lasts up to the cut
    if the register still says its status.  Passages keep further columns of stays, and about (judged).
    """
    rows = judged(stays, register, mapped, model, inputs)
    once = rows.filter(F.col("position") == F.col("about.last"))
    excluded = once.filter("about.against is not null").select("item", "about.title", F.col("about.against").alias("reasons"), "about.stays", "about.first_status")
    attributes = once.filter("about.against is null").select("item", *[f"about.{c}" for c in ("title", "brand", "owner", "input_kind", "names", "pool", "born_as_copy", "copied_status")])

    passages = rows.filter("about.against is null and started is not null")
    seen = F.col("quality") == "observed"
    open_age = F.col("ended").isNull() & (F.col("position") == F.col("about.last")) & seen & (F.col("status") == F.col("about.current_status"))
    provenance = F.when(F.col("ended").isNotNull() & seen, "observed").when(F.coalesce(open_age, F.lit(False)), "open_age").otherwise("unavailable")
    passages = passages.withColumn("provenance", provenance)
    until = F.when(F.col("provenance") == "observed", F.col("ended")).when(F.col("provenance") == "open_age", F.lit(cut))
    more = [c for c in stays.columns if c not in ("item", "event_id", "position", "status", "title", "started", "ended", "quality")]
    passages = passages.select("item", "event_id", "position", "status", "started", "ended", "provenance", until.alias("until"), *more, "about")
    return passages.withColumn("elapsed", F.col("until") - F.col("started")).withColumn("business", business_micros(F.col("started"), F.col("until"), spec)), attributes, excluded


def routed(stays: DataFrame, intake: str) -> DataFrame:
    """stays(case_id, position, status, role, about: pool, born_as_copy) with route, first_status and entry.

    route is measured, pool, duplicate or no_intake; first_status is the first known one, entry its position.
    """
    known = F.min(F.when(F.col("role") != "unknown", F.struct("position", "status"))).over(by_case())
    rows = stays.withColumn("_k", known)
    route = F.when(~F.col("_k.status").eqNullSafe(F.lit(intake)), "no_intake").when(F.col("about.born_as_copy"), "duplicate").when(F.size("about.pool") > 0, "pool").otherwise("measured")
    return rows.select(*stays.columns, route.alias("route"), F.col("_k.status").alias("first_status"), F.col("_k.position").alias("entry"))


def routes(rows: DataFrame) -> DataFrame:
    """case_id, route, first_status of routed(...): each case once."""
    return rows.groupBy("case_id").agg(F.max("route").alias("route"), F.max("first_status").alias("first_status"))


def path(status: Column, position: Column) -> Column:
    """The statuses of a group in order, as one text; a blank one as a dash."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(position.alias("p"), F.coalesce(status, F.lit("-")).alias("s")))), lambda x: x["s"]), " > ")


def duplicates(rows: DataFrame, marks: tuple[str, ...]) -> DataFrame:
    """One row for each case that was born as a copy: how it went, and its one possible original, if there is one.

    rows are routed(...) and have started, business, about; what counts begins with the first known status.
    related is the case of the same base name that is no copy itself, null where there is none or several (originals).
    """
    valid = F.col("position") >= F.col("entry")
    spent = F.when(valid & (F.col("role") == "work"), F.col("business"))
    worked = F.when(F.count_if(valid & (F.col("role") == "work")) == F.count(spent), F.sum(spent))  # null where one is unknown
    got = rows.filter("route = 'duplicate'").groupBy("case_id").agg(
        F.min(F.when(valid, F.col("started"))).alias("entered"), F.max_by("status", "position").alias("status"), F.count_if(valid & (F.col("role") == "delivery")).alias("deliveries"),
        F.min(F.when(valid & (F.col("role") == "delivery"), F.col("started"))).alias("first_delivery"), worked.alias("worked"),
        path(F.col("status"), F.col("position")).alias("path"), F.max("about.title").alias("title"), F.max("about.copied_status").alias("copied_status"),
    )
    named = rows.filter("not about.born_as_copy").groupBy("case_id").agg(F.max("about.title").alias("title"))
    base = portfolio.base_name(F.col("title"), marks)
    originals = named.groupBy(base.alias("base")).agg(F.count("*").alias("_n"), F.min("case_id").alias("_one"))
    both = got.withColumn("base", base).join(originals, "base", "left").withColumn("originals", F.coalesce("_n", F.lit(0).cast("long")))
    return both.select("case_id", "title", "base", "copied_status", "entered", "status", "deliveries", "first_delivery", "worked", "path", F.when(F.col("originals") == 1, F.col("_one")).alias("related"), "originals")


def pool_cases(rows: DataFrame, model: StatusModel, cut: int) -> DataFrame:
    """Cases of several persons, measured by the same rules as others and kept apart: a row for each, with the reasons and the names."""
    from .model import projects

    own = rows.filter("route = 'pool'")
    found = projects(assign_cycles(gate(own, model.intake)), cut)
    about = own.groupBy("case_id").agg(F.max("about.title").alias("title"), F.array_join(F.max("about.pool"), ",").alias("pool_reasons"), F.to_json(F.max("about.names")).alias("names"))
    return found.join(about, "case_id").select("case_id", "title", "opened", "status", "state", "deliveries", "cycles", "to_first_delivery", "pool_reasons", "names")


def placed(register: DataFrame, routes: DataFrame, excluded: DataFrame, inputs: tuple[str, ...] = ("brief",)) -> DataFrame:
    """item, place, reasons: every item of the register and every case, each in exactly one place.

    An item that nothing is known of but the register goes to quality with what speaks against it, or else with no_history.
    """
    none = F.array().cast("array<string>")
    known = routes.select(F.col("case_id").alias("item"), F.col("route").alias("place"), none.alias("reasons")).unionByName(excluded.select("item", F.lit("excluded").alias("place"), "reasons"))
    rest = register.join(known.select("item"), "item", "left_anti")
    reasons = register_reasons(F.col("title"), F.col("input_kind"), F.col("names"), F.col("other"), F.lit(True), inputs)
    rest = rest.select("item", reasons.alias("_r")).select("item", F.lit("excluded").alias("place"), F.when(F.size("_r") > 0, F.col("_r")).otherwise(F.array(F.lit("no_history"))).alias("reasons"))
    return known.unionByName(rest).select("item", "place", F.array_join("reasons", ",").alias("reasons"))


def filling_errors(stays: DataFrame, responses: DataFrame, rows: DataFrame, copies: DataFrame, register: DataFrame, model: StatusModel, cut: int, stale_days: int = 30) -> DataFrame:
    """error_id, case_id, item, rule, severity, status, at: all that was filled in wrongly, each occurrence once.

    stays are whole, rows are routed(...); the rules on cycles and standby concern measured cases only.  Errors of
    the register have an item and no case, and happen at no time.  A row that breaks several rules is read once.
    """
    none = F.lit(None).cast("long")
    case = lambda df, found, at: df.select("case_id", none.alias("item"), F.explode(F.array_compact(F.array(*[F.when(c, F.lit(r)) for r, c in found.items()]))).alias("rule"), "status", F.col(at).alias("at"))
    parts = [portfolio.case_errors(stays, responses, model.intake).select("case_id", none.alias("item"), "rule", "status", "at")]
    measured = assign_cycles(gate(rows.filter("route = 'measured'"), model.intake))
    work, inside = F.col("role") == "work", Window.partitionBy("case_id", "segment")
    measured = measured.withColumn("_first", F.min(F.when(work, F.col("position"))).over(inside)).withColumn("_other", F.max((work & (F.col("status") != model.intake)).cast("int")).over(inside))
    measured = measured.withColumn("_last", F.lead("position").over(in_order()).isNull())
    parts.append(case(measured, {
        "repeated_intake": work & (F.col("status") == model.intake) & (F.col("position") > F.col("_first")),
        "delivered_without_work": (F.col("role") == "delivery") & F.col("_first").isNotNull() & (F.col("_other") == 0),
        "stuck_in_standby": F.col("_last") & (F.col("role") == "standby") & (F.lit(cut) - F.col("started") >= (stale_days + 1) * DAY),
    }, "started"))
    parts.append(case(copies.withColumn("status", F.lit(model.intake)), {"born_as_copy": F.lit(True), "ambiguous_original": F.col("originals") > 1}, "entered"))
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    found = F.concat(F.filter(rules.talent_reasons(F.col("names"), F.col("other")), lambda r: r.isin("none", "several", "both_columns", "squad")), F.array_compact(F.array(F.when(blank("brand"), "brand_blank"), F.when(blank("input_kind"), "input_blank"), F.when(blank("owner"), "owner_blank"))))
    parts.append(register.select(none.alias("case_id"), "item", F.explode(found).alias("rule"), F.col("current_status").alias("status"), none.alias("at")))
    both = reduce(DataFrame.unionByName, parts).distinct()
    severity = F.try_element_at(F.create_map(*[F.lit(x) for pair in ERRORS.items() for x in pair]), F.col("rule"))
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("None"))
    return both.select(F.sha2(F.concat_ws("|", text("rule"), text("case_id"), text("item"), text("status"), text("at")), 256).alias("error_id"), "case_id", "item", "rule", severity.alias("severity"), "status", "at")


def destination_tables(intervals: DataFrame, destinations: DataFrame, register: DataFrame, spec: CalendarSpec) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(measured, queue, quality): the three published tables of portfolio.destinations(...), as it sends each whole case to one.

    register(case_id, current_status, captured_at, brand).  measured has the stays of its cases unchanged; queue how long
    each case has waited by both clocks, up to the register's instant; quality the reasons with the first known status,
    the first intake seen, and its stays as evidence.
    """
    where = lambda d: destinations.filter(F.col("destination") == d).select("case_id", "reasons")
    measured = intervals.join(where("measured").select("case_id"), "case_id", "left_semi")
    about = register.select("case_id", "current_status", "captured_at", "brand")
    entry = intervals.filter("status is not null").groupBy("case_id").agg(F.max("started").alias("queued_at"))
    stays = intervals.groupBy("case_id").agg(F.count("*").alias("stays"))
    queue = where("queue").join(entry, "case_id").join(stays, "case_id").join(about, "case_id", "left")
    queue = queue.select("case_id", "stays", "current_status", "brand", "queued_at", "captured_at", (F.col("captured_at") - F.col("queued_at")).alias("waited"), business_micros(F.col("queued_at"), F.col("captured_at"), spec).alias("waited_business"))
    seen = F.array_sort(F.collect_list(F.struct("position", "event_id", "account", "status", "started", "ended")))
    told = intervals.join(where("quality").select("case_id"), "case_id", "left_semi").groupBy("case_id").agg(
        F.count("*").alias("stays"), F.min_by(F.when(F.col("status").isNotNull(), F.col("status")), F.when(F.col("status").isNotNull(), F.col("position"))).alias("first_known"),
        F.min(F.when(F.col("status") == StatusModel().intake, F.col("started"))).alias("first_intake"), F.to_json(seen, {"ignoreNullFields": "false"}).alias("evidence"),
    )
    quality = told.join(where("quality"), "case_id").join(about, "case_id", "left").select("case_id", "stays", "current_status", "brand", "reasons", "first_known", "first_intake", "evidence")
    return measured, queue, quality


def estimates(stays: DataFrame, spec: CalendarSpec, cut: int, first: str, second: str) -> DataFrame:
    """case_id, event_id, method, estimated_end, elapsed, business, reference: exits that only another account's next stay tells.

    stays(case_id, event_id, account, status, role, started, ended): a stay of the first account without an end, which a
    stay of the second with another status directly follows before the cut, ends there by hypothesis; both must
    have a status, and the first no terminal one.  A case in which any two stays overlap has no estimates.
    """
    before = F.max("ended").over(in_order().rowsBetween(Window.unboundedPreceding, -1))
    rows = stays.withColumn("_o", F.coalesce(F.col("started") < before, F.lit(False))).withColumn("_blocked", F.max("_o").over(by_case()))
    rows = rows.withColumn("_n", F.lead(F.struct("event_id", "account", "status", "role", "started")).over(in_order()))
    follows = F.col("ended").isNull() & (F.col("account") == first) & (F.col("_n.account") == second) & ~F.col("role").isin("terminal", "unknown") & F.col("_n.status").isNotNull()
    follows = follows & (folded(F.col("status")) != folded(F.col("_n.status"))) & (F.col("_n.started") > F.col("started")) & (F.col("_n.started") <= cut)
    good = F.coalesce(follows, F.lit(False)) & ~F.col("_blocked")
    end = F.when(good, F.col("_n.started"))
    method = F.when(good, "next_stay_of_other_account").when(F.col("_blocked"), "blocked_by_overlap").otherwise("not_applicable")
    return rows.select("case_id", "event_id", method.alias("method"), end.alias("estimated_end"), (end - F.col("started")).alias("elapsed"), business_micros(F.col("started"), end, spec).alias("business"), F.when(good, F.col("_n.event_id")).alias("reference"))


def monthly(populations: dict[str, tuple[DataFrame, Column]], measures: dict[str, tuple[str, Column]]) -> DataFrame:
    """month, a count of each population by its own date, and sums over populations: measures = {name: (population, 0/1 column)}."""
    parts = []
    for name, (df, day) in populations.items():
        counted = df.select("*", F.trunc(day, "month").alias("month")).filter("month is not null").groupBy("month")
        got = counted.agg(F.count("*").alias(name), *[F.coalesce(F.sum(c.cast("long")), F.lit(0)).alias(m) for m, (of, c) in measures.items() if of == name])
        parts.append(got.select("month", *[(F.col(n) if n == name else F.lit(0).cast("long").alias(n)) for n in populations], *[(F.col(m) if of == name else F.lit(0).cast("long").alias(m)) for m, (of, _) in measures.items()]))
    both = reduce(DataFrame.unionByName, parts)
    return both.groupBy("month").agg(*[F.sum(c).alias(c) for c in (*populations, *measures)])

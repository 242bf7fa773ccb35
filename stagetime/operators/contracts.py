"""Contracts of what is published: evidence at both ends of a trajectory, the bundle of cycles, snapshots, exports, releases, chains of versions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import StatusModel
from ..functions.columns import folded, row_hash, zoned_micros
from . import live
from .intervals import in_order

#: What limits a case's trajectory; the last two say that an end of it was not seen.
LIMITS = ("tied_start", "ends_before_start", "unclassified", "no_continuity", "overlap", "account_boundary", "single_stay", "start_not_observed", "end_not_observed")
_SUM = "decimal(38,0)"


def _joined(flags: dict[str, Column]) -> Column:
    return F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(r)) for r, c in flags.items()]))


def trajectories(stays: DataFrame, intake: str) -> DataFrame:
    """case_id, stays, statuses, gaps, boundaries, only_terminal, limits: what each case's history can't show.

    stays(case_id, event_id, account, status, role, started, ended).  A joined history is needed for a whole one and is
    no proof of it: a case also needs its intake as the first stay and a terminal stay as the last one.
    """
    was = F.lag(F.struct("account", "started", "ended")).over(in_order())
    rows = stays.withColumn("_w", was).withColumn("_last", F.lead("event_id").over(in_order()).isNull())
    w, first = F.col("_w"), F.col("_w").isNull()
    apart, moved = ~first & ~w["ended"].eqNullSafe(F.col("started")), F.coalesce(~first & (w["account"] != F.col("account")), F.lit(False))
    some = lambda c: F.coalesce(F.bool_or(c), F.lit(False))
    got = rows.groupBy("case_id").agg(
        F.count("*").alias("stays"), F.count_distinct("status").alias("statuses"), F.count_if(apart).alias("gaps"), F.count_if(moved).alias("boundaries"), F.bool_and(F.col("role") == "terminal").alias("only_terminal"),
        some(w["started"] == F.col("started")).alias("_tied"), some(F.col("ended") < F.col("started")).alias("_back"), some(F.col("role") == "unknown").alias("_unknown"),
        some(w["ended"] > F.col("started")).alias("_over"), some(first & F.col("status").eqNullSafe(F.lit(intake))).alias("_begun"), some(F.col("_last") & (F.col("role") == "terminal")).alias("_over_and_done"),
    )
    found = dict(zip(LIMITS, (F.col("_tied"), F.col("_back"), F.col("_unknown"), F.col("gaps") > 0, F.col("_over"), F.col("boundaries") > 0, F.col("stays") == 1, ~F.col("_begun"), ~F.col("_over_and_done")), strict=True))
    return got.select("case_id", "stays", "statuses", "gaps", "boundaries", "only_terminal", _joined(found).alias("limits"))


def with_trajectory(stays: DataFrame, cases: DataFrame) -> DataFrame:
    """stays with case_stays, trajectory (limited or no_limit_found), limits as JSON and is_last, of trajectories(...); no column of stays changes."""
    about = cases.select("case_id", F.col("stays").alias("case_stays"), F.when(F.size("limits") > 0, "limited").otherwise("no_limit_found").alias("trajectory"), F.to_json("limits").alias("limits"))
    last = F.lead("event_id").over(in_order()).isNull()
    return stays.withColumn("is_last", last).join(about, "case_id")


def trajectory_report(cases: DataFrame) -> DataFrame:
    """limit, cases, stays, gaps, boundaries: how many cases each limit concerns; the limit none has the cases without any, all has every case."""
    each = F.concat(F.when(F.size("limits") == 0, F.array(F.lit("none"))).otherwise(F.col("limits")), F.array(F.lit("all")))
    return cases.select(F.explode(each).alias("limit"), "stays", "gaps", "boundaries").groupBy("limit").agg(F.count("*").alias("cases"), *[F.sum(c).alias(c) for c in ("stays", "gaps", "boundaries")])


def confirmed_open(stays: DataFrame, evidence: DataFrame, cut: int, version: str, account: str) -> DataFrame:
    """live_stays(...) in which an open stay has an age only if the account's own record confirms it at the cut.

    evidence(event_id, case_id, history, is_open, is_last, diverges, spent, calendar, cut, status, started) is the record of closed days.
    Any other open stay becomes unavailable, without a duration.  What is null there confirms nothing.
    """
    names = [c for c in evidence.columns if c != "event_id"]
    rows = stays.join(evidence.select("event_id", F.struct(*names).alias("_e")), "event_id", "left")
    e = F.col("_e")
    good = (F.col("account") == account) & (e["history"] == "observed") & e["is_open"] & e["is_last"] & ~e["diverges"] & e["spent"].isNotNull() & (e["calendar"] == version) & (e["cut"] == cut)
    good = good & (e["case_id"] == F.col("case_id")) & (e["started"] == F.col("started")) & (folded(e["status"]) == folded(F.col("status")))
    lost = (F.col("provenance") == "open_age") & ~F.coalesce(good, F.lit(False))
    changed = {"provenance": F.when(lost, "unavailable").otherwise(F.col("provenance")), "spent": F.when(~lost, F.col("spent")), "no_duration": F.col("no_duration") | lost}
    return rows.select(*[changed[c].alias(c) if c in changed else c for c in stays.columns])


def cycle_bundle(intervals: DataFrame, destinations: DataFrame, model: StatusModel, cut: int) -> dict[str, DataFrame]:
    """passages, cycles, queue and quality of intervals(case_id, event_id, account, status, role, started, ended, position).

    Cases that begin with the intake are accepted with all their stays; any other is excluded whole.  queue is those accepted
    cases that destinations(case_id, destination, waited) has waiting: a part of them, no place of its own.  quality has a row for each excluded
    case and for each accepted one of which a stay has a reason, with the stays as evidence; it diagnoses and
    takes nothing away.
    """
    passages = live.live_stays(intervals, model.intake, cut)
    why = F.array_compact(F.array(*[F.when(F.col(r), F.lit(r)) for r in live.REASONS]))
    known = F.col("role") != "unknown"
    begun = F.min_by(F.when(known, F.col("status")), F.when(known, F.struct("started", "event_id")))
    seen = F.array_sort(F.collect_list(F.struct("position", "event_id", "account", "status", "started", "ended")))
    cases = intervals.groupBy("case_id").agg(F.count("*").alias("stays"), begun.alias("first_known"), F.min(F.when(F.col("status") == model.intake, F.col("started"))).alias("first_intake"), F.to_json(seen, {"ignoreNullFields": "false"}).alias("evidence"))
    reasons = passages.groupBy("case_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(why)))).alias("_r"))
    told = F.when(F.col("first_known").isNull(), F.array(F.lit("no_known_status"))).when(F.col("first_known") != model.intake, F.array(F.lit("first_is_not_intake"))).otherwise(F.coalesce("_r", F.array().cast("array<string>")))
    quality = cases.join(reasons, "case_id", "left").withColumn("reasons", told).filter(F.size("reasons") > 0)
    queue = destinations.filter("destination = 'queue'").select("case_id", "waited").join(cases.filter(F.col("first_known") == model.intake).select("case_id"), "case_id", "left_semi")
    return {"passages": passages, "cycles": live.live_cycles(passages), "queue": queue, "quality": quality.select("case_id", "stays", "first_known", "first_intake", F.array_join("reasons", ",").alias("reasons"), "evidence")}


def bundle_report(bundle: dict[str, DataFrame]) -> DataFrame:
    """name, n_rows, cases of each table of a bundle."""
    parts = [df.groupBy("case_id").agg(F.count("*").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count("*").alias("cases")).select(F.lit(name).alias("name"), "n_rows", "cases") for name, df in bundle.items()]
    return reduce(DataFrame.unionByName, parts)


def bundle_violations(source: DataFrame, bundle: dict[str, DataFrame], model: StatusModel) -> DataFrame:
    """rule, cases: where a stored bundle isn't one whole; every case is judged by counts and sums of hashes in one shuffle.

    source is the intervals that it is of.  Rules: lost (neither accepted nor excluded), both, unheard_of, stays_differ (an
    accepted case has not all its stays, or others), queue_not_accepted, cycles_differ (their totals aren't
    those of its stays) and evidence_differs (a quality row tells another number of stays).
    """
    none = F.lit(None)
    print_ = row_hash(["event_id", "account", "status", "started", "ended"]).cast(_SUM)
    known = F.col("role") != "unknown"
    fields = {"n": "long", "h": _SUM, "first": "struct<started:bigint,event_id:bigint,status:string>", "worked": "long", "reasons": "string"}

    def part(side: str, df: DataFrame, **have: Column) -> DataFrame:
        return df.select("case_id", F.lit(side).alias("_s"), *[have.get(c, none).cast(t).alias(c) for c, t in fields.items()])

    closing = F.col("role").isin("delivery", "terminal")
    member = F.col("cycle").isNotNull() & ~closing
    rows = reduce(DataFrame.unionByName, [
        part("source", source, n=F.lit(1), h=print_, first=F.when(known, F.struct("started", "event_id", "status"))),
        part("passages", bundle["passages"], n=F.lit(1), h=print_, worked=F.when(member, F.lit(1)).otherwise(F.lit(0))),
        part("cycles", bundle["cycles"], n=F.col("work_stays")), part("queue", bundle["queue"]),
        part("quality", bundle["quality"], n=F.col("stays"), reasons=F.col("reasons")),
        part("work", bundle["passages"].filter(F.col("cycle").isNotNull() & (F.col("role") == "work")), n=F.lit(1)),
    ])
    of = lambda side, c: F.coalesce(F.sum(F.when(F.col("_s") == side, F.col(c))), F.lit(0).cast(fields[c]))
    at = lambda side: F.count_if(F.col("_s") == side) > 0
    excluded = F.coalesce(F.bool_or(F.col("reasons").isin("no_known_status", "first_is_not_intake")), F.lit(False))
    got = rows.groupBy("case_id").agg(
        *[at(s).alias(f"_{s}") for s in ("source", "passages", "cycles", "queue", "quality")], excluded.alias("_out"), F.min("first").alias("_first"),
        *[of(s, "n").alias(f"n_{s}") for s in ("source", "passages", "cycles", "quality", "work")], of("source", "h").alias("h_source"), of("passages", "h").alias("h_passages"),
    )
    begins = F.coalesce(F.col("_first.status") == model.intake, F.lit(False))
    tests = {
        "lost": F.col("_source") & ~F.col("_passages") & ~F.col("_out"), "both": F.col("_passages") & F.col("_out"), "unheard_of": ~F.col("_source"),
        "wrongly_accepted": F.col("_source") & F.col("_passages") & ~begins,
        "stays_differ": F.col("_source") & F.col("_passages") & ((F.col("n_source") != F.col("n_passages")) | (F.col("h_source") != F.col("h_passages"))),
        "queue_not_accepted": F.col("_queue") & ~F.col("_passages"), "cycles_differ": F.col("n_cycles") != F.col("n_work"), "evidence_differs": F.col("_quality") & (F.col("n_quality") != F.col("n_source")),
    }
    return got.select(F.explode(_joined(tests)).alias("rule")).groupBy("rule").agg(F.count("*").alias("cases"))


def snapshot_checks(rows: DataFrame, declared: dict[str, str], required: tuple[str, ...], ids: tuple[str, ...], key: str, is_of: dict[str, object], captured: str, active: int | None = None) -> DataFrame:
    """rule, n: a snapshot table against its contract, before it may take the place of the active one.

    columns counts names and types that differ from declared; ids are positive whole numbers, is_of fixes values (its board,
    the contract's version), key stands once, and all rows are captured at one instant, not before that of the
    active table.  A snapshot without rows breaks the rule empty.
    """
    have = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    odd = len([c for c in {*have, *declared} if have.get(c) != declared.get(c)])
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in required])
    wrong = reduce(lambda a, b: a | b, [F.coalesce(F.col(c) <= 0, F.lit(False)) for c in ids])
    other = reduce(lambda a, b: a | b, [F.coalesce(F.col(c) != F.lit(v), F.lit(False)) for c, v in is_of.items()])
    once = rows.groupBy(key).agg(F.count("*").alias("n"), F.count_if(missing).alias("missing"), F.count_if(wrong).alias("wrong"), F.count_if(other).alias("other"), F.min(captured).alias("a"), F.max(captured).alias("b"), F.count_if(F.col(captured) < F.lit(active)).alias("back"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0).cast("long"))
    row = once.agg(
        F.lit(odd).cast("long").alias("columns"), (F.count("*") == 0).cast("long").alias("empty"), total("missing").alias("missing"), total("wrong").alias("id"), total("other").alias("of another"),
        total(F.when(F.col(key).isNotNull() & (F.col("n") > 1), F.col("n"))).alias("repeated"), F.coalesce((F.min("a") < F.max("b")).cast("long"), F.lit(0).cast("long")).alias("several instants"), total("back").alias("goes back"),
    )
    return row.select(F.explode(F.array(*[F.struct(F.lit(c).alias("rule"), F.col(f"`{c}`").alias("n")) for c in row.columns])).alias("x")).select("x.*")


def typed_export(lines: DataFrame, fields: dict[str, str]) -> DataFrame:
    """The fields of an exported table's lines(value) as their kinds, and problems: the names of what didn't fit, sorted.

    Kinds: int (numbers may be text), num, time (zoned text or one that ends in UTC, to microseconds), date and text.  A field that a
    line hasn't is null; one that isn't declared is a problem, and so is a line that is no object.
    """
    raw = {c: F.get_json_object("value", f"$.{c}") for c in fields}
    kinds = {
        "int": lambda v: F.when(F.regexp_like(v, F.lit(r"^-?[0-9]{1,18}$")), v).cast("long"), "num": lambda v: v.try_cast("double"),
        "time": lambda v: zoned_micros(F.regexp_replace(v, " UTC$", "Z")), "date": lambda v: F.when(F.regexp_like(v, F.lit(r"^\d{4}-\d{2}-\d{2}$")), v.try_cast("date")), "text": lambda v: v,
    }
    typed = {c: kinds[k](raw[c]) for c, k in fields.items()}
    names = F.json_object_keys("value")
    bad = [F.when(raw[c].isNotNull() & typed[c].isNull(), F.lit(c)) for c in fields]
    more = F.coalesce(F.array_except(names, F.array(*map(F.lit, fields))), F.array(F.lit("(no object)")))
    return lines.select(*[v.alias(c) for c, v in typed.items()], F.array_join(F.array_sort(F.concat(F.array_compact(F.array(*bad)), more)), ",").alias("problems"))


def release_blockers(events: DataFrame, supported: Column, cut: int, kind: str = "event_type") -> DataFrame:
    """kind, accepted, rejected, late, blocks: events by their kind, and whether it keeps a candidate from release.

    The cut is exclusive.  An event before it that no rule can read blocks release, whatever their number, and is never just left
    out; later ones are counted and concern nothing.
    """
    early, read = F.col("at") < cut, F.coalesce(supported, F.lit(False))
    got = events.groupBy(kind).agg(F.count_if(early & read).alias("accepted"), F.count_if(early & ~read).alias("rejected"), F.count_if(~F.coalesce(early, F.lit(False))).alias("late"))
    return got.withColumn("blocks", F.col("rejected") > 0)


def frozen_inputs(pages: DataFrame, board: int, source: str) -> tuple[DataFrame, DataFrame]:
    """(values, checks) of pages(page, board_id, source, n_items, items: array of id, present, value).

    values(item, state, value) are the input cells of a frozen read: unverified, blank or filled, each item once (of
    several the least value).  checks(rule, n): pages of another origin, pages that have not as many items as they say, and items
    that stand several times; all must be 0 before values may be used.
    """
    own = (F.col("board_id") == board) & (F.col("source") == source)
    each = pages.filter(own).select("page", F.explode("items").alias("i")).select(F.col("i.id").alias("item"), "i.present", "i.value")
    state = F.when(~F.coalesce("present", F.lit(False)), "unverified").when(F.coalesce(F.trim("value"), F.lit("")) == "", "blank").otherwise("filled")
    got = each.withColumn("state", state).groupBy("item").agg(F.count("*").alias("n"), F.min(F.struct("state", F.when(state == "filled", F.col("value")).alias("value"))).alias("x"))
    size = F.greatest(F.size("items"), F.lit(0))
    checks = pages.agg(F.count_if(~F.coalesce(own, F.lit(False))).alias("other origin"), F.count_if(F.coalesce(own, F.lit(False)) & ~size.eqNullSafe(F.col("n_items"))).alias("items differ"))
    told = checks.select(F.explode(F.array(*[F.struct(F.lit(c).alias("rule"), F.col(f"`{c}`").alias("n")) for c in checks.columns])).alias("x")).select("x.*")
    repeated = got.agg(F.count_if(F.col("n") > 1).alias("n")).select(F.lit("repeated item").alias("rule"), "n")
    return got.select("item", "x.state", "x.value"), told.unionByName(repeated)


def upgrade_chain(versions: list[tuple[str, DataFrame, list[str]]], key: list[str]) -> DataFrame:
    """step, check, n: a chain of versions(name, table, columns that it adds), each held against the one before.

    A step may only add its declared columns; keys that were lost, are new, or differ in an older column are counted.  All tables of the
    chain meet in one shuffle, as a fingerprint of each key over its own columns and over those of the version before.
    """
    parts, odd, was = [], {}, None
    for n, (name, df, added) in enumerate(versions):
        own = sorted(c for c in df.columns if c not in key)
        shared = own if was is None else sorted(set(was) & set(own))
        if was is not None:
            odd[name] = len(set(was) - set(own)) + len((set(own) - set(was)) ^ set(added))
        parts.append((n, df, shared))
        was = own
    rows = []
    for n, df, shared in parts:
        ahead = parts[n + 1][2] if n + 1 < len(parts) else []
        digest = lambda cols: F.sum(row_hash([*key, *cols]).cast(_SUM))
        rows.append(df.groupBy(*key).agg(F.struct(F.count("*").alias("n"), digest(shared).alias("h")).alias("_b"), F.struct(F.count("*").alias("n"), digest(ahead).alias("h")).alias("_a")).withColumn("_v", F.lit(n)))
    both = reduce(DataFrame.unionByName, rows)
    side = lambda n, c: F.max(F.when(F.col("_v") == n, F.col(c)))
    got = both.groupBy(*key).agg(*[side(n, c).alias(f"{c}{n}") for n in range(len(parts)) for c in ("_a", "_b")])
    tests = []
    for n, (name, _, _) in enumerate(versions[1:], 1):
        old, new = F.col(f"_a{n - 1}"), F.col(f"_b{n}")
        flags = {"lost": old.isNotNull() & new.isNull(), "new": old.isNull() & new.isNotNull(), "changed": old.isNotNull() & new.isNotNull() & (old != new)}
        tests += [(name, c, F.count_if(f)) for c, f in flags.items()]
    row = got.agg(*[t.alias(f"_{k}") for k, (_, _, t) in enumerate(tests)])
    told = [F.struct(F.lit(s).alias("step"), F.lit(c).alias("check"), F.col(f"_{k}").alias("n")) for k, (s, c, _) in enumerate(tests)]
    told += [F.struct(F.lit(s).alias("step"), F.lit("columns").alias("check"), F.lit(n).cast("long").alias("n")) for s, n in odd.items()]
    return row.select(F.explode(F.array(*told)).alias("x")).select("x.*")


def labelled_dimension(statuses: DataFrame, labels: DataFrame) -> DataFrame:
    """statuses(status, uses, ...) with on_board, and a row of its own for each label(label) of the board that nothing has used.

    A status and a label are one if they differ in case, accents or white space only.
    """
    known = labels.filter("label is not null").select(folded(F.col("label")).alias("_k"), "label").filter("_k <> ''").groupBy("_k").agg(F.min("label").alias("_label"))
    both = statuses.withColumn("_k", folded(F.col("status"))).join(known, "_k", "full_outer")
    counts = [c for c, t in statuses.dtypes if t == "bigint" and c.startswith(("uses", "cases"))]
    return both.select(*[F.coalesce(c, "_label").alias(c) if c == "status" else F.coalesce(c, F.lit(0).cast("long")).alias(c) if c in counts else c for c in statuses.columns], F.col("_label").isNotNull().alias("on_board"))

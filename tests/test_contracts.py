"""Contracts on small cases: what each rule finds, nulls, ties, empty tables."""

import pytest

from stagetime.config import CalendarSpec, StatusModel
from stagetime.operators import contracts, live

STAYS = "case_id long, event_id long, account string, status string, role string, started long, ended long, position int"
INTAKE, DRAFT, DONE = ("Intake", "work"), ("Drafting", "work"), ("Closed", "terminal")


def rows_of(df, *columns):
    return {tuple(r[c] for c in columns) for r in df.collect()}


def stays(spark, *rows):
    return spark.createDataFrame([(c, e, a, s, r, f, u, p) for c, e, a, (s, r), f, u, p in rows], STAYS)


def test_trajectory_limits(spark):
    rows = stays(
        spark, (1, 1, "A", INTAKE, 0, 10, 1), (1, 2, "A", DONE, 10, 12, 2), (2, 3, "A", DRAFT, 0, 10, 1), (2, 4, "B", (None, "unknown"), 5, 3, 2), (3, 5, "A", DONE, 0, None, 1), (4, 6, "A", INTAKE, 0, 0, 1), (4, 7, "A", DONE, 0, None, 2),
        (None, 8, None, INTAKE, 0, None, 1), (None, 9, "A", DONE, None, None, 2),
    )
    got = {r["case_id"]: (r["stays"], r["statuses"], r["gaps"], r["boundaries"], r["only_terminal"], list(r["limits"])) for r in contracts.trajectories(rows, "Intake").collect()}
    assert got[1] == (2, 2, 0, 0, False, [])
    assert got[2] == (2, 1, 1, 1, False, ["ends_before_start", "unclassified", "no_continuity", "overlap", "account_boundary", "start_not_observed", "end_not_observed"])
    assert got[3] == (1, 1, 0, 0, True, ["single_stay", "start_not_observed"])
    assert got[4][-1] == ["tied_start"]
    assert got[None][:2] == (2, 2) and "start_not_observed" in got[None][-1]  # a null start comes first
    report = {r["limit"]: r["cases"] for r in contracts.trajectory_report(contracts.trajectories(rows, "Intake")).collect()}
    assert report["all"] == 5 and report["none"] == 1 and report["single_stay"] == 1
    each = contracts.with_trajectory(rows, contracts.trajectories(rows, "Intake")).filter("case_id = 1")
    assert rows_of(each, "event_id", "is_last", "case_stays", "trajectory", "limits") == {(1, False, 2, "no_limit_found", "[]"), (2, True, 2, "no_limit_found", "[]")}
    none = contracts.trajectories(stays(spark).limit(0), "Intake")
    assert none.count() == 0 and contracts.trajectory_report(none).count() == 0


@pytest.mark.parametrize("field, value", [("history", "inferred"), ("is_open", False), ("is_last", None), ("diverges", True), ("diverges", None), ("spent", None), ("calendar", "old"), ("cut", 99), ("status", "Intake"), ("started", 11), ("case_id", 2), ("history", None)])
def test_open_age_needs_all_evidence(spark, field, value):
    spec = CalendarSpec()
    rows = live.live_stays(stays(spark, (1, 1, "B", INTAKE, 0, 10, 1), (1, 2, "B", DRAFT, 10, None, 2)), "Intake", 100)
    good = {"event_id": 2, "case_id": 1, "history": "observed", "is_open": True, "is_last": True, "diverges": False, "spent": 90, "calendar": spec.version(), "cut": 100, "status": " drafting", "started": 10}
    schema = "event_id long, case_id long, history string, is_open boolean, is_last boolean, diverges boolean, spent long, calendar string, cut long, status string, started long"
    told = lambda e: rows_of(contracts.confirmed_open(rows, spark.createDataFrame(e, schema), 100, spec.version(), "B").filter("event_id = 2"), "provenance", "spent", "no_duration")
    assert told([good]) == {("open_age", 90, False)}
    assert told([{**good, field: value}]) == {("unavailable", None, True)} == told([])


def test_other_account_confirms_nothing(spark):
    spec = CalendarSpec()
    rows = live.live_stays(stays(spark, (1, 1, "A", INTAKE, 0, None, 1)), "Intake", 100)
    good = spark.createDataFrame([(1, 1, "observed", True, True, False, 100, spec.version(), 100, "Intake", 0)], "event_id long, case_id long, history string, is_open boolean, is_last boolean, diverges boolean, spent long, calendar string, cut long, status string, started long")
    assert rows_of(contracts.confirmed_open(rows, good, 100, spec.version(), "B"), "provenance") == {("unavailable",)}


def bundle(spark):
    rows = stays(
        spark, (1, 1, "A", INTAKE, 0, 10, 1), (1, 2, "A", DRAFT, 10, 20, 2), (1, 3, "A", ("Awaiting feedback", "delivery"), 20, None, 3), (2, 4, "A", INTAKE, 5, None, 1), (3, 5, "A", DRAFT, 0, 10, 1), (4, 6, "A", (None, "unknown"), 0, None, 1),
        (5, 7, "A", INTAKE, 0, None, 1), (5, 8, "A", DRAFT, 7, 9, 2), (5, 9, "A", DONE, 9, None, 3),
    )
    to = spark.createDataFrame([(1, "measured", None), (2, "queue", 95), (3, "queue", 1), (4, "quality", None), (5, "quality", None)], "case_id long, destination string, waited long")
    return rows, contracts.cycle_bundle(rows, to, StatusModel(), 100)


def test_bundle_is_whole(spark):
    rows, got = bundle(spark)
    assert rows_of(got["queue"], "case_id", "waited") == {(2, 95)}  # case 3 waits but isn't accepted
    assert rows_of(got["quality"], "case_id", "stays", "reasons", "first_known") == {(3, 1, "first_is_not_intake", "Drafting"), (4, 1, "no_known_status", None), (5, 3, "no_continuity,no_duration", "Intake")}
    assert rows_of(got["passages"].groupBy("case_id").count(), "case_id", "count") == {(1, 3), (2, 1), (5, 3)}
    assert contracts.bundle_violations(rows, got, StatusModel()).count() == 0
    assert rows_of(contracts.bundle_report(got), "name", "n_rows", "cases") == {("passages", 7, 3), ("cycles", 3, 3), ("queue", 1, 1), ("quality", 3, 3)}


def test_bundle_breaks(spark):
    rows, got = bundle(spark)
    found = lambda **other: rows_of(contracts.bundle_violations(rows, {**got, **other}, StatusModel()), "rule", "cases")
    passages, quality = got["passages"], got["quality"]
    lacks = passages.filter("case_id <> 2")
    assert found(passages=lacks) == {("lost", 1), ("queue_not_accepted", 1), ("cycles_differ", 1)}
    assert found(quality=quality.filter("case_id <> 4")) == {("lost", 1)}
    assert found(quality=quality.unionByName(quality.filter("case_id = 3").selectExpr("1L as case_id", "3L as stays", "first_known", "first_intake", "reasons", "evidence"))) == {("both", 1)}
    moved = passages.selectExpr("case_id", "event_id", "account", "status", "role", "started + if(event_id = 1, 1, 0) as started", *passages.columns[6:])
    assert found(passages=moved) == {("stays_differ", 1)}
    assert ("wrongly_accepted", 1) in found(passages=passages.unionByName(passages.filter("event_id = 4").drop("case_id", "event_id").selectExpr("3L as case_id", "5L as event_id", "*")))
    assert found(cycles=got["cycles"].filter("case_id <> 5")) == {("cycles_differ", 1)}
    assert found(quality=quality.selectExpr("case_id", "stays + 1 as stays", "first_known", "first_intake", "reasons", "evidence")) == {("evidence_differs", 3)}
    more = got["queue"].selectExpr("77L as case_id", "waited")
    assert found(queue=got["queue"].unionByName(more)) == {("queue_not_accepted", 1), ("unheard_of", 1)}


def test_empty_bundle(spark):
    rows, got = bundle(spark)
    none = rows.limit(0)
    empty = contracts.cycle_bundle(none, spark.createDataFrame([], "case_id long, destination string, waited long"), StatusModel(), 100)
    assert rows_of(contracts.bundle_report(empty), "name", "n_rows", "cases") == {(n, 0, 0) for n in got}
    assert contracts.bundle_violations(none, empty, StatusModel()).count() == 0


def test_snapshot_contract(spark):
    schema, declared = "item_id long, board_id long, at long", {"item_id": "bigint", "board_id": "bigint", "at": "bigint"}
    check = lambda rows, active=None, of=schema: {r["rule"]: r["n"] for r in contracts.snapshot_checks(spark.createDataFrame(rows, of), declared, ("item_id", "board_id"), ("item_id",), "item_id", {"board_id": 7}, "at", active).collect() if r["n"]}
    assert check([(1, 7, 5), (2, 7, 5)], 5) == {} and check([(1, 7, 5)], 6) == {"goes back": 1}
    assert check([(1, 7, 5), (1, 7, 6), (None, 8, 6), (-1, None, 6)]) == {"repeated": 2, "several instants": 1, "missing": 2, "id": 1, "of another": 1}
    assert check([]) == {"empty": 1}
    assert contracts.snapshot_checks(spark.createDataFrame([(1, 7, 5, "x")], schema + ", note string"), declared, ("item_id",), ("item_id",), "item_id", {"board_id": 7}, "at").filter("rule = 'columns'").first()["n"] == 1


def test_typed_export(spark):
    lines = ['{"n":"12","x":1.5,"t":"2024-01-02 03:04:05 UTC","d":"2024-02-30"}', '{"n":1.5,"x":"NaN?","t":"2024-01-02T03:04:05","d":"2024-02-29","z":1,"a":null}', "[]", "", None, "{}", '{"n":null}']
    got = contracts.typed_export(spark.createDataFrame([(v,) for v in lines], "value string"), {"n": "int", "x": "num", "t": "time", "d": "date"}).collect()
    assert [r["problems"] for r in got] == ["d", "a,n,t,x,z", "(no object)", "(no object)", "(no object)", "", ""]
    assert (got[0]["n"], got[0]["x"], got[0]["t"]) == (12, 1.5, 1_704_164_645_000_000) and str(got[1]["d"]) == "2024-02-29"


def test_release_and_inputs(spark):
    from pyspark.sql import functions as F

    events = spark.createDataFrame([("a", 1, "x"), ("a", 10, None), ("b", 9, None), ("b", None, "x"), (None, 1, "x")], "event_type string, at long, status string")
    assert rows_of(contracts.release_blockers(events, F.col("status").isNotNull(), 10), "event_type", "accepted", "rejected", "late", "blocks") == {("a", 1, 0, 1, False), ("b", 0, 1, 1, True), (None, 1, 0, 0, False)}
    schema = "page long, board_id long, source string, n_items int, items array<struct<id:long,present:boolean,value:string>>"
    pages = spark.createDataFrame([(1, 7, "old", 2, [(1, True, "x"), (2, None, "y")]), (2, 7, "old", 2, [(1, True, " "), (3, True, None)]), (3, 8, "old", 1, [(9, True, "x")]), (4, 7, None, 0, []), (5, 7, "old", 1, None)], schema)
    values, checks = contracts.frozen_inputs(pages, 7, "old")
    assert rows_of(values, "item", "state", "value") == {(1, "blank", None), (2, "unverified", None), (3, "blank", None)}
    assert rows_of(checks, "rule", "n") == {("other origin", 2), ("items differ", 1), ("repeated item", 1)}


def test_chain_of_versions(spark):
    make = lambda rows, more="": spark.createDataFrame(rows, "k long, a long" + more)
    v1 = make([(1, 1), (2, 2), (None, 3)])
    v2 = make([(1, 1, 5), (2, 9, 5), (None, 3, 5)], ", b long")
    v3 = make([(1, 1, 5, "x"), (None, 3, 6, "x"), (4, 1, 1, "x")], ", b long, c string")
    got = {(r["step"], r["check"]): r["n"] for r in contracts.upgrade_chain([("v1", v1, []), ("v2", v2, ["b"]), ("v3", v3, [])], ["k"]).collect()}
    assert got == {("v2", "columns"): 0, ("v2", "lost"): 0, ("v2", "new"): 0, ("v2", "changed"): 1, ("v3", "columns"): 1, ("v3", "lost"): 1, ("v3", "new"): 1, ("v3", "changed"): 1}


def test_labels_without_use(spark):
    used = spark.createDataFrame([("Intake", "work", 3, 2), ("Elaboração", "work", 1, 1)], "status string, role string, uses long, cases long")
    labels = spark.createDataFrame([("  INTAKE ",), ("elaboracao",), ("Never",), ("never ",), (None,), (" ",)], "label string")
    assert rows_of(contracts.labelled_dimension(used, labels), "status", "role", "uses", "cases", "on_board") == {("Intake", "work", 3, 2, True), ("Elaboração", "work", 1, 1, True), ("Never", None, 0, 0, True)}

"""Evidence, live cycles, boards and people rules on small cases: nulls, ties, conflicts, empty tables."""

from stagetime.operators import evidence, live, rules
from stagetime.sources import boards

EVENTS = "item long, action string, event_id long, at long, value long, single boolean"


def test_evidence_interrupts(spark):
    rows = [(1, "a", 1, 10, 0, True), (1, "a", 2, 10, 0, False), (1, None, 3, 20, 0, True), (1, "b", 4, 30, 1, True), (1, "c", 5, 30, 2, True), (1, "d", 6, 40, 1, True), (1, "e", 7, 50, 0, False), (2, "a", 8, 10, 1, True), (2, "b", 9, None, 1, True)]
    seen = evidence.observations(spark.createDataFrame(rows, EVENTS))
    stays = {(r["value"], r["started"], r["ended"], r["visit"], r["quality"]) for r in evidence.supported_stays(seen).collect()}
    assert stays == {(0, 10, None, 1, "interrupted"), (1, 40, 50, 1, "closed"), (0, 50, None, 2, "no_exit")}
    assert {tuple(r) for r in evidence.gaps(seen).collect()} == {(1, 30, "conflict"), (2, None, "unlocated")}


def test_single_is_not_outvoted(spark):
    rows = [(1, "a", 1, 10, None, True), (1, "a", 2, 11, 3, False), (2, "a", 3, 10, 3, True), (2, "a", 4, 12, 3, False), (3, "a", 5, 10, 1, False), (3, "a", 6, 11, 1, False)]
    got = {r["item"]: (r["value"], r["at"], r["evidence"], r["reasons"]) for r in evidence.observations(spark.createDataFrame(rows, EVENTS)).collect()}
    assert got == {1: (None, 10, "single", "status"), 2: (3, 10, "single", ""), 3: (1, None, "batch", "time")}


def test_lineage_holds_every_event(spark):
    rows = spark.createDataFrame([(1, "a", 1, 1, 1, True), (1, "a", 2, 1, 1, False), (1, None, 3, 1, 1, True)], EVENTS)
    assert {tuple(r) for r in evidence.lineage(rows).collect()} == {(1, "action:a", 1), (1, "action:a", 2), (1, "event:3", 3)}


def test_no_events(spark):
    seen = evidence.observations(spark.createDataFrame([], EVENTS))
    assert evidence.supported_stays(seen).count() == evidence.gaps(seen).count() == 0


STAYS = "case_id long, event_id long, account string, status string, role string, started long, ended long"


def test_live_cycle_over_accounts(spark):
    rows = [(1, 0, "A", None, "unknown", 0, 10), (1, 1, "A", "Intake", "work", 10, 20), (1, 2, "A", "Drafting", "work", 20, None), (1, 3, "B", "Drafting", "work", 30, 40), (1, 4, "B", "Awaiting feedback", "delivery", 40, 50), (1, 5, "B", "Drafting", "work", 50, None), (2, 6, "A", "Drafting", "work", 1, None)]
    stays = live.live_stays(spark.createDataFrame(rows, STAYS), "Intake", 100)
    got = {r["event_id"]: (r["provenance"], r["spent"], r["continues"], r["cycle"]) for r in stays.collect()}
    assert got == {0: ("prefix", None, False, None), 1: ("observed", 10, False, 1), 2: ("estimated", 10, False, 1), 3: ("observed", 10, True, 1), 4: ("observed", 10, False, 1), 5: ("open_age", 50, False, 2)}
    cycles = [(r["cycle"], r["state"], r["reasons"], r["complete"], r["worked"], r["observed_delivery"]) for r in live.live_cycles(stays).orderBy("cycle").collect()]
    assert cycles == [(1, "delivered", "estimated_transition,account_boundary", True, 30, False), (2, "ongoing", "", True, 50, False)]


def test_consolidation_accounts_for_all(spark):
    schema = "item long, event_id long, status string, started long, ended long"
    old = spark.createDataFrame([(1, 1, "x", 0, 10), (2, 2, "bad", 0, 5), (3, 3, "x", 0, 5)], schema)
    new = spark.createDataFrame([(11, 4, "y", 5, 20), (12, 5, "y", 7, 9), (14, 6, "x", 0, None)], schema)
    pairs = spark.createDataFrame([(1, "old", 1), (1, "new", 11), (2, "old", 2), (2, "new", 12), (3, "old", 3)], "project long, source string, item long")
    good, out = live.consolidate({"old": old, "new": new}, pairs, {"scope": "status = 'bad'"})
    assert {(r["event_id"], r["position"], r["overlaps"], r["spent"]) for r in good.collect()} == {(1, 1, True, None), (4, 2, False, 15), (3, 1, False, 5)}
    assert {(r["event_id"], r["reasons"]) for r in out.collect()} == {(2, "scope"), (5, "scope"), (6, "no_pair")}
    assert all(r["adds_up"] for r in live.accounting({"old": old, "new": new}, good, out).collect())


def test_board_cells(spark):
    schema = f"item_id long, cells {boards.CELL}"
    cells = [{"id": "s", "value": '{"index":7}'}, {"id": "d", "value": None}, {"id": "t", "value": '"a \\"b\\""'}]
    got = boards.decode(spark.createDataFrame([(1, cells), (2, []), (3, None)], schema), {"s": ("s", "status"), "d": ("d", "dropdown"), "p": ("p", "people"), "t": ("t", "text")}, {"s": {"1": "x"}}).orderBy("item_id").collect()
    assert [tuple(r) for r in got] == [(1, None, None, None, 'a "b"', "s"), (2, None, None, None, None, ""), (3, None, None, None, None, "")]


def test_talents(spark):
    rows = [(["Ana Sá"], "ANA  SA"), (["Ana"], "Bia"), ([], None), (None, "the squad"), (["A", "B"], ""), (["group"], None)]
    df = spark.createDataFrame(rows, "names array<string>, other string")
    got = [r[0] for r in df.select(rules.talent_reasons(df.names, df.other)).collect()]
    assert got == [[], ["both_columns"], ["none"], ["squad"], ["several"], ["collective"]]


def test_names_and_their_probable_duplicates(spark):
    from stagetime.operators.audits import name_dimension

    rows = [(1, "Ana Lima", True, 1), (2, "ANA LIMA", False, 2), (3, "Ana Lima", False, 3), (3, "Anna Lima", True, 4), (4, "Ana", False, 5), (5, "ﬁn", True, 6), (6, "FIN", True, 7), (7, "??", True, 8)]
    got = {r["key"]: r.asDict() for r in name_dimension(spark.createDataFrame(rows, "item int, name string, exclusive boolean, place int"), spark.createDataFrame([(1,), (3,)], "item int")).collect()}
    assert set(got) == {"ana lima", "anna lima", "ana", "fin"} and got["fin"]["n_variants"] == 2 and got["fin"]["name"] == "ﬁn"
    ana = got["ana lima"]
    assert (ana["name"], ana["n_variants"], ana["uses_exclusive"], ana["uses_other"], ana["items"], ana["items_in_model"], ana["duplicate_of"]) == ("Ana Lima", 2, 1, 2, 3, 2, None)
    assert ana["variants"] == '[{"name":"Ana Lima","n":2},{"name":"ANA LIMA","n":1}]'
    assert got["ana"]["duplicate_of"] == "ana lima" and got["anna lima"]["duplicate_of"] == "ana lima"


def test_decisions_of_one_instant_and_after_the_cut(spark):
    from stagetime.operators import decisions

    schema = "entity_type string, source_key string, canonical_id string, canonical_name string, entity_kind string, review_status string, decided_at long"
    rows = [("talent", "ana", "1", "Ana", "person", "approved", 10), ("talent", "ana", "2", "Ana B", "person", "approved", 10), ("talent", "ana", None, None, "unknown", "quarantined", 30), ("talent", "bo", "3", "Bo", "group", "approved", 5)]
    made = spark.createDataFrame(rows, schema)
    assert decisions.validity(made).filter("source_key = 'ana'").count() == 2  # one of the two of an instant never was in force
    values = spark.createDataFrame([("talent", " ANA ", False), ("talent", "Bo", True), ("talent", None, True), ("talent", "eva", True), ("talent", "eva", False), ("brand", "Eva", False)], "entity_type string, text string, exclusive boolean")
    got = lambda cut: sorted((r["text"] or "", r["situation"]) for r in decisions.resolve(values, made, cut).collect())
    assert got(20) == [("", "missing"), (" ANA ", "approved"), ("Bo", "not_individual"), ("Eva", "normalised_text"), ("eva", "exclusive_register"), ("eva", "pending_review")]
    assert (" ANA ", "quarantined") in got(30) and (" ANA ", "pending_review") in got(1)
    ids = {r["identity_id"] for r in decisions.resolve(values, made, 1).filter("situation in ('exclusive_register', 'normalised_text')").collect()}
    assert len(ids) == 3 and None not in ids
    assert {r["source_key"] for r in decisions.pending(values, made, 7).collect()} == {"ana", "eva"}


def test_cells_that_cannot_be_read(spark):
    from stagetime.sources import boards

    settings = '{"labels":{"0":"Open","5":"Done"}}'
    board = spark.createDataFrame([(1, [("s", "Status", "status", settings)]), (2, [("s", "Status", "text", "{}")])], "board_id int, columns array<struct<id:string,title:string,type:string,settings_str:string>>")
    cells = ['{"index":0}', '{"index":"5"}', '{"label":"Told"}', '{"label":{"index":5}}', '{"label":{"text":"Told"}}', "{broken", "null", None, '{"index":9}', "[]"]
    items = spark.createDataFrame([(b, k, [("s", c)]) for b in (1, 2, 3) for k, c in enumerate(cells)] + [(1, 99, [])], "board_id int, item_id int, cells array<struct<id:string,value:string>>")
    got = {(r["board_id"], r["item_id"]): (r["status"], r["unread"]) for r in boards.decode_boards(items, board, {"status": ("s", "status")}).collect()}
    assert [got[1, k][0] for k in range(10)] == ["Open", "Done", "Told", "Done", "Told", None, None, None, None, None]
    assert {k for (b, k), x in got.items() if x[1]} == {5, 8, 9} and got[1, 99] == (None, "") and {got[b, 0] for b in (2, 3)} == {(None, "")}


def test_compared_with_nulls_and_repeats(spark):
    from stagetime.operators import proofs

    schema = "k int, a string, b double"
    derived = spark.createDataFrame([(1, "x", 1.0), (1, "x", 2.0), (2, None, None), (3, "z", 0.0), (None, "n", 5.0), (6, "s", 1.0)], schema)
    stored = spark.createDataFrame([(1, "x", 2.0), (1, "x", 1.0), (2, "", None), (4, "z", 0.0), (None, "n", 5.0), (6, "s", 1.0), (6, "s", 1.0)], schema)
    got = sorted(tuple(r) for r in proofs.compared(stored, derived, ["k"], ["a", "b"]).collect())
    assert got == [(2, "changed", "a"), (3, "missing", ""), (4, "extra", ""), (6, "repeated", "")]
    assert proofs.compared(derived, derived, ["k"], ["a", "b"]).count() == 0 and proofs.compared(derived.limit(0), derived.limit(0), ["k"], ["a"]).count() == 0

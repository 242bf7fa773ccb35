"""Reviewers' files: forms, refusals, contradictions, one version for what is exported."""

import json

import pytest

from stagetime.operators import decisions
from stagetime.sources import reviews, runs

ROW = {"entity_type": "brand", "source_text": " Ácme  Co", "canonical_id": "1", "canonical_name": "Acme", "entity_kind": "company", "review_status": "approved", "updated_at": "2024-01-01T00:00:00Z"}
AT = 1_704_067_200_000_000


def test_refused(spark):
    rows = [ROW, ROW, {**ROW, "source_text": None}, {**ROW, "review_status": None}, {**ROW, "updated_at": "2024-01-01"}, {**ROW, "updated_at": "2024-01-01T00:00:01Z", "entity_type": " "}]
    kept, refused = decisions.reviewed(spark.createDataFrame(rows, reviews.REVIEW), AT)
    assert [(r["source_key"], r["decided_at"]) for r in kept.collect()] == [("ácme co", AT)]
    assert sorted(r["reasons"] for r in refused.collect()) == ["no_alias", "no_alias,after_now", "no_instant", "not_reviewed"]
    none = decisions.reviewed(spark.createDataFrame([], reviews.REVIEW), AT)
    assert none[0].count() == none[1].count() == 0


def test_forms_read_alike(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([ROW, {**ROW, "more": 1}]))
    (tmp_path / "b.json").write_text(json.dumps(ROW) + "\n" + json.dumps(ROW))
    quoted = [f'"{v}"' for v in ROW.values()]
    (tmp_path / "c.csv").write_text(",".join([*ROW, "more"]) + "\n" + ",".join([*quoted, "x"]) + "\n" + ",".join([*quoted, ""]))
    (tmp_path / "d.csv").write_text("entity_type\nbrand")
    got = [reviews.read_reviews(spark, str(tmp_path / n), k).collect() for n, k in (("a.json", "json"), ("b.json", "lines"), ("c.csv", "csv"))]
    assert got[0] == got[1] and [r["canonical_id"] for r in got[2]] == ["1", "1"] and got[2][0].asDict() == {**ROW, "source_text": got[2][0]["source_text"]}
    with pytest.raises(ValueError, match="no column"):
        reviews.read_reviews(spark, str(tmp_path / "d.csv"), "csv")


def test_import_is_whole_or_nothing(spark, tmp_path):
    root, frame = str(tmp_path / "r"), lambda *rows: spark.createDataFrame(list(rows), reviews.REVIEW)
    assert reviews.catalogue(spark, root).count() == 0
    reviews.import_reviews(spark, root, frame(ROW), AT, "one")
    for bad, what in (([], "nothing"), ([{**ROW, "source_text": "Other"}, {**ROW, "review_status": "pending"}], "not_reviewed"), ([{**ROW, "source_text": "Other", "canonical_name": "Another"}], "conflicting")):
        with pytest.raises(ValueError, match=what):
            reviews.import_reviews(spark, root, frame(*bad), AT + 1, "two")
    assert reviews.catalogue(spark, root).count() == 1
    later = {**ROW, "review_status": "quarantined", "updated_at": "2024-01-02T00:00:00Z"}
    reviews.import_reviews(spark, root, frame(later), AT + 86_400_000_000, "two")
    rows = reviews.catalogue(spark, root)
    assert rows.count() == 2 and [r["review_status"] for r in decisions.in_force(rows, AT).collect()] == ["approved"]
    cases = spark.createDataFrame([(1, "gap")], "case_id long, reason string")
    done = reviews.export_review(spark, root, cases, cases.limit(0), AT + 2 * 86_400_000_000, "three")
    assert {n: t["rows"] for n, t in done["tables"].items()} == {"pending": 1, "quarantined": 0, "catalogue": 2}
    assert runs.table(spark, root, "pending").count() == 1

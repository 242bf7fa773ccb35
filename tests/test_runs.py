"""Commits of runs, and stays from streams."""

import pytest
from pyspark.sql import functions as F

from stagetime.operators import intervals
from stagetime.plans import binding
from stagetime.sources import runs

SF = "/root/testdata/sf0.001"
SCHEMA = "event_id long, at long, value string"


def source(spark, ids):
    return spark.createDataFrame([(i, 10 * i, f"v{i}") for i in ids], SCHEMA)


def derive(raw, cut):
    return {"counts": raw.groupBy("value").agg(F.count("*").alias("n"), F.lit(cut).alias("cut"))}


def test_watermark_moves_with_the_data_only(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "r")
    first = runs.advance(spark, root, source(spark, range(10)), runs.run_id("p", "d1"), 1000, 20, derive=derive)
    assert (first["watermark"], first["read"], first["tables"]["raw"]["rows"], first["tables"]["counts"]["rows"]) == (90, 10, 10, 10)
    # A crash after the files and before the commit: nothing of the run can be seen.
    with monkeypatch.context() as m:
        m.setattr(runs.CommitLog, "add", lambda self, commit: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            runs.advance(spark, root, source(spark, range(15)), runs.run_id("p", "d2"), 2000, 20, derive=derive)
    assert runs.CommitLog(spark, root).head() == first and runs.raw_rows(spark, root, SCHEMA).count() == 10
    # The next attempt reads from the old watermark: the overlap 70..90 again, and what is new, one of it late.
    late = source(spark, [*range(15)]).unionByName(spark.createDataFrame([(77, 75, "late"), (78, 30, "too late")], SCHEMA))
    second = runs.advance(spark, root, late, runs.run_id("p", "d2"), 2000, 20, derive=derive)
    assert (second["watermark"], second["read"], second["tables"]["raw"]["rows"]) == (140, 9, 6)
    assert sorted(r["event_id"] for r in runs.raw_rows(spark, root, SCHEMA).collect()) == [*range(15), 77]
    assert runs.advance(spark, root, late, runs.run_id("p", "d2"), 2000, 20) == second  # the same run again does nothing
    with pytest.raises(ValueError, match="not after"):
        runs.advance(spark, root, late, runs.run_id("p", "d0"), 1500, 20)
    third = runs.advance(spark, root, late, runs.run_id("p", "d3"), 3000, 20)
    assert (third["read"], third["tables"]["raw"]["rows"], third["watermark"]) == (3, 0, 140)  # the overlap alone
    # Replay at the first cut, after newer data has landed.
    assert runs.replay(spark, root, SCHEMA, derive, version=1) == {"counts": True}
    assert runs.replay(spark, root, SCHEMA, lambda raw, cut: derive(raw.filter("event_id > 0"), cut), version=1) == {"counts": False}
    assert runs.table(spark, root, "counts", 1).count() == 10 and runs.table(spark, root, "counts").count() == 16


def test_two_publishers_of_one_cut(spark, tmp_path):
    root, df = str(tmp_path / "r"), spark.range(10)
    assert not runs.verified(spark, root)
    runs.publish(spark, root, {"numbers": df}, 5, "a")
    assert runs.verified(spark, root)
    log = runs.CommitLog(spark, root)
    seen = log.commits()
    runs.publish(spark, root, {"numbers": spark.range(3)}, 6, "b")
    with pytest.raises(runs.Clash):  # one that has read the log before b's commit
        log.add({**seen[-1], "version": len(seen) + 1, "run": "c", "cut": 6})
    assert [c["run"] for c in log.commits()] == ["a", "b"] and runs.table(spark, root, "numbers").count() == 3
    with pytest.raises(ValueError, match="not after"):
        runs.publish(spark, root, {"numbers": df}, 6, "d")
    assert runs.publish(spark, root, {"numbers": df}, 5, "a") == seen[0]
    path = log.head()["tables"]["numbers"]["path"]
    spark.range(4).write.mode("overwrite").parquet(path)
    assert not runs.verified(spark, root)
    assert runs.run_id("p", "2024-01-01") == runs.run_id("p", "2024-01-01") != runs.run_id("p", "2024-01-02")


EVENTS = "case_id long, event_id long, account string, at long, status string, seen timestamp"


def fed(spark, path, batches, read, idle):
    """Runs the stream once for each batch of events; the table of what was told, and the progress of each run."""
    progress = []
    for rows in batches:
        rows.coalesce(1).write.mode("append").parquet(str(path / "in"))
        q = read(spark.readStream.schema(EVENTS).parquet(str(path / "in")), idle).writeStream.format("parquet").option("path", str(path / "out")).outputMode("append")
        q = q.option("checkpointLocation", str(path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination()
        progress += [p["stateOperators"][0]["numRowsTotal"] for p in map(dict, ({"stateOperators": [{"numRowsTotal": s.numRowsTotal} for s in p.stateOperators]} for p in q.recentProgress)) if p["stateOperators"]]
    return spark.read.parquet(str(path / "out")), progress


def test_stream_with_late_events_equals_batch(spark, tmp_path):
    pytest.importorskip("google.protobuf")
    from stagetime.streaming.stays import settled, stays

    events = binding.status_events(spark, SF).filter("user_id < 30").withColumn("seen", F.timestamp_micros("at")).select("case_id", "event_id", "account", "at", "status", "seen")
    late = F.col("event_id") % 17 == 0  # these arrive four days after they happened
    events = events.withColumn("seen", F.when(late, F.col("seen") + F.expr("INTERVAL 4 DAYS")).otherwise(F.col("seen")))
    cuts = [F.col("seen") < "2024-01-12", (F.col("seen") >= "2024-01-12") & (F.col("seen") < "2024-01-22"), F.col("seen") >= "2024-01-22"]
    told, _ = fed(spark, tmp_path, [events.filter(c) for c in cuts], stays, "2 days")
    kinds = {r["kind"]: r["n"] for r in told.groupBy("kind").agg(F.count("*").alias("n")).collect()}
    assert set(kinds) == {"begun", "closed", "late", "idle"}
    batch = intervals.build_intervals(events, 1 << 60).filter("ended is not null").select("case_id", "event_id", "account", "status", "started", "ended")
    got = settled(told, events, 1 << 60)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, batch.collect()))


def test_state_is_given_up(spark, tmp_path):
    pytest.importorskip("google.protobuf")
    from datetime import datetime

    from stagetime.streaming.stays import stays

    day = lambda d: datetime(2024, 1, d)
    batches = [[(k, k, "A", 10, "a", day(1)) for k in range(20)], [(0, 100, "A", 20, "b", day(9)), (1, 101, "A", 20, "a", day(9))], [(0, 102, "A", 30, "a", day(10)), (7, 103, "A", 30, "c", day(10)), (0, 104, "A", 25, "x", day(10))], [(0, 105, "A", 40, "a", day(11))]]
    told, held = fed(spark, tmp_path, [spark.createDataFrame(b, EVENTS) for b in batches], stays, "3 days")
    assert max(held) >= 20 and held[-1] < 10
    rows = sorted(((r["kind"], r["case_id"], r["status"], r["started"], r["ended"]) for r in told.collect()), key=repr)
    assert ("closed", 0, "b", 20, 25) in rows and ("closed", 0, "x", 25, 30) in rows and ("begun", 7, "c", 30, None) in rows
    assert {c for kind, c, *_ in rows if kind == "idle"} >= set(range(2, 20)) - {7} and not [r for r in rows if r[0] == "late"]

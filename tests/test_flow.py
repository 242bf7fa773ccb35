"""Golden cases, invariants, sources and streams of the status flow."""

import random
from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from stagetime.config import CalendarSpec
from stagetime.functions.columns import HOUR, business_micros, event_micros, uuid5
from stagetime.operators import intervals, quality
from stagetime.plans import binding
from stagetime.sources import logs

SF = "/root/testdata/sf0.001"


ZONE = ZoneInfo("America/Sao_Paulo")


def at(text: str) -> int:
    """Microseconds of local time in Sao Paulo."""
    return int(datetime.fromisoformat(text).replace(tzinfo=ZONE).timestamp() * 1e6)


@pytest.mark.parametrize(
    ("start", "end", "hours"),
    [
        ("2033-06-07T00:00", "2033-06-08T00:00", 8), ("2033-06-07T11:15", "2033-06-07T15:15", 3), ("2033-06-07T13:05", "2033-06-07T13:55", 0), ("2033-06-07T02:00", "2033-06-07T10:00", 0),
        ("2033-06-07T19:00", "2033-06-08T10:00", 0), ("2033-06-10T17:30", "2033-06-13T10:45", 2.25), ("2033-04-14T16:00", "2033-04-18T12:00", 5), ("2034-11-20T00:00", "2034-11-21T00:00", 0),
        ("2019-11-20T00:00", "2019-11-21T00:00", 8), ("2033-03-01T00:00", "2033-03-02T00:00", 8), ("2036-01-01T00:00", "2036-01-02T00:00", 0), ("2033-06-07T15:00", "2033-06-07T15:00", 0),
        ("2033-06-08T15:00", "2033-06-07T15:00", 0), ("2101-02-01T00:00", "2101-02-02T00:00", None),
    ],
)
def test_business_hours(spark, start, end, hours):
    df = spark.createDataFrame([(at(start), at(end))], "a long, b long")
    assert df.select(business_micros(F.col("a"), F.col("b"), CalendarSpec())).first()[0] == (None if hours is None else hours * HOUR)


def test_business_hours_equal_a_day_loop(spark):
    r, closed = random.Random(5), set(CalendarSpec().holidays())
    rows = []
    for _ in range(300):
        a = datetime(r.randint(1995, 2060), r.randint(1, 12), r.randint(1, 28), r.randint(0, 23), r.randint(0, 59))
        b = a + timedelta(minutes=r.randint(0, 200_000))
        want, day = timedelta(), datetime(a.year, a.month, a.day)
        while day <= b:
            if day.weekday() < 5 and day.date() not in closed:
                for lo, hi in ((10, 13), (14, 19)):
                    want += max(timedelta(), min(b, day + timedelta(hours=hi)) - max(a, day + timedelta(hours=lo)))
            day += timedelta(days=1)
        rows.append((at(a.isoformat()), at(b.isoformat()), int(want / timedelta(microseconds=1))))
    df = spark.createDataFrame(rows, "a long, b long, want long")
    assert df.filter(~business_micros(F.col("a"), F.col("b")).eqNullSafe(F.col("want"))).count() == 0


def test_quantiles_equal_numpy(spark):
    import numpy as np

    from stagetime.operators.quantiles import quantiles

    r = random.Random(2)
    rows = [(g, float(r.choice([r.randint(0, 5), r.randint(0, 10**6)]))) for g in ("a", "b", None) for _ in range(500)] + [("c", 7.0), ("d", None)]
    got = quantiles(spark.createDataFrame(rows, "g string, v double"), ("g",), F.col("v"), {"p10": 0.1, "p50": 0.5, "p93": 0.93}).collect()
    for x in got:
        v = [b for a, b in rows if a == x["g"] and b is not None]
        assert x["n"] == len(v) and [x["p10"], x["p50"], x["p93"]] == [round(float(q), 3) for q in np.quantile(v, [0.1, 0.5, 0.93])]
    assert {x["g"] for x in got} == {"a", "b", "c", None}


def test_event_times(spark):
    rows = [("1706670000",), ("1706670000123",), ("1706670000123456",), ("17066700001234567",), ("1706670000123456789",), ("17",), ("x",), (None,), ("9999999999",)]
    got = [r[0] for r in spark.createDataFrame(rows, "t string").select(event_micros(F.col("t"))).collect()]
    assert got == [1706670000000000, 1706670000123000, 1706670000123456, 1706670000123456, 1706670000123456, None, None, None, None]


def test_uuid_of_null(spark):
    import uuid

    df = spark.createDataFrame([("é",), (None,)], "n string").select(uuid5(uuid.NAMESPACE_URL, F.col("n")))
    assert [r[0] for r in df.collect()] == [str(uuid.uuid5(uuid.NAMESPACE_URL, "é")), None]


def test_days_add_up(spark):
    rows = binding.intervals(spark, SF)
    days = intervals.split_days(rows, binding.SPEC.zone)
    assert days.agg(F.sum("spent")).first()[0] == rows.agg(F.sum(F.col("seen_until") - F.col("started"))).first()[0]


def test_intervals_are_continuous(spark):
    rows = binding.intervals(spark, SF)
    follow = rows.withColumn("next", F.lead("started").over(intervals.in_order()))
    assert follow.filter("not (ended <=> next)").count() == 0
    assert rows.filter("ended is null").groupBy("case_id").count().filter("count > 1").count() == 0


def test_day_split_over_clock_change(spark):
    start = datetime(2018, 11, 3, 12, tzinfo=timezone.utc)
    end = datetime(2018, 11, 5, 12, tzinfo=timezone.utc)
    one = spark.createDataFrame([(1, "x", int(start.timestamp() * 1e6), int(end.timestamp() * 1e6))], "case_id int, status string, started long, seen_until long")
    got = {str(r["day"]): r["spent"] / HOUR for r in intervals.split_days(one, "America/Sao_Paulo").collect()}
    assert got == {"2018-11-03": 15.0, "2018-11-04": 23.0, "2018-11-05": 10.0}


def test_upsert_prefers_news(spark):
    old = spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "k int, v string, seen int")
    new = spark.createDataFrame([(2, "c", 9), (3, "d", 9)], "k int, v string, seen int")
    assert sorted(map(tuple, quality.upsert(old, new, ["k"], "seen").collect())) == [(1, "a", 5), (2, "c", 6), (3, "d", 9)]


def test_landed_pages(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"source":"s","captured_at":"t","logs":[{"id":"1","event":"e","created_at":"1706670000","data":"{\\"item\\":\\"7\\",\\"value\\":{\\"label\\":\\"x\\"}}"},{"id":"2","event":"e","created_at":"?","data":"no"}]}\n')
    typed = logs.typed_log(logs.landed_pages(spark, str(tmp_path))).orderBy("event_id").collect()
    assert [(r["item_id"], r["label"], r["warnings"]) for r in typed] == [(7, "x", ""), (None, None, "item,time,json")]
    with pytest.raises(ValueError):
        logs.once(spark.createDataFrame([("1", "a"), ("1", "b")], "event_id string, hash string"))


def test_stream_upserts(spark, tmp_path):
    from stagetime.streaming.incremental import current_rows, write_upserts

    schema = "k int, v string, seen int"
    for k, rows in enumerate([[(1, "a", 1), (2, "b", 1), (2, "c", 2)], [(2, "d", 3), (3, "e", 1)]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        write_upserts(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp"), ["k"], ("seen",), buckets=4).awaitTermination()
        got = sorted(map(tuple, current_rows(spark, str(tmp_path / "out")).select("k", "v", "seen").collect()))
        assert got == [[(1, "a", 1), (2, "c", 2)], [(1, "a", 1), (2, "d", 3), (3, "e", 1)]][k]
    versions = {(r["bucket"], r["batch"]) for r in spark.read.parquet(str(tmp_path / "out")).select("bucket", "batch").distinct().collect()}
    assert len(versions) < 8  # a batch writes the buckets of its own keys


def test_files(spark, tmp_path):
    from stagetime.sources import files

    df = spark.createDataFrame([(1, None, datetime(2024, 1, 5)), (2, "é", datetime(2024, 2, 6))], "a long, b string, t timestamp")
    files.write_lines(df, str(tmp_path / "lines"))
    assert sorted(map(tuple, files.read_lines(spark, str(tmp_path / "lines"), "a long, b string, t timestamp").collect())) == sorted(map(tuple, df.collect()))
    files.archive_day(df, str(tmp_path / "days"), "2024-03-01")
    files.archive_day(df, str(tmp_path / "days"), "2024-03-02")
    with pytest.raises(ValueError, match="archived already"):
        files.archive_day(df, str(tmp_path / "days"), "2024-03-01")
    assert spark.read.parquet(str(tmp_path / "days")).groupBy("dt").count().count() == 2
    files.write_by_month(df, str(tmp_path / "months"), F.col("t"), ["a"])
    assert {r["month"] for r in spark.read.parquet(str(tmp_path / "months")).collect()} == {"2024-01", "2024-02"}
    df.write.parquet(str(tmp_path / "typed"))
    assert files.read_typed(spark, str(tmp_path / "typed"), "a long, b string, t timestamp").count() == 2
    for wrong in ("a long, b string", "a int, b string, t timestamp"):
        with pytest.raises(ValueError, match="differ"):
            files.read_typed(spark, str(tmp_path / "typed"), wrong)


def test_small_functions(spark):
    from stagetime.functions import columns as C
    from stagetime.operators import rules

    row = spark.range(1).select(
        C.composed(F.lit("e\u0301")).alias("nfc"), C.plain_letters(F.lit("Ça ﬁn ß")).alias("plain"), C.source_key(F.lit("  São  Paulo ")).alias("key"), C.text_list(F.lit('["b","a"]')).alias("list"), C.list_text(F.array(F.lit("b"), F.lit("a"), F.lit("b"))).alias("text"),
        C.without_invalid(F.lit(" Deleted user ")).alias("nobody"), C.without_invalid(F.lit(" Ana ")).alias("ana"), C.first_time(a=F.lit(None).cast("long"), b=F.lit(5).cast("long")).alias("when"), C.iso_text(F.lit(-1).cast("long")).alias("iso"),
        rules.input_reasons(F.lit("Other"), F.lit(True), ("brief",)).alias("r1"), rules.input_reasons(F.lit(None).cast("string"), F.lit(True), ("brief",)).alias("r2"), rules.input_reasons(F.lit("brief"), F.lit(False), ("brief",)).alias("r3"), rules.stage_number(F.lit("x"), ("a", "x")).alias("stage"),
    ).first()
    assert (row["nfc"], row["plain"], row["key"], row["list"], row["text"]) == ("é", "ca fin ss", "são paulo", ["b", "a"], '["a","b"]')
    assert (row["nobody"], row["ana"], tuple(row["when"]), row["iso"], row["r1"], row["r2"], row["r3"], row["stage"]) == (None, "Ana", (5, "b"), "1969-12-31T23:59:59.999999Z", ["input_other"], ["input_blank"], ["input_unverified"], 2)
    columns = spark.createDataFrame([("c1", "Tipo  de Input"), ("c2", "x"), ("c3", "X")], "id string, title string")
    assert rules.only_column(columns, "tipo de input") == "c1"
    for title in ("x", "y"):
        with pytest.raises(ValueError):
            rules.only_column(columns, title)
    cells = spark.createDataFrame([(1, "owner", 7, "t"), (1, "owner", 8, "t"), (2, "owner", 99, "Eva"), (3, "owner", None, "Eva & Bo"), (4, "owner", None, " ")], "item int, role string, person_id int, text string")
    got = {r["item"]: (r["names"], r["situation"]) for r in rules.people_fields(cells, spark.createDataFrame([(7, "Zoe"), (8, "Ana")], "person_id int, name string")).collect()}
    assert got == {1: ("Ana + Zoe", "known"), 2: ("Eva", "text"), 3: (None, "several_texts"), 4: (None, "none")}

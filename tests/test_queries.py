"""Every query with SQL gives the rows of that SQL on the small tables."""

import pytest

import __spark_entry__ as entry
from stagetime.plans import queries as flow  # the entry has added the others

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(flow.SQL))
def test_same_as_sql(spark, duck, name):
    df = flow.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    out = duck.execute(flow.SQL[name])
    names = [d[0] for d in out.description]
    want = sorted(repr(tuple(row[names.index(c)] for c in columns)) for row in out.fetchall())
    assert sorted(names) == columns
    assert got == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_name_uuids(spark):
    import uuid

    rows = flow.name_uuids(spark, SF).join(spark.read.parquet(f"{SF}/customer.parquet").select("c_custkey", "c_name"), "c_custkey").collect()
    assert all(r["uuid"] == str(uuid.uuid5(flow._NAMESPACE, r["c_name"])) for r in rows)


def test_probable_spellings(spark):
    import difflib

    from stagetime.operators.identity import probable_spellings

    names = [("north wind", 5), ("north winds", 2), ("nort wind", 1), ("south", 9), ("ab", 3), ("north wind co", 1), ("jonas", 1), ("jonas sulz", 4), ("jonas sulx", 2), ("abc de", 3), ("nrth wind", 5)]
    rows = flow.probable_spellings(spark, SF)
    given = [(f"{r['p_name']} {r['p_brand']}".lower(), 1) for r in spark.read.parquet(f"{SF}/part.parquet").limit(120).collect()]
    given = [(n, 1 + i % 4) for i, n in enumerate(sorted({n for n, _ in given} | {n[:-2] + n[-1] for n, _ in given[::3]}))]
    for table in (names, given):
        got = {r["name"]: r["of"] for r in probable_spellings(spark.createDataFrame(table, "name string, uses long")).collect()}
        want = {}
        for a, n in table:
            fits = []
            for b, m in table:
                if (m, b) > (n, a):
                    prefix = len(a.split()) < len(b.split()) and b.split()[: len(a.split())] == a.split()
                    if prefix or min(len(a), len(b)) >= 5 and difflib.SequenceMatcher(None, a, b, autojunk=False).ratio() >= 0.9:
                        fits.append((m, b))
            if fits:
                want[a] = max(fits)[1]
        assert got == want and got
    assert {r["rule"] for r in rows.select("rule").distinct().collect()} == {"prefix", "ratio"}


def test_fingerprint_ignores_order(spark):
    from stagetime.functions.columns import fingerprint

    a = spark.createDataFrame([(1, "x"), (2, None)], "a int, b string")
    assert fingerprint(a).first() == fingerprint(a.orderBy("a", ascending=False)).first()
    assert fingerprint(a).first() != fingerprint(a.filter("a = 1")).first()

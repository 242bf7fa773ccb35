"""What tasks hold and do doesn't hang on how few files or partitions the rows come in."""

import random
from collections import Counter

from stagetime.operators import audits, proofs


def test_compared_counts_in_as_many_tasks_as_set(spark):
    r = random.Random(4)
    rows = [(r.randrange(40), r.choice([None, "x", "y", ""]), r.choice([None, -1, 0, 1, 1 << 40])) for _ in range(400)]
    other = [(k, s, n) if r.random() < 0.9 else (k, "z", n) for k, s, n in rows if r.random() < 0.97] + rows[:5]
    frame = lambda some: spark.createDataFrame(some, "k long, s string, n long")
    found = proofs.compared(frame(other), frame(rows), ["k"], ["s", "n"])
    want = {}
    for k in {x[0] for x in [*rows, *other]}:
        a, b = [x for x in other if x[0] == k], [x for x in rows if x[0] == k]
        differs = [f for i, f in ((1, "s"), (2, "n")) if Counter(x[i] for x in a) != Counter(x[i] for x in b)]
        kind = "missing" if not a else "extra" if not b else "repeated" if len(a) > len(b) else "lacking" if len(a) < len(b) else "changed" if differs else None
        if kind:
            want[k] = (kind, ",".join(differs) if kind == "changed" else "")
    assert {x["k"]: (x["kind"], x["fields"]) for x in found.collect()} == want and len({v[0] for v in want.values()}) >= 3
    # Adaptive execution would merge so few rows to one task; and a field's sums are longs.
    assert found.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions")) > 1
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "decimal" not in plan and "HashAggregate" in plan


def test_composite_keys_deals_rows_out_before_they_multiply(spark):
    r = random.Random(6)
    fields = ["p", "q", "s"]
    make = lambda n: [(r.choice(["a", "b", "", None]), *(r.choice([None, "", *"123456"]) for _ in fields)) for _ in range(n)]
    old, new = make(60), make(90)
    frame = lambda some: spark.createDataFrame(some, "name string, p string, q string, s string").coalesce(1)
    got = audits.composite_keys(frame(old), frame(new), "name", fields)
    count = lambda some, at: Counter((x[0], *(x[i] for i in at)) for x in some if x[0] and all(x[i] for i in at))
    names = [count(some, ()) for some in (old, new)]
    repeated = {k[0] for k in names[0].keys() & names[1].keys() if names[0][k] > 1 or names[1][k] > 1}
    common = lambda i: len({x[i] for x in old if x[i] is not None} & {x[i] for x in new if x[i] is not None})
    order = sorted((1, 2, 3), key=lambda i: (-common(i), fields[i - 1]))
    want = {}
    for at in [(i,) for i in order] + [(a, b) for k, a in enumerate(order) for b in order[k + 1 :]]:
        a, b = count(old, at), count(new, at)
        both = a.keys() & b.keys()
        one = [k for k in both if a[k] == b[k] == 1]
        if both:
            want["+".join(fields[i - 1] for i in at)] = (len(one), len(both) - len(one), sum(k[0] in repeated for k in one))
    assert {x["fields"]: tuple(x)[1:] for x in got.collect()} == want and len(want) == 6
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Repartition 2, true") >= 2

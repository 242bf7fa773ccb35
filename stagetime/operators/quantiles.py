"""Exact quantiles and running totals whose memory doesn't grow with a group.

Values are counted first, and the counts are cut into ranges of about one per cent of a value's size; only the
sums of the ranges, of which a group has a few thousand at most, are brought together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranges for each doubling of a value.
RANGES = 64


def _ranged(counts: DataFrame, value: str) -> DataFrame:
    """counts with _part, the range that the value is in; ranges rise with the values."""
    v = F.col(value).cast("double")
    return counts.withColumn("_part", (F.signum(v) * F.floor(F.log2(1 + F.abs(v)) * RANGES)).cast("int"))


def running_total(counts: DataFrame, value: str, n: str, by: tuple[str, ...] = (), part: Column | None = None) -> DataFrame:
    """counts(by, value, n) with upto, the sum of n over all values of the group up to it, and total.

    part is the range that a value is in, if not the one by its size; it rises with the value.
    """
    parted = _ranged(counts, value) if part is None else counts.withColumn("_part", part)
    sums = parted.groupBy(*by, "_part").agg(F.sum(n).alias("_n"))
    group = Window.partitionBy(*by)
    before = F.coalesce(F.sum("_n").over(group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    carried = sums.select(*by, "_part", before.alias("_before"), F.sum("_n").over(group).alias("total"))
    inside = F.sum(n).over(Window.partitionBy(*by, "_part").orderBy(value))
    met = [F.col(f"p.{c}").eqNullSafe(F.col(f"c.{c}")) for c in (*by, "_part")]
    joined = parted.withColumn("_inside", inside).alias("p").join(carried.alias("c"), met)
    return joined.select(*[f"p.{c}" for c in counts.columns], (F.col("_inside") + F.col("_before")).alias("upto"), "total")


def quantiles(rows: DataFrame, by: tuple[str, ...], value: Column, marks: dict[str, float], digits: int = 3) -> DataFrame:
    """by, n and each mark's quantile with linear interpolation, rounded: {"p50": 0.5, ...}.

    Null values don't count.  A group without values isn't in the result, and null is a group like others.
    """
    counts = rows.select(*by, value.cast("double").alias("_v")).filter("_v is not null").groupBy(*by, "_v").agg(F.count("*").alias("_c")).filter("_c > 0")
    totals = running_total(counts, "_v", "_c", by)
    aggs = []
    for name, p in marks.items():
        rank = (F.col("total") - 1) * F.lit(p)
        aggs += [F.min(F.when(F.col("upto") > F.floor(rank), F.col("_v"))).alias(f"_lo_{name}"), F.min(F.when(F.col("upto") > F.ceil(rank), F.col("_v"))).alias(f"_hi_{name}")]
    got = totals.groupBy(*by).agg(F.first("total").alias("n"), *aggs)
    out = []
    for name, p in marks.items():
        rank = (F.col("n") - 1) * F.lit(p)
        out.append(F.round(F.col(f"_lo_{name}") + (rank - F.floor(rank)) * (F.col(f"_hi_{name}") - F.col(f"_lo_{name}")), digits).alias(name))
    return got.select(*by, "n", *out)


def with_quantiles(grouped: DataFrame, rows: DataFrame, by: tuple[str, ...], value: Column, marks: dict[str, float], digits: int = 3) -> DataFrame:
    """An aggregate of rows by the same columns with the quantiles beside it; null where a group has no values."""
    found = quantiles(rows, by, value, marks, digits).drop("n")
    met = [F.col(f"g.{c}").eqNullSafe(F.col(f"q.{c}")) for c in by]
    return grouped.alias("g").join(found.alias("q"), met, "left").select("g.*", *[f"q.{m}" for m in marks])

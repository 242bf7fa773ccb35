"""Tables as files: lines of JSON, a daily archive, declared schemas on read, tables by month."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def write_lines(df: DataFrame, path: str, compress: bool = True) -> None:
    """One JSON object a line, nulls written out, so that every row has all columns."""
    df.write.options(compression="gzip" if compress else "none", ignoreNullFields="false").json(path)


def read_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Lines of JSON under a declared schema; a line that doesn't fit stops the read."""
    return spark.read.schema(schema).options(mode="FAILFAST").json(path)


def archive_day(df: DataFrame, path: str, day: str) -> None:
    """Adds a day's rows to an archive partitioned by dt; a day that is there already is never written over."""
    try:
        there = df.sparkSession.read.parquet(path).filter(F.col("dt") == F.lit(day).cast("date")).limit(1).count()
    except AnalysisException:
        there = 0
    if there:
        raise ValueError(f"{day} is archived already")
    df.withColumn("dt", F.lit(day).cast("date")).write.partitionBy("dt").mode("append").parquet(path)


def read_typed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table whose columns and types are those declared; raises where they differ."""
    want, got = StructType.fromDDL(schema), spark.read.parquet(path).schema
    differs = {f.name for f in want.fields} ^ {f.name for f in got.fields} | {f.name for f in want.fields if f.name in got.names and got[f.name].dataType != f.dataType}
    if differs:
        raise ValueError(f"columns that differ from what is declared: {', '.join(sorted(differs))}")
    return spark.read.schema(schema).parquet(path)


def write_by_month(df: DataFrame, path: str, day: Column, key: list[str], slices: int = 8) -> None:
    """Parquet partitioned by month and sorted by key; a month is written by so many tasks, however large it is."""
    rows = df.withColumn("month", F.date_format(day, "yyyy-MM"))
    spread = F.pmod(F.xxhash64(*key), F.lit(slices))
    rows.repartition("month", spread).sortWithinPartitions("month", *key).write.partitionBy("month").parquet(path)

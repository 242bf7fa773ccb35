"""The log as a stream: deduplicated reads, upserts of each micro-batch."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import upsert


def log_stream(spark: SparkSession, path: str, schema: str, overlap: str = "1 day") -> DataFrame:
    """Events of a folder of Parquet files; repeats of an event_id within the overlap are dropped."""
    return spark.readStream.schema(schema).parquet(path).withWatermark("ts", overlap).dropDuplicatesWithinWatermark(["event_id"])


def current_rows(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """The table that write_upserts keeps: of each bucket its last version, or the last before a batch."""
    rows = spark.read.parquet(path)
    rows = rows if before is None else rows.filter(F.col("batch") < before)
    last = rows.groupBy("bucket").agg(F.max("batch").alias("batch"))  # one row for each bucket
    return rows.join(F.broadcast(last), ["bucket", "batch"], "left_semi")


def write_upserts(stream: DataFrame, path: str, checkpoint: str, key: list[str], order: tuple[str, ...] = (), buckets: int = 64):
    """Starts a query that merges each micro-batch by key into a table of buckets under path.

    A batch reads and writes only the buckets that its keys fall in, as versions numbered by the batch; one
    that runs again reads what was there before it and writes the same versions.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        news = batch.withColumn("bucket", F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"))
        touched = [r[0] for r in news.select("bucket").distinct().collect()]  # at most buckets
        if not touched:
            return
        try:
            base = current_rows(spark, path, number).filter(F.col("bucket").isin(touched)).select(news.columns)
        except AnalysisException:
            base = news.limit(0)
        merged = upsert(base, news, key, order=order).withColumn("batch", F.lit(number))
        merged.write.partitionBy("bucket", "batch").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

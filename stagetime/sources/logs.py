"""Raw logs: landing pages, typed projections, duplicate guards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import event_micros

PAGE = "source string, captured_at string, logs array<struct<id:string,event:string,created_at:string,data:string>>"


def landed_pages(spark: SparkSession, path: str) -> DataFrame:
    """One row for each event of landed JSON pages, plain or gzip, with the file that it came from."""
    pages = spark.read.schema(PAGE).json(path)
    return pages.select("source", "captured_at", F.input_file_name().alias("file"), F.explode("logs").alias("e")).select("source", "captured_at", "file", "e.*")


def typed_log(raw: DataFrame) -> DataFrame:
    """event_id, item_id, label, at and warnings of raw(id, event, created_at, data); nothing is lost.

    What can't be read becomes null and is named in warnings; hash is of the raw row.
    """
    item = F.try_to_number(F.get_json_object("data", "$.item"), F.lit("9999999999999999999")).cast("long")
    at = event_micros(F.col("created_at"))
    label = F.coalesce(F.get_json_object("data", "$.value.label.text"), F.get_json_object("data", "$.value.label"))
    warnings = F.array_compact(F.array(F.when(item.isNull(), "item"), F.when(at.isNull(), "time"), F.when(F.get_json_object("data", "$").isNull(), "json")))
    return raw.select(F.col("id").alias("event_id"), "event", item.alias("item_id"), label.alias("label"), at.alias("at"), F.array_join(warnings, ",").alias("warnings"), F.sha2(F.concat_ws("|", "id", "event", "created_at", "data"), 256).alias("hash"))


def once(typed: DataFrame) -> DataFrame:
    """Rows without repeats; raises if an event_id stands for unlike rows.  The guard starts a job when this is called."""
    clash = typed.groupBy("event_id").agg(F.count_distinct("hash").alias("n")).filter("n > 1").limit(1).collect()
    if clash:
        raise ValueError(f"event {clash[0]['event_id']} has unlike copies")
    return typed.dropDuplicates(["event_id"])


def summary(typed: DataFrame) -> DataFrame:
    return typed.agg(F.count_distinct("event_id").alias("events"), (F.count("*") - F.count_distinct("event_id")).alias("duplicates"), F.count_if(F.col("at").isNull()).alias("bad_times"), F.min("at").alias("first_at"), F.max("at").alias("last_at"))

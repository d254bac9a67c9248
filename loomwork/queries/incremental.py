"""Incremental loading as queries: a stream of files must equal the batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.core.artifacts import publish, remove
from loomwork.core.scratch import fresh_folder
from loomwork.queries.registry import query, table
from loomwork.streaming import incremental


@query("SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY 1")
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events landed as files, merged by user with the latest event winning."""
    root = fresh_folder(spark, "stream_upsert")
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    publish(events.repartition(4, "event_id"), f"{root}/landing")
    stream = incremental.stream_files(spark, f"{root}/landing", events.schema, "parquet", files_per_batch=2)
    incremental.upsert_stream(stream, f"{root}/target", ["user_id"], f"{root}/checkpoint", "event_id")
    remove(spark, f"{root}/landing")
    return incremental.read_target(spark, f"{root}/target").select("user_id", "event_id", "event_type")


@query("SELECT event_type, count(*) AS n FROM events WHERE NOT (value > 50) GROUP BY 1")
def resume_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rerun sees only what an earlier run has not produced."""
    root = fresh_folder(spark, "resume_stream")
    events = table(spark, sf_dir, "events")
    publish(events.where("value > 50").select("event_id"), f"{root}/done")
    return incremental.resume(events, f"{root}/done", "event_id").groupBy("event_type").agg(F.count("*").alias("n"))

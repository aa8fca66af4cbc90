"""Queries that run as streams over the events and read their tables back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import windows
from ..session import scratch
from ..streaming import pipelines
from .registry import query


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipelines.file_stream(spark, f"{sf_dir}/events.parquet")


def _place(spark: SparkSession) -> str:
    return scratch(spark, "streams")


def _stamp(c: str):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


@query("SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1")
def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event comes twice; one stays."""
    twice = _events(spark, sf_dir).withColumn("again", F.explode(F.array(F.lit(0), F.lit(1)))).drop("again")
    rows = pipelines.run_to_table(pipelines.deduplicate(twice, ["event_id"], "ts"), _place(spark), "append")
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pipelines.run_to_table(pipelines.tumbling(_events(spark, sf_dir), "ts", "1 hour", ["event_type"]), _place(spark), "complete")
    return out.select(_stamp("start").alias("start"), "event_type", "n")


@query("SELECT strftime(date_trunc('hour', ts) - INTERVAL (k) HOUR, '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n FROM events, (SELECT unnest([0, 1]) AS k) GROUP BY 1")
def stream_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pipelines.run_to_table(pipelines.tumbling(_events(spark, sf_dir), "ts", "2 hours", [], "1 hour"), _place(spark), "complete")
    return out.select(_stamp("start").alias("start"), "n")


@query("""
    WITH s AS (SELECT user_id, ts, CAST(coalesce(ts - lag(ts) OVER w > INTERVAL 30 MINUTE, true) AS INTEGER) AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    g AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM s)
    SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, strftime(max(ts) + INTERVAL 30 MINUTE, '%Y-%m-%d %H:%M:%S') AS "end", count(*) AS n FROM g GROUP BY user_id, session""")
def stream_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pipelines.run_to_table(pipelines.sessions(_events(spark, sf_dir), "ts", "30 minutes", ["user_id"]), _place(spark), "complete")
    return out.select("user_id", _stamp("start").alias("start"), _stamp("end").alias("end"), "n")


@query("""
    SELECT user_id, event_id, event_type FROM events QUALIFY event_type IS DISTINCT FROM lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id)""")
def stream_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    out = pipelines.run_to_table(pipelines.changes_only(events, "user_id", ["ts", "event_id"], "event_type"), _place(spark), "append")
    return out.select("user_id", "event_id", "event_type")


@query("""
    WITH c AS (SELECT * FROM events QUALIFY event_type IS DISTINCT FROM lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id))
    SELECT user_id, row_number() OVER w AS version, event_type, lead(ts) OVER w IS NULL AS is_current, strftime(ts, '%Y-%m-%d %H:%M:%S') AS valid_from FROM c WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def stream_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change stream lands in a table; versions are those of the keys that it touched."""
    events = _events(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    out = pipelines.run_to_table(pipelines.changes_only(events, "user_id", ["ts", "event_id"], "event_type"), _place(spark), "append")
    versions = windows.scd2(out, ["user_id"], ["ts", "event_id"], ["event_type"])
    return versions.select("user_id", "version", "event_type", "is_current", _stamp("valid_from").alias("valid_from"))

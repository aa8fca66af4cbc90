"""Queries over the raw layer, with events as observations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import similarity
from ..sources import files, raw
from ..session import load, scratch
from .registry import query


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events")
    payload = F.when(F.col("event_type") == "error", F.concat(F.lit('{"x":{"y":'), F.col("user_id").cast("string"), F.lit("}}"))).otherwise(F.replace("props", F.lit(" "), F.lit("")))
    status = F.when(F.col("event_id") % 20 == 0, 404).otherwise(200)
    return events.select("event_id", F.lit("app").alias("source"), F.col("event_type").alias("entity_type"), F.col("user_id").alias("natural_key"), F.col("ts").alias("fetched_at"), status.alias("http_status"), payload.alias("payload"))


_OBS = """(SELECT event_id, event_type AS entity_type, user_id AS natural_key, ts AS fetched_at, CASE WHEN event_id % 20 = 0 THEN 404 ELSE 200 END AS http_status,
    CASE WHEN event_type = 'error' THEN '{"x":{"y":' || user_id || '}}' ELSE replace(props, ' ', '') END AS payload FROM events)"""


@query(f"SELECT entity_type, path AS field_path, count(*) AS n FROM (SELECT entity_type, unnest(CASE WHEN entity_type = 'error' THEN ['x', 'x.y'] ELSE ['k'] END) AS path FROM {_OBS}) GROUP BY 1, 2")
def schema_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    spread = observations(spark, sf_dir).select("entity_type", F.explode(raw.field_paths(F.col("payload"))).alias("field_path"))
    return spread.groupBy("entity_type", "field_path").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT DISTINCT entity_type, unnest(['x', 'x.y']) AS field_path FROM {_OBS} WHERE entity_type = 'error'")
def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The known shape of every entity is a lone k; new paths are drift."""
    batch = observations(spark, sf_dir)
    known = batch.select("source", "entity_type").distinct().withColumn("field_path", F.lit("k"))
    return raw.drift(batch, known).select("entity_type", "field_path")


@query(f"SELECT entity_type, CASE WHEN entity_type = 'error' AND http_status = 200 THEN 'k' ELSE '' END AS errors, count(*) AS n FROM {_OBS} GROUP BY 1, 2")
def contract_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, bad = raw.quarantine(observations(spark, sf_dir), ["k"])
    both = good.select("entity_type", F.lit("").alias("errors")).unionByName(bad.select("entity_type", F.array_join("errors", ",").alias("errors")))
    return both.groupBy("entity_type", "errors").agg(F.count(F.lit(1)).alias("n"))


@query(f"""
    SELECT sha256(payload) AS payload_sha256, any_value(payload) AS payload, CAST(max(length(payload)) AS INTEGER) AS byte_size, strftime(min(fetched_at), '%Y-%m-%d %H:%M:%S') AS first_seen_at, count(*) AS observations FROM {_OBS} GROUP BY 1""")
def content_addressed(spark: SparkSession, sf_dir: str) -> DataFrame:
    payloads, pointers = raw.content_address(observations(spark, sf_dir), ordered=True)
    seen = pointers.groupBy("payload_sha256").agg(F.count(F.lit(1)).alias("observations"))
    return payloads.join(seen, "payload_sha256").select("payload_sha256", "payload", "byte_size", F.date_format("first_seen_at", "yyyy-MM-dd HH:mm:ss").alias("first_seen_at"), "observations")


@query(f"SELECT entity_type, natural_key, count(*) AS n, count(DISTINCT payload) AS payloads FROM {_OBS} WHERE entity_type IN ('view', 'error') AND (entity_type = 'error' OR http_status = 200) GROUP BY 1, 2")
def raw_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    payloads, pointers = raw.content_address(observations(spark, sf_dir), ordered=True)
    both = raw.raw_entity(pointers, payloads, "app", "view").unionByName(raw.raw_entity(pointers, payloads, "app", "error", ok_only=False))
    return both.groupBy("entity_type", "natural_key").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("payload").alias("payloads"))


@query("SELECT o_orderpriority, count(*) AS n, CAST(0 AS BIGINT) AS mismatches, count(DISTINCT o_orderstatus) AS states FROM orders GROUP BY 1")
def lossless_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Split and merge every order's JSON; the whole must come back."""
    orders = load(spark, sf_dir, "orders").withColumn("json", F.to_json(F.struct("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")))
    stable, moved = raw.split_lossless(F.col("json"), ["o_orderstatus"])
    merged = orders.withColumn("stable", stable).withColumn("moved", moved).withColumn("merged", raw.merge_split(F.col("stable"), F.col("moved")))
    key = lambda m: F.array_sort(F.map_entries(m))
    wrong = key(F.col("merged")) != key(F.from_json("json", "map<string,string>"))
    return merged.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(wrong, 1)).alias("mismatches"), F.countDistinct(F.col("moved")["o_orderstatus"]).alias("states"))


@query()
def pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = load(spark, sf_dir, "customer")
    return customers.select("c_custkey", similarity.pseudonym(F.col("c_name"), "customer", "a-fixed-salt").alias("pseudonym"))


@query("""
    SELECT split, count(*) AS n, count(DISTINCT o_custkey) AS customers, max(o_orderkey) AS last FROM (SELECT *, CASE WHEN o_orderdate > TIMESTAMP '1997-01-01' THEN 'test'
        WHEN CAST('0x' || substr(md5(CAST(o_custkey AS VARCHAR)), 1, 8) AS BIGINT) % 1000 < 200 THEN 'validation' ELSE 'train' END AS split FROM orders) GROUP BY 1""")
def export_training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write a versioned training set, read it back and count its splits."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    rows = files.with_split(orders, "o_orderdate", "1997-01-01", "o_custkey")
    manifest = files.export_version(rows, scratch(spark, "exports"), "orders", ["o_orderkey"], "1997-01-01")
    back = spark.read.parquet(manifest["path"])
    return back.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("o_custkey").alias("customers"), F.max("o_orderkey").alias("last"))

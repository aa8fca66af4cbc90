"""Queries over predicates, conditional joins, whole-partition counts, samples and writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions import clean, geo
from ..operators import windows
from ..session import load, scratch
from ..sources import files
from .registry import query


@query("""
    SELECT event_type, count(*) FILTER (event_id % 3 > 0) AS has_n, count(*) FILTER (event_id % 3 = 1) AS null_n, count(*) FILTER (event_id % 3 = 2) AS value_n, count(*) AS any_of FROM events GROUP BY 1""")
def json_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key that is missing, null and filled are three things: key existence, JSON null, and any of several keys."""
    payload = F.when(F.col("event_id") % 3 == 0, F.lit('{"k": 1}')).when(F.col("event_id") % 3 == 1, F.lit('{"k": 1, "n": null}')).otherwise(F.lit('{"n": 2}'))
    rows = load(spark, sf_dir, "events").withColumn("keys", F.json_object_keys(payload)).withColumn("n", F.try_variant_get(F.try_parse_json(payload), "$.n", "variant"))
    has = F.array_contains("keys", "n")
    return rows.groupBy("event_type").agg(
        F.count_if(has).alias("has_n"), F.count_if(has & F.is_variant_null("n")).alias("null_n"), F.count_if(has & ~F.is_variant_null("n")).alias("value_n"),
        F.count_if(F.arrays_overlap("keys", F.array(F.lit("k"), F.lit("n")))).alias("any_of"),
    )


@query("""
    SELECT p_partkey FROM part WHERE p_name ILIKE '%RED%' AND p_size BETWEEN 5 AND 30 AND p_brand NOT IN ('Brand#11', 'Brand#12') AND p_type LIKE '%A%' OR p_partkey IN (1, 2)""")
def pattern_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    chosen = c("p_name").ilike("%RED%") & c("p_size").between(5, 30) & ~c("p_brand").isin("Brand#11", "Brand#12") & c("p_type").like("%A%")
    return load(spark, sf_dir, "part").filter(chosen | c("p_partkey").isin(1, 2)).select("p_partkey")


@query("SELECT c_custkey, count(*) AS orders FROM customer JOIN (SELECT 'customer:' || o_custkey AS k FROM orders) ON k = 'customer:' || c_custkey GROUP BY 1")
def derived_key_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that only arise by putting parts together."""
    made = load(spark, sf_dir, "orders").select(F.concat(F.lit("customer:"), F.col("o_custkey").cast("string")).alias("k"))
    owners = load(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("customer:"), F.col("c_custkey").cast("string")).alias("k"))
    return owners.join(made, "k").groupBy("c_custkey").agg(F.count(F.lit(1)).alias("orders"))


@query("SELECT c_custkey, count(o_orderkey) AS urgent, coalesce(sum(o_totalprice), 0) > 0 AS any_urgent FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderpriority = '1-URGENT' AND c_mktsegment = 'BUILDING' GROUP BY 1")
def conditional_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A condition of the join leaves rows in; as a filter after it, it would not."""
    c, o = load(spark, sf_dir, "customer"), load(spark, sf_dir, "orders")
    both = c.join(o, (o["o_custkey"] == c["c_custkey"]) & (o["o_orderpriority"] == "1-URGENT") & (c["c_mktsegment"] == "BUILDING"), "left")
    return both.groupBy("c_custkey").agg(F.count("o_orderkey").alias("urgent"), (F.coalesce(F.sum("o_totalprice"), F.lit(0)) > 0).alias("any_urgent"))


@query("""
    SELECT DISTINCT l_orderkey FROM lineitem JOIN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 8000) s ON l_suppkey = s.s_suppkey UNION
    SELECT DISTINCT l_orderkey FROM lineitem JOIN (SELECT p_partkey FROM part WHERE p_size = 1) p ON l_partkey = p.p_partkey""")
def either_key_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One of two keys is enough: a union of two equi joins, not an OR over pairs."""
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_partkey")
    s = load(spark, sf_dir, "supplier").filter("s_acctbal > 8000").select(F.col("s_suppkey").alias("l_suppkey"))
    p = load(spark, sf_dir, "part").filter("p_size = 1").select(F.col("p_partkey").alias("l_partkey"))
    return lines.join(s, "l_suppkey", "left_semi").select("l_orderkey").union(lines.join(p, "l_partkey", "left_semi").select("l_orderkey")).distinct()


@query("""
    SELECT o_orderkey, count(*) OVER w AS orders, count(*) FILTER (o_orderstatus = 'F') OVER w AS finished FROM orders WINDOW w AS (PARTITION BY o_custkey)""")
def partition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole-partition counts, all rows and those that a condition picks."""
    w = Window.partitionBy("o_custkey")
    return load(spark, sf_dir, "orders").select("o_orderkey", F.count(F.lit(1)).over(w).alias("orders"), F.count_if(F.col("o_orderstatus") == "F").over(w).alias("finished"))


@query("""
    SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN round(percent_rank() OVER (PARTITION BY c_mktsegment, c_acctbal > 0 ORDER BY c_acctbal), 9) END AS pct FROM customer""")
def rank_within_condition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranks among the rows for which a condition holds: the condition is part of the partition."""
    good = F.col("c_acctbal") > 0
    rank = F.percent_rank().over(Window.partitionBy("c_mktsegment", good).orderBy("c_acctbal"))
    return load(spark, sf_dir, "customer").select("c_custkey", F.when(good, F.round(rank, 9)).alias("pct"))


@query("SELECT p_partkey, nullif(trim(lower(regexp_replace(strip_accents('Café ' || p_name || ' & Söhne'), '[^a-zA-Z0-9]+', ' ', 'g'))), '') AS brand_key FROM part")
def brand_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.lit("Café "), "p_name", F.lit(" & Söhne"))
    return load(spark, sf_dir, "part").select("p_partkey", clean.brand_key(name).alias("brand_key"))


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderpriority, md5(CAST(o_orderkey AS VARCHAR))) AS place FROM orders QUALIFY place <= 50")
def scatter_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Work by priority, scattered within one: neighbours by key are far apart in the queue."""
    chosen = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", F.md5(F.col("o_orderkey").cast("string")).alias("_scatter"))
    top = chosen.orderBy("o_orderpriority", "_scatter").limit(50)  # the report's size
    return top.select("o_orderkey", F.row_number().over(Window.orderBy("o_orderpriority", "_scatter")).cast("long").alias("place"))


@query("SELECT least(200, count(*)) AS n, least(200, count(*)) AS distinct_n, true AS inside FROM customer")
def random_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample of 200 for review, without repeats; the same seed gives the same rows."""
    customers = load(spark, sf_dir, "customer").select("c_custkey")
    sample = windows.random_rows(customers, "c_custkey", 200, 7)
    return sample.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("c_custkey").alias("distinct_n"), (F.min("c_custkey") >= 0).alias("inside"))


@query("""
    SELECT c_custkey, CASE WHEN lon <= 5 THEN CASE WHEN lat <= 5 THEN 'a' ELSE 'b' END WHEN lat <= 10 - (lon - 5) THEN 'c' END AS area
    FROM (SELECT c_custkey, (c_custkey * 7 % 1000) / 100.0::DOUBLE AS lon, (c_custkey * 13 % 1000) / 100.0::DOUBLE AS lat FROM customer)""")
def polygon_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points and the areas that cover them: two squares and a triangle, borders to the smaller code."""
    corner = lambda lon, lat: F.struct(F.lit(float(lon)).alias("lon"), F.lit(float(lat)).alias("lat"))
    rings = {"a": [(0, 0), (5, 0), (5, 5), (0, 5)], "b": [(0, 5), (5, 5), (5, 10), (0, 10)], "c": [(5, 0), (15, 0), (5, 10)]}
    areas = None
    for code, ring in rings.items():
        one = spark.range(1).select(F.lit("k").alias("kind"), F.lit(code).alias("code"), F.lit(code).alias("name"), F.array(*[corner(*x) for x in ring]).alias("ring"))
        areas = one if areas is None else areas.unionByName(one)
    key = F.col("c_custkey")
    points = load(spark, sf_dir, "customer").select("c_custkey", ((key * 7 % 1000) / 100.0).alias("lon"), ((key * 13 % 1000) / 100.0).alias("lat"))
    return points.join(geo.covering_areas(points, areas, 0.5), ["lat", "lon"], "left").select("c_custkey", F.col("areas")["k"]["code"].alias("area"))


@query("SELECT kind, count(*) AS n, sum(value) AS total FROM (SELECT 'a' AS kind, s_suppkey * 10 AS value FROM supplier UNION ALL SELECT 'b', s_suppkey FROM supplier) GROUP BY 1")
def replaced_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table by kind, of which one kind is written anew: the other stays as it is."""
    path = scratch(spark, "by-kind")
    rows = load(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("long").alias("value"), F.explode(F.array(F.lit("a"), F.lit("b"))).alias("kind"))
    files.replace_kinds(rows, path, "kind")
    files.replace_kinds(rows.filter("kind = 'a'").withColumn("value", F.col("value") * 10), path, "kind")
    return spark.read.parquet(path).groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


@query("SELECT 'nation' AS name, count(*) AS n, count(*) AS back, true AS checked FROM nation UNION ALL SELECT 'region', count(*), count(*), true FROM region")
def snapshot_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables written with row counts and checksums, read back against these."""
    path = scratch(spark, "snapshot")
    manifest = files.snapshot({t: load(spark, sf_dir, t) for t in ("nation", "region")}, path)
    back = {r["name"]: files.checksum(spark.read.parquet(f"{path}/{r['name']}")) for r in manifest.collect()}
    found = spark.createDataFrame([(k, n, c) for k, (n, c) in back.items()], "name string, back long, again string")
    return manifest.join(found, "name").select("name", F.col("rows").alias("n"), "back", (F.col("checksum") == F.col("again")).alias("checked"))


@query("SELECT yyyymm, count(*) AS n, min(rank_bucket) AS best FROM (SELECT CASE WHEN s_suppkey % 2 = 0 THEN 202511 ELSE 202512 END AS yyyymm, s_suppkey * 1000 AS rank_bucket FROM supplier) GROUP BY 1")
def ranked_origins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compressed CSV of origins and ranks, whose origin may hold commas: the rank is what stands after the last one."""
    path = scratch(spark, "origins")
    s = load(spark, sf_dir, "supplier").withColumn("yyyymm", F.when(F.col("s_suppkey") % 2 == 0, 202511).otherwise(202512))
    lines = s.select("yyyymm", F.concat(F.lit("https://a,b"), F.col("s_suppkey").cast("string"), F.lit(".de,"), (F.col("s_suppkey") * 1000).cast("string")).alias("value"))
    lines.write.partitionBy("yyyymm").option("compression", "gzip").text(path)
    return files.read_ranked(spark, path).groupBy("yyyymm").agg(F.count(F.lit(1)).alias("n"), F.min("rank_bucket").alias("best"))

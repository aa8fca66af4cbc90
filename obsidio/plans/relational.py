"""Queries over joins, sets, aggregates and nested data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..operators import windows
from ..session import load
from .registry import query


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')")
def semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    urgent = load(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'").select("o_custkey")
    customers = load(spark, sf_dir, "customer")
    return customers.join(urgent, customers["c_custkey"] == urgent["o_custkey"], "left_semi").select("c_custkey", "c_mktsegment")


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 200000)")
def anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    large = load(spark, sf_dir, "orders").filter("o_totalprice > 200000").select("o_custkey")
    customers = load(spark, sf_dir, "customer")
    return customers.join(large, customers["c_custkey"] == large["o_custkey"], "left_anti").select("c_custkey", "c_mktsegment")


@query("""
    SELECT coalesce(a.k, b.k) AS nationkey, customers, suppliers FROM (SELECT c_nationkey AS k, count(*) AS customers FROM customer WHERE c_acctbal > 9000 GROUP BY 1) a
    FULL JOIN (SELECT s_nationkey AS k, count(*) AS suppliers FROM supplier WHERE s_acctbal > 5000 GROUP BY 1) b ON a.k = b.k""")
def full_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = load(spark, sf_dir, "customer").filter("c_acctbal > 9000").groupBy(F.col("c_nationkey").alias("nationkey")).agg(F.count(F.lit(1)).alias("customers"))
    b = load(spark, sf_dir, "supplier").filter("s_acctbal > 5000").groupBy(F.col("s_nationkey").alias("nationkey")).agg(F.count(F.lit(1)).alias("suppliers"))
    return a.join(b, "nationkey", "full")


@query("""
    SELECT o_orderpriority, count(*) AS n, CAST(count(*) FILTER (o_orderdate >= last - INTERVAL 365 DAY) AS BIGINT) AS recent
    FROM orders, (SELECT max(o_orderdate) AS last FROM orders) GROUP BY 1""")
def cross_one_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select("o_orderpriority", "o_orderdate")
    last = orders.agg(F.max("o_orderdate").alias("last"))  # one row
    recent = F.col("o_orderdate") >= F.col("last") - F.expr("INTERVAL '365' DAY")
    return orders.crossJoin(F.broadcast(last)).groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(recent, 1)).alias("recent"))


@query("""
    SELECT r_name, n_name, count(DISTINCT c_custkey) AS customers, count(*) AS orders, round(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE), 2) AS total
    FROM region JOIN nation ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2""")
def inner_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    region, nation, customer, orders = (load(spark, sf_dir, t) for t in ("region", "nation", "customer", "orders"))
    joined = orders.join(customer, orders["o_custkey"] == customer["c_custkey"]).join(nation, F.col("c_nationkey") == nation["n_nationkey"]).join(region, F.col("n_regionkey") == region["r_regionkey"])
    return joined.groupBy("r_name", "n_name").agg(
        F.countDistinct("c_custkey").alias("customers"), F.count(F.lit(1)).alias("orders"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total")
    )


@query("""
    SELECT 'with_null' AS list, count(*) AS n FROM customer WHERE c_nationkey NOT IN (SELECT CASE WHEN s_nationkey % 5 = 0 THEN NULL ELSE s_nationkey END FROM supplier)
    UNION ALL SELECT 'without_null', count(*) FROM customer WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_nationkey % 5 <> 0)""")
def not_in_null_aware(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, supplier = load(spark, sf_dir, "customer"), load(spark, sf_dir, "supplier")
    return spark.sql(
        """SELECT 'with_null' AS list, count(*) AS n FROM {c} WHERE c_nationkey NOT IN (SELECT CASE WHEN s_nationkey % 5 = 0 THEN NULL ELSE s_nationkey END FROM {s})
        UNION ALL SELECT 'without_null', count(*) FROM {c} WHERE c_nationkey NOT IN (SELECT s_nationkey FROM {s} WHERE s_nationkey % 5 <> 0)""",
        c=customer,
        s=supplier,
    )


@query("""
    SELECT c_custkey, CASE WHEN EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P') THEN 'pending'
        WHEN EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) THEN 'done' ELSE 'none' END AS state FROM customer""")
def exists_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = load(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.bool_or(F.col("o_orderstatus") == "P").alias("pending"))
    joined = load(spark, sf_dir, "customer").select("c_custkey").join(facts, "c_custkey", "left")
    return joined.select("c_custkey", F.when(F.col("pending"), "pending").when(F.col("pending").isNotNull(), "done").otherwise("none").alias("state"))


@query("""
    SELECT o_orderkey, CAST(rn AS INTEGER) AS position, l_partkey, l_quantity FROM (
        SELECT l_orderkey AS o_orderkey, l_partkey, l_quantity, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS rn FROM lineitem)""")
def json_unnest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity").alias("line"))
    documents = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.to_json(F.struct(F.array_sort(F.collect_list("line")).alias("lines"))).alias("json"))
    parsed = documents.withColumn("doc", F.from_json("json", "lines array<struct<l_linenumber:int,l_partkey:bigint,l_suppkey:bigint,l_quantity:double>>"))
    spread = parsed.select("o_orderkey", F.posexplode("doc.lines").alias("pos", "line"))
    return spread.select("o_orderkey", (F.col("pos") + 1).alias("position"), "line.l_partkey", "line.l_quantity")


@query("SELECT event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) % 7 AS k, count(*) AS n FROM events GROUP BY 1, 2")
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events").select("event_type", (F.get_json_object("props", "$.k").try_cast("bigint") % 7).alias("k"))
    return events.groupBy("event_type", "k").agg(F.count(F.lit(1)).alias("n"))


@query("""
    SELECT l_orderkey, min(l_extendedprice) AS least, max(l_extendedprice) AS most, max(l_extendedprice) FILTER (l_returnflag = 'R') AS most_returned, count(*) AS n FROM lineitem GROUP BY 1""")
def json_array_minmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = load(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct("l_extendedprice", "l_returnflag")).alias("lines"))
    prices = F.transform("lines", lambda x: x["l_extendedprice"])
    returned = F.transform(F.filter("lines", lambda x: x["l_returnflag"] == "R"), lambda x: x["l_extendedprice"])
    return lines.select("l_orderkey", F.array_min(prices).alias("least"), F.array_max(prices).alias("most"), F.array_max(returned).alias("most_returned"), F.size("lines").cast("long").alias("n"))


@query("""
    SELECT 'customer' AS platform, 'customer:' || c_custkey AS listing_key, c_name AS name, c_nationkey AS area, round(c_acctbal, 2) AS rating, NULL::DOUBLE AS price FROM customer
    UNION ALL SELECT 'supplier', 'supplier:' || s_suppkey, s_name, s_nationkey, round(s_acctbal, 2), NULL FROM supplier
    UNION ALL SELECT 'part', 'part:' || p_partkey, p_name, NULL, NULL, p_retailprice FROM part""")
def listing_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = lambda platform, c: F.concat(F.lit(f"{platform}:"), F.col(c).cast("string")).alias("listing_key")
    c = load(spark, sf_dir, "customer").select(F.lit("customer").alias("platform"), key("customer", "c_custkey"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("area"), F.round("c_acctbal", 2).alias("rating"))
    s = load(spark, sf_dir, "supplier").select(F.lit("supplier").alias("platform"), key("supplier", "s_suppkey"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("area"), F.round("s_acctbal", 2).alias("rating"))
    p = load(spark, sf_dir, "part").select(F.lit("part").alias("platform"), key("part", "p_partkey"), F.col("p_name").alias("name"), F.col("p_retailprice").alias("price"))
    return c.unionByName(s).unionByName(p, allowMissingColumns=True)


@query("SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier UNION SELECT n_nationkey FROM nation")
def union_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [load(spark, sf_dir, t).select(F.col(c).alias("k")) for t, c in (("customer", "c_nationkey"), ("supplier", "s_nationkey"), ("nation", "n_nationkey"))]
    return parts[0].union(parts[1]).union(parts[2]).distinct()


@query("""
    SELECT 'both' AS kind, k FROM (SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'P' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')
    UNION ALL SELECT 'never', k FROM (SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderpriority = '5-LOW')""")
def intersect_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders")
    of = lambda cond: orders.filter(cond).select(F.col("o_custkey").alias("k"))
    both = of("o_orderstatus = 'P'").intersect(of("o_orderstatus = 'F'"))
    never = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")).subtract(of("o_orderpriority = '5-LOW'"))
    return both.select(F.lit("both").alias("kind"), "k").unionByName(never.select(F.lit("never").alias("kind"), "k"))


@query("""
    SELECT l_returnflag, measure, count(*) AS n, round(avg(value), 4) AS mean FROM (
        UNPIVOT (SELECT l_returnflag, l_quantity AS quantity, l_discount AS discount, l_tax AS tax FROM lineitem) ON quantity, discount, tax INTO NAME measure VALUE value) GROUP BY 1, 2""")
def unpivot_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = load(spark, sf_dir, "lineitem").select("l_returnflag", F.col("l_quantity").alias("quantity"), F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"))
    return wide.unpivot("l_returnflag", ["quantity", "discount", "tax"], "measure", "value").groupBy("l_returnflag", "measure").agg(F.count("value").alias("n"), F.round(F.avg("value"), 4).alias("mean"))


@query("""
    SELECT user_id, count(*) FILTER (event_type = 'click') AS clicks, count(*) FILTER (event_type = 'view') AS views, count(*) FILTER (event_type = 'purchase') AS purchases,
        round(max(value) FILTER (event_type = 'click'), 4) AS max_click FROM events GROUP BY 1""")
def pivot_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = ["click", "view", "purchase"]
    wide = load(spark, sf_dir, "events").groupBy("user_id").pivot("event_type", kinds).agg(F.count(F.lit(1)).alias("n"), F.round(F.max("value"), 4).alias("top"))
    return wide.select("user_id", *[F.coalesce(f"{k}_n", F.lit(0)).alias(f"{k}s") for k in kinds], F.col("click_top").alias("max_click"))


@query("""
    SELECT r_name, count(*) AS customers, round(sum(c_acctbal), 2) AS total, round(sum(c_acctbal * w) / nullif(sum(w), 0), 4) AS weighted_mean FROM (
        SELECT *, CASE c_mktsegment WHEN 'BUILDING' THEN 3 WHEN 'MACHINERY' THEN 2 ELSE 1 END AS w FROM customer)
    JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY 1""")
def weighted_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    region, nation, customer = (load(spark, sf_dir, t) for t in ("region", "nation", "customer"))
    w = F.when(F.col("c_mktsegment") == "BUILDING", 3).when(F.col("c_mktsegment") == "MACHINERY", 2).otherwise(1)
    rows = customer.withColumn("w", w).join(F.broadcast(nation), customer["c_nationkey"] == nation["n_nationkey"]).join(F.broadcast(region), nation["n_regionkey"] == region["r_regionkey"])
    return rows.groupBy("r_name").agg(
        F.count(F.lit(1)).alias("customers"), F.round(F.sum("c_acctbal"), 2).alias("total"), F.round(F.sum(F.col("c_acctbal") * F.col("w")) / F.expr("nullif(sum(w), 0)"), 4).alias("weighted_mean")
    )


@query("""
    SELECT o_custkey, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderdate, o_orderkey) AS ordered_keys,
        (SELECT string_agg(s, ',' ORDER BY s) FROM (SELECT DISTINCT unnest(list(o_orderpriority)) AS s)) AS priorities,
        (SELECT string_agg(s, ',' ORDER BY s) FROM (SELECT DISTINCT unnest(flatten(list([o_orderstatus, o_orderpriority]))) AS s)) AS tags
    FROM orders GROUP BY 1""")
def array_aggs(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = F.collect_list(F.struct("o_orderdate", "o_orderkey"))
    return load(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.array_join(F.transform(F.array_sort(keyed), lambda x: x["o_orderkey"].cast("string")), ",").alias("ordered_keys"),
        F.array_join(F.array_sort(F.collect_set("o_orderpriority")), ",").alias("priorities"),
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.array("o_orderstatus", "o_orderpriority"))))), ",").alias("tags"),
    )


@query("""
    SELECT o_custkey, bool_or(o_orderpriority = '1-URGENT') AS any_urgent, bool_and(o_totalprice > 1000) AS all_large, round(avg(CAST(o_orderstatus = 'F' AS INTEGER)), 6) AS finished FROM orders GROUP BY 1""")
def bool_aggs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.bool_or(F.col("o_orderpriority") == "1-URGENT").alias("any_urgent"), F.bool_and(F.col("o_totalprice") > 1000).alias("all_large"), F.round(F.avg((F.col("o_orderstatus") == "F").cast("int")), 6).alias("finished")
    )


@query("""
    SELECT DISTINCT ON (o_custkey) o_custkey, o_orderpriority AS usual, n FROM (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2) ORDER BY o_custkey, n DESC, o_orderpriority""")
def mode_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most frequent value, ties to the smallest; Spark's own mode leaves ties open."""
    counts = load(spark, sf_dir, "orders").groupBy("o_custkey", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return windows.latest_by(counts, ["o_custkey"], [F.desc("n"), F.asc("o_orderpriority")]).select("o_custkey", F.col("o_orderpriority").alias("usual"), "n")


@query("SELECT event_type, user_id, count(*) AS n, round(avg(value), 8) AS mean, round(stddev_samp(value) / sqrt(count(*)), 8) AS stderr FROM events GROUP BY 1, 2")
def stderr_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.count(F.lit(1))
    return load(spark, sf_dir, "events").groupBy("event_type", "user_id").agg(n.alias("n"), F.round(F.avg("value"), 8).alias("mean"), F.round(F.stddev_samp("value") / F.sqrt(n), 8).alias("stderr"))


@query("""
    SELECT o_orderpriority, count(DISTINCT o_custkey) AS customers, count(DISTINCT o_custkey) FILTER (o_orderstatus = 'F') AS finished, count(DISTINCT CAST(o_orderdate AS DATE)) AS days FROM orders GROUP BY 1""")
def distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(
        F.countDistinct("o_custkey").alias("customers"), F.countDistinct(F.when(F.col("o_orderstatus") == "F", F.col("o_custkey"))).alias("finished"), F.countDistinct(F.col("o_orderdate").cast("date")).alias("days")
    )


@query("""
    WITH r AS (SELECT l_partkey, l_suppkey, row_number() OVER (PARTITION BY l_partkey ORDER BY l_extendedprice / l_quantity, l_orderkey, l_linenumber, l_suppkey) - 1 AS rank FROM lineitem)
    SELECT l_partkey, l_suppkey, count(*) AS n, round(sum(1.0::DOUBLE / (rank + 1)), 6) AS weight, round(sum(1.0::DOUBLE / (rank + 1)) / sum(sum(1.0::DOUBLE / (rank + 1))) OVER (PARTITION BY l_partkey), 6) AS share FROM r GROUP BY 1, 2""")
def share_of_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("l_partkey").orderBy(F.col("l_extendedprice") / F.col("l_quantity"), "l_orderkey", "l_linenumber", "l_suppkey")
    ranked = load(spark, sf_dir, "lineitem").withColumn("rank", F.row_number().over(w) - 1)
    out = windows.share_of(ranked, ["l_suppkey"], ["l_partkey"], F.lit(1.0) / (F.col("rank") + 1))
    return out.select("l_partkey", "l_suppkey", "n", F.round("weight", 6).alias("weight"), F.round("share", 6).alias("share"))


@query("SELECT * FROM (SELECT o_custkey, o_orderkey, o_totalprice, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS rank FROM orders) WHERE rank <= 3")
def top_k_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return windows.top_k_by(orders, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3)


@query("SELECT o_orderkey, o_totalprice, o_orderstatus = 'P' AS pending FROM orders ORDER BY o_orderstatus = 'P' DESC, o_totalprice DESC NULLS LAST, o_orderkey LIMIT 25")
def global_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", (F.col("o_orderstatus") == "P").alias("pending"))
    return orders.orderBy(F.desc("pending"), F.desc_nulls_last("o_totalprice"), "o_orderkey").limit(25)


@query("SELECT o_orderkey FROM orders ORDER BY md5('7|' || o_orderkey), o_orderkey LIMIT 100")
def hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select("o_orderkey")
    return orders.orderBy(F.md5(F.concat(F.lit("7|"), F.col("o_orderkey").cast("string"))), "o_orderkey").limit(100)

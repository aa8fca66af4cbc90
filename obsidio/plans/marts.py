"""Decision-shaped queries built from the others' operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions import calendar
from ..operators import quality
from ..session import load
from .registry import query


@query("""
    SELECT 'order_key_unique' AS check, (SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)) AS failures
    UNION ALL SELECT 'line_key_unique', (SELECT count(*) FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1))
    UNION ALL SELECT 'customer_known', (SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer))
    UNION ALL SELECT 'balance_range', (SELECT count(*) FROM customer WHERE c_acctbal NOT BETWEEN 0 AND 9000)
    UNION ALL SELECT 'status_accepted', (SELECT count(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O'))
    UNION ALL SELECT 'name_not_null', (SELECT count(*) FROM customer WHERE c_name IS NULL)
    UNION ALL SELECT 'enough_regions', (SELECT count(*) FROM (SELECT count(*) AS n FROM region) WHERE n < 6)""")
def expectations(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lines, customer, region = (load(spark, sf_dir, t) for t in ("orders", "lineitem", "customer", "region"))
    return quality.failures({
        "order_key_unique": quality.unique(orders, ["o_orderkey"]),
        "line_key_unique": quality.unique(lines, ["l_orderkey", "l_linenumber"]),
        "customer_known": quality.related(orders, "o_custkey", customer, "c_custkey"),
        "balance_range": quality.between(customer, "c_acctbal", 0, 9000),
        "status_accepted": quality.accepted(orders, "o_orderstatus", ["F", "O"]),
        "name_not_null": quality.not_null(customer, "c_name"),
        "enough_regions": quality.min_rows(region, 6),
    })


@query("""
    SELECT event_type, rows, round(bad_share, 6) AS bad_share, volume, volume_before, round(stale, 4) AS stale_hours,
        array_to_string(list_filter([CASE WHEN bad_share > 0.2 THEN 'status' END, CASE WHEN volume / nullif(volume_before, 0) - 1 < -0.3 THEN 'volume' END, CASE WHEN stale > 336 THEN 'freshness' END], lambda x: x IS NOT NULL), ',') AS broken
    FROM (SELECT event_type, count(*) AS rows, avg(CAST(value > 60 AS INTEGER)) AS bad_share, count(*) FILTER (ts >= TIMESTAMP '2024-01-20') AS volume,
        count(*) FILTER (ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20') AS volume_before, (epoch_us(TIMESTAMP '2024-02-10') - epoch_us(max(ts))) / 3.6e9 AS stale FROM events GROUP BY 1)""")
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = lambda s: F.lit(s).cast("timestamp_ntz")
    out = quality.report(load(spark, sf_dir, "events"), "event_type", "ts", F.col("value") > 60, at("2024-02-10"), at("2024-01-10"), at("2024-01-20"))
    return out.select("event_type", "rows", F.round("bad_share", 6).alias("bad_share"), "volume", "volume_before", F.round("stale_hours", 4).alias("stale_hours"), "broken")


def tenant_rows(df: DataFrame, column: str, tenant: str | None) -> DataFrame:
    """The rows of one tenant; none where no tenant is set."""
    return df.filter(F.col(column) == F.lit(tenant)) if tenant else df.filter(F.lit(False))


@query("SELECT c_mktsegment, count(*) AS n, round(sum(c_acctbal), 2) AS total FROM customer WHERE c_mktsegment = 'BUILDING' GROUP BY 1")
def tenant_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = load(spark, sf_dir, "customer")
    seen = tenant_rows(customers, "c_mktsegment", "BUILDING").unionByName(tenant_rows(customers, "c_mktsegment", None))
    return seen.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("c_acctbal"), 2).alias("total"))


@query("""
    SELECT kind, CAST(isodow(l) AS INTEGER) AS dow, CAST(hour(l) AS INTEGER) AS hour, count(*) AS n FROM (
        SELECT 'event' AS kind, (ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Berlin' AS l FROM events
        UNION ALL SELECT 'order', ((o_orderdate + INTERVAL (o_orderkey % 24) HOUR) AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Berlin' FROM orders) GROUP BY ALL""")
def local_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events").select(F.lit("event").alias("kind"), F.col("ts").alias("t"))
    orders = load(spark, sf_dir, "orders").select(F.lit("order").alias("kind"), F.expr("o_orderdate + make_dt_interval(0, cast(o_orderkey % 24 as int))").alias("t"))
    local = F.convert_timezone(F.lit("UTC"), F.lit("Europe/Berlin"), F.col("t"))
    rows = events.unionByName(orders).withColumn("l", local)
    return rows.groupBy("kind", (F.weekday("l") + 1).alias("dow"), F.hour("l").alias("hour")).agg(F.count(F.lit(1)).alias("n"))


@query("""
    SELECT n_nationkey, n_name, customers, buying, suppliers, round(demand, 2) AS demand, round(customers / nullif(suppliers, 0), 6) AS per_supplier FROM nation
    LEFT JOIN (SELECT c_nationkey, count(*) AS customers, count(DISTINCT o_custkey) AS buying, sum(total) AS demand FROM customer LEFT JOIN (SELECT o_custkey, sum(o_totalprice) AS total FROM orders GROUP BY 1) ON o_custkey = c_custkey GROUP BY 1) ON c_nationkey = n_nationkey
    LEFT JOIN (SELECT s_nationkey, count(*) AS suppliers FROM supplier GROUP BY 1) ON s_nationkey = n_nationkey""")
def area_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, customer, supplier, orders = (load(spark, sf_dir, t) for t in ("nation", "customer", "supplier", "orders"))
    totals = orders.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("total"))
    demand = customer.join(totals, customer["c_custkey"] == totals["o_custkey"], "left").groupBy(F.col("c_nationkey").alias("n_nationkey"))
    demand = demand.agg(F.count(F.lit(1)).alias("customers"), F.countDistinct("o_custkey").alias("buying"), F.sum("total").alias("demand"))
    supply = supplier.groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("suppliers"))
    out = nation.select("n_nationkey", "n_name").join(demand, "n_nationkey", "left").join(supply, "n_nationkey", "left")
    return out.select("n_nationkey", "n_name", "customers", "buying", "suppliers", F.round("demand", 2).alias("demand"), F.round(F.col("customers") / F.expr("nullif(suppliers, 0)"), 6).alias("per_supplier"))


@query("""
    WITH m AS (SELECT o_custkey, percentile_cont(0.5) WITHIN GROUP (ORDER BY o_totalprice) AS med FROM orders GROUP BY 1), l AS (SELECT o_orderpriority, o_orderstatus, CAST(month(o_orderdate) AS VARCHAR) AS month, ln((o_totalprice + 1) / (med + 1)) AS lift FROM orders JOIN m USING (o_custkey))
    SELECT feature, value, count(*) AS n, round(percentile_cont(0.5) WITHIN GROUP (ORDER BY lift), 6) AS median_lift, round(stddev_samp(lift) / sqrt(count(*)), 6) AS stderr
    FROM (UNPIVOT l ON o_orderpriority, o_orderstatus, month INTO NAME feature VALUE value) GROUP BY 1, 2 HAVING count(*) >= 30""")
def feature_lift(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority", "o_orderstatus", "o_totalprice", F.month("o_orderdate").cast("string").alias("month"))
    medians = orders.groupBy("o_custkey").agg(F.expr("percentile_cont(0.5) WITHIN GROUP (ORDER BY o_totalprice)").alias("med"))
    lifted = orders.join(medians, "o_custkey").withColumn("lift", F.log((F.col("o_totalprice") + 1) / (F.col("med") + 1)))
    long = lifted.unpivot("lift", ["o_orderpriority", "o_orderstatus", "month"], "feature", "value")
    n = F.count(F.lit(1))
    out = long.groupBy("feature", "value").agg(n.alias("n"), F.round(F.expr("percentile_cont(0.5) WITHIN GROUP (ORDER BY lift)"), 6).alias("median_lift"), F.round(F.stddev_samp("lift") / F.sqrt(n), 6).alias("stderr"))
    return out.filter("n >= 30")


@query("""
    SELECT status, c_mktsegment, count(*) AS n FROM (SELECT c_mktsegment, CASE WHEN base IS NULL AND later IS NULL THEN 'never' WHEN base IS NULL THEN 'new' WHEN later IS NULL THEN 'gone' WHEN later > 2 * base THEN 'grown' ELSE 'survived' END AS status
        FROM customer LEFT JOIN (SELECT o_custkey, nullif(count(*) FILTER (o_orderdate < TIMESTAMP '1996-01-01'), 0) AS base, nullif(count(*) FILTER (o_orderdate >= TIMESTAMP '2000-01-01'), 0) AS later FROM orders GROUP BY 1) ON o_custkey = c_custkey) GROUP BY 1, 2""")
def survival_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = lambda s: F.lit(s).cast("timestamp_ntz")
    seen = load(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.when(F.col("o_orderdate") < at("1996-01-01"), 1)).alias("base"), F.count(F.when(F.col("o_orderdate") >= at("2000-01-01"), 1)).alias("later")
    )
    rows = load(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment").join(seen, "c_custkey", "left").fillna(0, ["base", "later"])
    status = F.when((F.col("base") == 0) & (F.col("later") == 0), "never").when(F.col("base") == 0, "new").when(F.col("later") == 0, "gone").when(F.col("later") > 2 * F.col("base"), "grown").otherwise("survived")
    return rows.groupBy(status.alias("status"), "c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


RULES = [
    calendar.Rule("new year", "fixed", (1, 1)), calendar.Rule("mothers day", "weekday", (5, 6, 2)), calendar.Rule("last friday of november", "weekday", (11, 4, -1)), calendar.Rule("easter", "easter", (0,)),
    calendar.Rule("ascension", "easter", (39,)), calendar.Rule("payday", "month_end"), calendar.Rule("first advent", "advent", (1,)), calendar.Rule("ramadan", "hijri", (9, 1)), calendar.Rule("nowruz", "persian", (1, 1)), calendar.Rule("yalda", "persian", (9, 30)),
]


@query("""
    SELECT occasion, strftime(day, '%Y-%m-%d') AS day, count(o_orderkey) AS orders FROM (
        SELECT 'new year' AS occasion, make_date(y, 1, 1) AS day FROM (SELECT CAST(unnest(range(1996, 2001)) AS INTEGER) AS y)
        UNION ALL SELECT 'payday', last_day(make_date(y, m, 1)) FROM (SELECT CAST(unnest(range(1996, 2001)) AS INTEGER) AS y), (SELECT CAST(unnest(range(1, 13)) AS INTEGER) AS m)
        UNION ALL SELECT 'mothers day', make_date(y, 5, 1) + CAST((7 - isodow(make_date(y, 5, 1))) % 7 + 7 AS INTEGER) FROM (SELECT CAST(unnest(range(1996, 2001)) AS INTEGER) AS y))
    LEFT JOIN orders ON CAST(o_orderdate AS DATE) = day GROUP BY 1, 2""")
def calendar_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders on the days of three kinds of rules; tests hold the other kinds against known dates."""
    days = calendar.calendar(spark, RULES, 1996, 2000).filter(F.col("occasion").isin("new year", "payday", "mothers day"))
    orders = load(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    return days.join(orders, "day", "left").groupBy("occasion", F.date_format("day", "yyyy-MM-dd").alias("day")).agg(F.count("o_orderkey").alias("orders"))


@query("""
    SELECT o_custkey, priorities, n FROM (SELECT o_custkey, string_agg(o_orderpriority, ' > ' ORDER BY n DESC, o_orderpriority) AS priorities, CAST(sum(n) AS BIGINT) AS n FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, o_orderpriority) AS r FROM (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2)) WHERE r <= 3 GROUP BY 1)""")
def top_three_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = load(spark, sf_dir, "orders").groupBy("o_custkey", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("o_custkey").orderBy(F.desc("n"), "o_orderpriority")
    top = counts.withColumn("r", F.row_number().over(w)).filter("r <= 3").groupBy("o_custkey")
    names = F.transform(F.array_sort(F.collect_list(F.struct("r", "o_orderpriority"))), lambda x: x["o_orderpriority"])
    return top.agg(F.array_join(names, " > ").alias("priorities"), F.sum("n").alias("n"))

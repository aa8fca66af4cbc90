"""Queries over ordered histories: current rows, versions, peers, momentum and as-of features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..operators import joins, windows
from ..session import load
from .registry import query

STAMP = "yyyy-MM-dd HH:mm:ss"


def stamp(c: str):
    """Time as text; years of five digits carry no sign."""
    return F.ltrim(F.date_format(c, STAMP), F.lit("+"))


@query("""
    WITH peer AS (SELECT o_custkey, count(*) AS peer_n, percentile_cont(0.5) WITHIN GROUP (ORDER BY o_totalprice) AS med FROM orders GROUP BY 1)
    SELECT o_orderkey, o_custkey, peer_n, round(med, 4) AS peer_median,
        round(percent_rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice), 6) AS pct_in_peer,
        round(ln((o_totalprice + 1) / (med + 1)), 6) AS ln_lift,
        peer_n >= 10 AND percent_rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice) >= 0.9 AS is_viral
    FROM orders JOIN peer USING (o_custkey)""")
def peer_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    out = windows.peer_performance(orders, ["o_custkey"], "o_totalprice")
    return out.select(
        "o_orderkey", "o_custkey", "peer_n", F.round("peer_median", 4).alias("peer_median"), F.round("pct_in_peer", 6).alias("pct_in_peer"),
        F.round("ln_lift", 6).alias("ln_lift"), "is_viral",
    )


@query("""
    SELECT DISTINCT ON (o_custkey) o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS ordered_at, o_totalprice
    FROM orders ORDER BY o_custkey, o_orderdate DESC, o_orderkey DESC""")
def latest_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    last = windows.latest_by(orders, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")])
    return last.select("o_custkey", "o_orderkey", stamp("o_orderdate").alias("ordered_at"), "o_totalprice")


@query("""
    SELECT user_id, round(arg_max(value, (ts, event_id)) FILTER (event_type = 'click'), 6) AS last_click,
        round(arg_max(value, (ts, event_id)) FILTER (event_type = 'view'), 6) AS last_view,
        round(arg_max(value, (ts, event_id)) FILTER (event_type = 'purchase'), 6) AS last_purchase, arg_max(event_type, (ts, event_id)) AS last_type
    FROM events GROUP BY user_id""")
def latest_non_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events")
    kinds = ("click", "view", "purchase")
    wide = events.select("user_id", "ts", "event_id", F.col("event_type").alias("last_type"), *[F.when(F.col("event_type") == k, F.round("value", 6)).alias(f"last_{k}") for k in kinds])
    return windows.latest_non_null(wide, ["user_id"], ["ts", "event_id"], [*[f"last_{k}" for k in kinds], "last_type"])


_SCD2 = """
    WITH s AS (SELECT *, CAST(o_orderstatus IS DISTINCT FROM lag(o_orderstatus) OVER w OR lag(o_orderkey) OVER w IS NULL AS INTEGER) AS step FROM orders
               WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
    v AS (SELECT *, sum(step) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS version FROM s),
    g AS (SELECT o_custkey, CAST(version AS BIGINT) AS version, min(o_orderdate) AS valid_from, count(*) AS observations, any_value(o_orderstatus) AS o_orderstatus FROM v GROUP BY 1, 2)"""


@query(_SCD2 + """
    SELECT o_custkey, version, o_orderstatus, observations, strftime(valid_from, '%Y-%m-%d %H:%M:%S') AS valid_from,
        strftime(lead(valid_from) OVER w, '%Y-%m-%d %H:%M:%S') AS valid_to, lead(valid_from) OVER w IS NULL AS is_current
    FROM g WINDOW w AS (PARTITION BY o_custkey ORDER BY version)""")
def scd2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus")
    out = windows.scd2(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderstatus"])
    return out.select("o_custkey", "version", "o_orderstatus", "observations", stamp("valid_from").alias("valid_from"), stamp("valid_to").alias("valid_to"), "is_current")


@query("""
    SELECT user_id, event_id, event_type FROM events
    QUALIFY event_type IS DISTINCT FROM lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id)""")
def snapshot_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts")
    return windows.changes(events, ["user_id"], ["ts", "event_id"], ["event_type"]).select("user_id", "event_id", "event_type")


@query("""
    SELECT user_id, count(*) AS versions, count(DISTINCT event_type) AS kinds FROM (
        SELECT * FROM events QUALIFY (event_type, value > 50) IS DISTINCT FROM lag((event_type, value > 50)) OVER (PARTITION BY user_id ORDER BY ts, event_id)) GROUP BY user_id""")
def version_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts", (F.col("value") > 50).alias("high"))
    return windows.changes(events, ["user_id"], ["ts", "event_id"], ["event_type", "high"]).groupBy("user_id").agg(F.count(F.lit(1)).alias("versions"), F.countDistinct("event_type").alias("kinds"))


@query("""
    SELECT o_orderkey, prior_n, round(prior_mean, 6) AS prior_mean, round(gap, 4) AS gap_hours, CASE WHEN prior_n >= 5 THEN round(v - prior_mean, 6) END AS lift FROM (
        SELECT o_orderkey, ln(o_totalprice + 1) AS v, count(*) OVER p AS prior_n, avg(ln(o_totalprice + 1)) OVER p AS prior_mean,
            (epoch_us(o_orderdate) - epoch_us(lag(o_orderdate) OVER w)) / 3.6e9 AS gap
        FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey),
            p AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))""")
def strict_prior_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    out = windows.strict_prior(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], F.log(F.col("o_totalprice") + 1), "o_orderdate")
    return out.select("o_orderkey", "prior_n", F.round("prior_mean", 6).alias("prior_mean"), F.round("gap_hours", 4).alias("gap_hours"), F.round("lift", 6).alias("lift"))


@query("""
    WITH w AS (SELECT o_orderpriority, CAST(date_trunc('week', o_orderdate) AS DATE) AS week, count(*) AS n FROM orders GROUP BY 1, 2)
    SELECT o_orderpriority, strftime(week, '%Y-%m-%d') AS week, n, CAST(last4 AS BIGINT) AS last4, CAST(prior12 AS BIGINT) AS prior12,
        round((coalesce(last4, 0) / 4.0 + 1) / (coalesce(prior12, 0) / 12.0 + 1), 6) AS growth_4w
    FROM (SELECT *, sum(n) OVER (PARTITION BY o_orderpriority ORDER BY week RANGE BETWEEN INTERVAL 21 DAY PRECEDING AND CURRENT ROW) AS last4,
        sum(n) OVER (PARTITION BY o_orderpriority ORDER BY week RANGE BETWEEN INTERVAL 105 DAY PRECEDING AND INTERVAL 28 DAY PRECEDING) AS prior12 FROM w)""")
def topic_momentum(spark: SparkSession, sf_dir: str) -> DataFrame:
    weekly = load(spark, sf_dir, "orders").groupBy("o_orderpriority", F.date_trunc("week", "o_orderdate").cast("date").alias("week")).agg(F.count(F.lit(1)).alias("n"))
    out = windows.momentum(weekly, "o_orderpriority")
    return out.select("o_orderpriority", F.date_format("week", "yyyy-MM-dd").alias("week"), "n", "last4", "prior12", F.round("growth_4w", 6).alias("growth_4w"))


@query("""
    WITH m AS (SELECT o_orderpriority, strftime(date_trunc('month', o_orderdate), '%Y-%m') AS month, count(*) AS n FROM orders GROUP BY 1, 2)
    SELECT *, lag(n, 12) OVER w AS n_before, round(n / nullif(lag(n, 12) OVER w, 0) - 1, 6) AS yoy FROM m WINDOW w AS (PARTITION BY o_orderpriority ORDER BY month)""")
def yoy_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    monthly = load(spark, sf_dir, "orders").groupBy("o_orderpriority", F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("n"))
    before = F.lag("n", 12).over(Window.partitionBy("o_orderpriority").orderBy("month"))
    return monthly.withColumn("n_before", before).withColumn("yoy", F.round(F.col("n") / F.expr("nullif(n_before, 0)") - 1, 6))


@query("""
    SELECT event_type, CAST(isodow(ts) AS INTEGER) AS dow, CAST(hour(ts) AS INTEGER) AS hour, count(*) AS n, count(DISTINCT user_id) AS users,
        round(percentile_cont(0.5) WITHIN GROUP (ORDER BY value), 4) AS median_value, round(avg(CAST(value > 50 AS INTEGER)), 6) AS high_share,
        CAST(GROUPING(event_type) AS INTEGER) AS all_types
    FROM events GROUP BY GROUPING SETS ((event_type, isodow(ts), hour(ts)), (isodow(ts), hour(ts))) HAVING count(*) >= 5""")
def posting_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events").select("event_type", "user_id", "value", F.expr("weekday(ts) + 1").alias("dow"), F.hour("ts").alias("hour"))
    return spark.sql(
        """SELECT event_type, dow, hour, count(*) AS n, count(DISTINCT user_id) AS users, round(percentile_cont(0.5) WITHIN GROUP (ORDER BY value), 4) AS median_value,
            round(avg(CAST(value > 50 AS INT)), 6) AS high_share, CAST(grouping(event_type) AS INT) AS all_types
        FROM {e} GROUP BY GROUPING SETS ((event_type, dow, hour), (dow, hour)) HAVING count(*) >= 5""",
        e=events,
    )


@query("""
    SELECT l_returnflag, l_linestatus, CAST(GROUPING(l_returnflag, l_linestatus) AS BIGINT) AS level, count(*) AS n, round(sum(CAST(l_quantity AS DECIMAL(18,2))), 2)::DOUBLE AS quantity
    FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)""")
def cube_rollup_bonus(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = load(spark, sf_dir, "lineitem")
    return items.cube("l_returnflag", "l_linestatus").agg(
        F.grouping_id().alias("level"), F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("quantity")
    )


_UNIT = "floor(l_extendedprice / l_quantity * 100) / 100"


@query(f"""
    WITH p AS (SELECT l_partkey, {_UNIT} AS price FROM lineitem WHERE l_quantity > 0),
    m AS (SELECT l_partkey, count(*) AS n, percentile_cont([0.25, 0.5, 0.75]) WITHIN GROUP (ORDER BY price) AS q FROM p GROUP BY 1)
    SELECT l_partkey, n, round(q[1], 4) AS p25, round(q[2], 4) AS median, round(q[3], 4) AS p75, round(q[2] / (SELECT percentile_cont(0.5) WITHIN GROUP (ORDER BY price) FROM p), 6) AS price_index FROM m""")
def price_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = load(spark, sf_dir, "lineitem").filter("l_quantity > 0").select("l_partkey", F.expr(_UNIT).alias("price"))
    return spark.sql(
        """SELECT l_partkey, n, round(q[0], 4) AS p25, round(q[1], 4) AS median, round(q[2], 4) AS p75, round(q[1] / market, 6) AS price_index FROM (
            SELECT l_partkey, count(*) AS n, percentile(price, array(0.25, 0.5, 0.75)) AS q FROM {p} GROUP BY l_partkey)
        CROSS JOIN (SELECT percentile(price, 0.5) AS market FROM {p})""",
        p=prices,
    )


@query(f"""
    WITH p AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, {_UNIT} AS price FROM lineitem),
    m AS (SELECT l_partkey, percentile_cont(0.5) WITHIN GROUP (ORDER BY price) AS med FROM p GROUP BY 1)
    SELECT l_partkey, CASE WHEN price > 1.5 * med THEN 'far above median' WHEN price < 0.5 * med THEN 'far below median' WHEN price <= 0 THEN 'not positive' END AS reason, count(*) AS n
    FROM p JOIN m USING (l_partkey) GROUP BY 1, 2""")
def outlier_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = load(spark, sf_dir, "lineitem").select("l_partkey", F.expr(_UNIT).alias("price"))
    medians = prices.groupBy("l_partkey").agg(F.expr("percentile_cont(0.5) WITHIN GROUP (ORDER BY price)").alias("med"))
    price, med = F.col("price"), F.col("med")
    reason = F.when(price > 1.5 * med, "far above median").when(price < 0.5 * med, "far below median").when(price <= 0, "not positive")
    return prices.join(medians, "l_partkey").groupBy("l_partkey", reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query("""
    SELECT p_partkey, l_orderkey, l_linenumber, l_extendedprice FROM part p JOIN LATERAL (
        SELECT * FROM lineitem l WHERE l.l_partkey = p.p_partkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_extendedprice DESC LIMIT 1) ON true""")
def latest_price_lateral(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        """SELECT p_partkey, l_orderkey, l_linenumber, l_extendedprice FROM {part} p JOIN LATERAL (
            SELECT l_orderkey, l_linenumber, l_extendedprice FROM {lineitem} l WHERE l.l_partkey = p.p_partkey
            ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_extendedprice DESC LIMIT 1)""",
        part=load(spark, sf_dir, "part").select("p_partkey"),
        lineitem=load(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate"),
    )


@query("""
    WITH e AS (SELECT event_id, user_id AS k, ts - INTERVAL 9000 DAY + INTERVAL (user_id * 100) DAY AS t FROM events)
    SELECT event_id, k, strftime(t, '%Y-%m-%d %H:%M:%S') AS at_time, o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate
    FROM e ASOF LEFT JOIN (SELECT o_custkey, o_orderdate, arg_max(o_orderkey, o_orderkey) AS o_orderkey, arg_max(o_totalprice, o_orderkey) AS o_totalprice FROM orders GROUP BY 1, 2) o
    ON e.k = o.o_custkey AND e.t >= o.o_orderdate""")
def asof_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("k"), F.expr("ts - make_dt_interval(9000) + make_dt_interval(cast(user_id * 100 as int))").alias("at"))
    orders = load(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), "o_orderdate", "o_orderkey", "o_totalprice")
    out = joins.as_of(events, orders, ["k"], "at", "o_orderdate", ["o_orderkey", "o_totalprice"], ["o_orderkey"])
    return out.select("event_id", "k", stamp("at").alias("at_time"), "o_orderkey", "o_totalprice", stamp("o_orderdate").alias("o_orderdate"))


AS_OF = "1998-01-01"


@query(f"""
    SELECT c_custkey, c_mktsegment, coalesce(n, 0) AS n_orders, round(total, 2) AS total, urgent, last_status, days_since, n IS NULL AS orders_missing, days_since IS NULL AS recency_missing
    FROM customer LEFT JOIN (
        SELECT o_custkey, count(*) AS n, sum(o_totalprice) AS total, count(*) FILTER (o_orderpriority = '1-URGENT') AS urgent,
            arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS last_status, CAST(date_diff('day', CAST(max(o_orderdate) AS DATE), DATE '{AS_OF}') AS INTEGER) AS days_since
        FROM orders WHERE o_orderdate <= TIMESTAMP '{AS_OF}' GROUP BY 1) ON o_custkey = c_custkey""")
def asof_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_features(load(spark, sf_dir, "customer"), load(spark, sf_dir, "orders"), AS_OF)


def customer_features(customers: DataFrame, orders: DataFrame, as_of: str) -> DataFrame:
    """Features from orders up to ``as_of`` alone, with a flag where nothing was seen."""
    seen = orders.filter(F.col("o_orderdate") <= F.lit(as_of).cast("timestamp_ntz"))
    facts = seen.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum("o_totalprice"), 2).alias("total"),
        F.count(F.when(F.col("o_orderpriority") == "1-URGENT", 1)).alias("urgent"),
        F.max_by("o_orderstatus", F.struct("o_orderdate", "o_orderkey")).alias("last_status"),
        F.datediff(F.lit(as_of).cast("date"), F.max("o_orderdate").cast("date")).alias("days_since"),
    )
    out = customers.join(facts, customers["c_custkey"] == facts["o_custkey"], "left")
    return out.select(
        "c_custkey", "c_mktsegment", F.coalesce("n", F.lit(0)).alias("n_orders"), "total", "urgent", "last_status", "days_since",
        F.col("n").isNull().alias("orders_missing"), F.col("days_since").isNull().alias("recency_missing"),
    )


@query("""
    SELECT a.o_orderkey, count(*) AS following, CAST(min(date_diff('day', CAST(a.o_orderdate AS DATE), CAST(b.o_orderdate AS DATE))) AS INTEGER) AS nearest_days
    FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND a.o_orderkey <> b.o_orderkey
        AND CAST(b.o_orderdate AS DATE) BETWEEN CAST(a.o_orderdate AS DATE) AND CAST(a.o_orderdate AS DATE) + 30 GROUP BY 1""")
def date_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    other = orders.select("o_custkey", F.col("o_orderkey").alias("other_key"), F.col("day").alias("other_day"))
    near = joins.window_join(orders, other, ["o_custkey"], "day", "other_day", 30).filter("o_orderkey <> other_key")
    return near.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("following"), F.min(F.datediff("other_day", "day")).alias("nearest_days"))


@query("""
    SELECT strftime(day, '%Y-%m-%d') AS day, count(*) AS n_open FROM (
        SELECT unnest(generate_series(CAST(o_orderdate AS DATE), CAST(o_orderdate AS DATE) + CAST(o_custkey % 14 AS INTEGER), INTERVAL 1 DAY)) AS day FROM orders) GROUP BY 1""")
def expand_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.col("o_orderdate").cast("date")
    days = load(spark, sf_dir, "orders").select(F.explode(F.sequence(start, F.date_add(start, (F.col("o_custkey") % 14).cast("int")))).alias("day"))
    return days.groupBy(F.date_format("day", "yyyy-MM-dd").alias("day")).agg(F.count(F.lit(1)).alias("n_open"))

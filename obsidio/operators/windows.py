"""Operators over ordered histories: current state, versions, snapshots, peers and momentum.

All take explicit sort columns and expect them to be unique within a key, so that no result depends on the order of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in ``order``. The rank filter becomes a group limit, applied before the shuffle too."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def latest_non_null(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """For each key and value column the last value that isn't null."""
    last = F.struct(*order)
    return df.groupBy(*keys).agg(*[F.max_by(F.col(v), F.when(F.col(v).isNotNull(), last)).alias(v) for v in values])


def top_k_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)


def attribute_hash(cols: Sequence[str], missing: str = "∅") -> Column:
    """A digest of attributes for change detection; null differs from empty."""
    return F.md5(F.concat_ws("||", *[F.coalesce(F.col(c).cast("string"), F.lit(missing)) for c in cols]))


def changes(df: DataFrame, keys: Sequence[str], order: Sequence[str], tracked: Sequence[str]) -> DataFrame:
    """Rows whose tracked attributes differ from the row before, the first row of a key included."""
    w = Window.partitionBy(*keys).orderBy(*order)
    marked = df.withColumn("_h", attribute_hash(tracked))
    before = F.lag("_h").over(w)
    return marked.withColumn("_new", ~F.col("_h").eqNullSafe(before)).filter("_new").drop("_h", "_new")


def scd2(df: DataFrame, keys: Sequence[str], order: Sequence[str], tracked: Sequence[str]) -> DataFrame:
    """Versions with validity: version, valid_from, valid_to (open for the current one), is_current, observations."""
    w = Window.partitionBy(*keys).orderBy(*order)
    marked = df.withColumn("_h", attribute_hash(tracked))
    marked = marked.withColumn("_step", (~F.col("_h").eqNullSafe(F.lag("_h").over(w))).cast("int"))
    marked = marked.withColumn("version", F.sum("_step").over(w))
    start = order[0]
    versions = marked.groupBy(*keys, "version").agg(
        F.min(start).alias("valid_from"),
        F.count(F.lit(1)).alias("observations"),
        *[F.min_by(c, F.struct(*order)).alias(c) for c in tracked],
    )
    by_version = Window.partitionBy(*keys).orderBy("version")
    nxt = F.lead("valid_from").over(by_version)
    return versions.withColumn("valid_to", nxt).withColumn("is_current", F.col("valid_to").isNull())


def strict_prior(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, at: str, least: int = 5) -> DataFrame:
    """Features from strictly earlier rows only: prior_n, prior_mean, gap_hours; lift once ``least`` rows came before."""
    w = Window.partitionBy(*keys).orderBy(*order)
    past = w.rowsBetween(Window.unboundedPreceding, -1)
    out = df.withColumn("_v", value)
    out = out.withColumn("prior_n", F.count("_v").over(past)).withColumn("prior_mean", F.avg("_v").over(past))
    before = F.lag(at).over(w)
    out = out.withColumn("gap_hours", (F.unix_micros(F.col(at).cast("timestamp")) - F.unix_micros(before.cast("timestamp"))) / 3.6e9)
    return out.withColumn("lift", F.when(F.col("prior_n") >= least, F.col("_v") - F.col("prior_mean"))).drop("_v")


def peer_performance(df: DataFrame, peer: Sequence[str], metric: str, least_viral: int = 10, viral: float = 0.9) -> DataFrame:
    """Each row among its peers: peer size and median, percentile, ln-lift over the median, and a viral flag."""
    stats = df.groupBy(*peer).agg(F.count(F.lit(1)).alias("peer_n"), F.expr(f"percentile_cont(0.5) WITHIN GROUP (ORDER BY {metric})").alias("peer_median"))
    w = Window.partitionBy(*peer).orderBy(F.col(metric).asc_nulls_first())
    out = df.join(stats, list(peer)).withColumn("pct_in_peer", F.percent_rank().over(w))
    out = out.withColumn("ln_lift", F.log((F.col(metric) + 1) / (F.col("peer_median") + 1)))
    return out.withColumn("is_viral", (F.col("peer_n") >= least_viral) & (F.col("pct_in_peer") >= viral))


def momentum(weekly: DataFrame, group: str, week: str = "week", value: str = "n") -> DataFrame:
    """Growth of the last 4 weeks over the 12 before: (sum4 / 4 + 1) / (sum12 / 12 + 1). Weeks without rows count as none."""
    return weekly.sparkSession.sql(f"""
        SELECT *, (coalesce(last4, 0) / 4 + 1) / (coalesce(prior12, 0) / 12 + 1) AS growth_4w FROM (
            SELECT *, sum({value}) OVER (PARTITION BY {group} ORDER BY {week} RANGE BETWEEN INTERVAL '21' DAY PRECEDING AND CURRENT ROW) AS last4,
                sum({value}) OVER (PARTITION BY {group} ORDER BY {week} RANGE BETWEEN INTERVAL '105' DAY PRECEDING AND INTERVAL '28' DAY PRECEDING) AS prior12
            FROM {{weekly}})""", weekly=weekly)


def share_of(df: DataFrame, keys: Sequence[str], group: Sequence[str], weight: Column) -> DataFrame:
    """Summed weights by ``keys`` within ``group`` and their share of the group's weight."""
    summed = df.groupBy(*group, *keys).agg(F.sum(weight).alias("weight"), F.count(F.lit(1)).alias("n"))
    return summed.withColumn("share", F.col("weight") / F.sum("weight").over(Window.partitionBy(*group)))


def random_rows(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """A sample of ``n`` rows, the same for the same seed: the smallest hashes of the key."""
    return df.withColumn("_u", F.xxhash64(F.col(key), F.lit(seed))).orderBy("_u", key).limit(n).drop("_u")

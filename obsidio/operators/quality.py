"""Expectations, which give their failing rows, and a report on a source's health."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: Limits of the report: share of bad statuses, drop of volume, hours since the last row.
BAD_SHARE, VOLUME_DROP, STALE_HOURS = 0.2, 0.3, 336


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def unique(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def between(df: DataFrame, col: str, lo: float, hi: float) -> DataFrame:
    return df.filter(F.col(col).isNotNull() & ~F.col(col).between(lo, hi))


def accepted(df: DataFrame, col: str, values: Sequence[str]) -> DataFrame:
    return df.filter(F.col(col).isNotNull() & ~F.col(col).isin(*values))


def related(df: DataFrame, col: str, to: DataFrame, key: str) -> DataFrame:
    parents = to.select(F.col(key).alias("_parent"))
    return df.filter(F.col(col).isNotNull()).join(parents, F.col(col) == F.col("_parent"), "left_anti")


def min_rows(df: DataFrame, least: int) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") < least)


def failures(checks: dict[str, DataFrame]) -> DataFrame:
    """The number of failing rows of each check."""
    out = None
    for name, rows in checks.items():
        row = rows.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(name).alias("check"), "failures")
        out = row if out is None else out.unionByName(row)
    return out


def report(df: DataFrame, source: str, at: str, bad: Column, as_of: Column, previous_from: Column, current_from: Column) -> DataFrame:
    """Each source's bad share, volume against the period before, and hours since its last row, with the limits they break."""
    rows = df.groupBy(source).agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(bad.cast("int")).alias("bad_share"),
        F.count(F.when(F.col(at) >= current_from, 1)).alias("volume"),
        F.count(F.when((F.col(at) >= previous_from) & (F.col(at) < current_from), 1)).alias("volume_before"),
        F.max(at).alias("last"),
    )
    stale = (F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(F.col("last").cast("timestamp"))) / 3.6e9
    rows = rows.withColumn("stale_hours", stale).withColumn("volume_change", F.col("volume") / F.expr("nullif(volume_before, 0)") - 1)
    broken = F.array_compact(F.array(F.when(F.col("bad_share") > BAD_SHARE, "status"), F.when(F.col("volume_change") < -VOLUME_DROP, "volume"), F.when(F.col("stale_hours") > STALE_HOURS, "freshness")))
    return rows.withColumn("broken", F.array_join(broken, ","))

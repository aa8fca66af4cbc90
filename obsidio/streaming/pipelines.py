"""Structured Streaming pipelines: idempotent sinks, deduplication, windows and keyed state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: How late a row may come.
LATE = "2 hours"


def file_stream(spark: SparkSession, path: str, files: int | None = None) -> DataFrame:
    """A stream of Parquet files with the schema that they have now; ``files`` a micro-batch at most.

    The path may be one file: a stream takes that as a pattern only.
    """
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files:
        reader = reader.option("maxFilesPerTrigger", files)
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def event_time(df: DataFrame, at: str, late: str = LATE) -> DataFrame:
    return df.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late)


def deduplicate(df: DataFrame, keys: list[str], at: str, late: str = LATE) -> DataFrame:
    """Rows of a replayed stream once; the state holds the keys of the lateness only."""
    return event_time(df, at, late).dropDuplicatesWithinWatermark(keys)


def tumbling(df: DataFrame, at: str, size: str, by: list[str], slide: str | None = None) -> DataFrame:
    """Counts in windows of a size, sliding if ``slide`` is given."""
    window = F.window(at, size, slide) if slide else F.window(at, size)
    return event_time(df, at).groupBy(window.alias("w"), *by).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), *by, "n")


def sessions(df: DataFrame, at: str, gap: str, by: list[str]) -> DataFrame:
    return event_time(df, at).groupBy(F.session_window(at, gap).alias("w"), *by).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *by, "n")


def changes_only(df: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """Rows whose value differs from the key's row before; the last value is the state."""

    def run(k: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(parts)).sort_values(order)
        last = state.get[0] if state.exists else None
        keep = []
        for v in rows[value]:
            keep.append(v != last)
            last = v
        state.update((last,))
        yield rows[keep][[key, *order, value]]

    kinds = dict(df.dtypes)
    out = ", ".join(f"{c} {kinds[c]}" for c in (key, *order, value))
    return df.groupBy(key).applyInPandasWithState(run, out, f"last {kinds[value]}", "append", GroupStateTimeout.NoTimeout)


def run_to_table(stream: DataFrame, path: str, mode: str) -> DataFrame:
    """Run a stream over what there is, and read its result.

    Each micro-batch overwrites a folder of its own, so that a batch that runs again after a failure leaves no rows twice.
    Complete results are those of the last batch; appended ones of all.
    """
    spark = stream.sparkSession

    def sink(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/data/batch={number:09d}")

    query = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{path}/checkpoint").foreachBatch(sink).trigger(availableNow=True).start()
    query.awaitTermination()
    out = spark.read.option("basePath", f"{path}/data").parquet(f"{path}/data")
    if mode == "complete":
        out = out.filter(F.col("batch") == out.agg(F.max("batch")).first()[0])
    return out.drop("batch")

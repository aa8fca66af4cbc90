"""File readers and writers for bulk datasets and exports."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_statistics_csv(spark: SparkSession, path: str, keys: Sequence[str], suppressed: Sequence[str] = ("–", "-", "/", ".", "x")) -> DataFrame:
    """Semicolon CSV with decimal commas: ``keys`` stay text, all else becomes double; suppressed and broken values null."""
    raw = spark.read.csv(path, sep=";", header=True, mode="DROPMALFORMED")
    number = lambda c: F.when(~F.btrim(c).isin(*suppressed), F.replace(F.replace(F.btrim(c), F.lit("."), F.lit("")), F.lit(","), F.lit(".")).try_cast("double"))
    return raw.select(*[F.col(c) if c in keys else number(F.col(c)).alias(c) for c in raw.columns])


def read_text_csv(spark: SparkSession, path: str) -> DataFrame:
    """Comma CSV with a header, all text, lines of any length and quoted line ends."""
    return spark.read.csv(path, header=True, multiLine=True, escape='"', maxCharsPerColumn=-1)


def read_in_box(spark: SparkSession, path: str, box: tuple[float, float, float, float]) -> DataFrame:
    """Parquet of many schemas, rows whose nested bbox begins within (west, south, east, north); the filter reaches the scan."""
    west, south, east, north = box
    return spark.read.option("mergeSchema", True).parquet(path).filter(F.col("bbox.xmin").between(west, east) & F.col("bbox.ymin").between(south, north))


def write_sorted(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Parquet with Zstandard, ranges of the key in order of files."""
    df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("errorifexists").option("compression", "zstd").parquet(path)


def upsert(current: DataFrame, changes: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Rows of both, the newer one by ``order`` for each key, changes before current ones at a tie."""
    from pyspark.sql import Window

    both = current.withColumn("_prio", F.lit(1)).unionByName(changes.withColumn("_prio", F.lit(0)))
    w = Window.partitionBy(*keys).orderBy(F.desc_nulls_last(order), "_prio")
    return both.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn", "_prio")


def export_version(df: DataFrame, root: str, name: str, keys: Sequence[str], as_of: str, registry: DataFrame | None = None) -> dict:
    """Write the next version of a training set and return its manifest, which is also written beside it."""
    spark = df.sparkSession
    last = registry.filter(F.col("name") == name).agg(F.max("version")).first()[0] if registry is not None else None
    version = (last or 0) + 1
    path = f"{root}/{name}/v{version}"
    write_sorted(df, f"{path}/data", keys)
    back = spark.read.parquet(f"{path}/data")
    digest = back.agg(F.sum(F.xxhash64(*back.columns).cast("decimal(38,0)"))).first()[0]
    manifest = {
        "name": name, "version": version, "as_of": as_of, "rows": back.count(), "columns": back.columns, "content": str(digest),
        "schema_sha256": hashlib.sha256(back.schema.json().encode()).hexdigest(), "path": f"{path}/data",
    }
    spark.createDataFrame([(json.dumps(manifest, sort_keys=True),)], "value string").coalesce(1).write.text(f"{path}/manifest")
    return manifest


def with_split(df: DataFrame, at: str, cut: str, group: str, test_share: float = 0.2) -> DataFrame:
    """Time first, then group: rows after ``cut`` are test; of the rest whole groups, chosen by hash, are validation."""
    held = F.conv(F.substring(F.md5(F.col(group).cast("string")), 1, 8), 16, 10).cast("long") % 1000 < int(test_share * 1000)
    return df.withColumn("split", F.when(F.col(at) > F.lit(cut).cast(df.schema[at].dataType), "test").when(held, "validation").otherwise("train"))


def catalog_of(tables: dict[str, DataFrame]) -> DataFrame:
    """One row a column: table, position, column, type, and the table's rows."""
    spark = next(iter(tables.values())).sparkSession
    rows = [(t, i, c, k, df.count()) for t, df in tables.items() for i, (c, k) in enumerate(df.dtypes, 1)]
    return spark.createDataFrame(rows, "table string, position int, column string, type string, rows long")


def replace_kinds(rows: DataFrame, path: str, kind: str) -> None:
    """Write rows into a table partitioned by ``kind``; the kinds that they hold are replaced, others stay."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(kind).parquet(path)


def checksum(table: DataFrame) -> tuple[int, str]:
    """Rows of a table, and a sum of row hashes that doesn't depend on their order."""
    n, total = table.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*table.columns).cast("decimal(38,0)"))).first()
    return n, str(total)


def snapshot(tables: dict[str, DataFrame], path: str) -> DataFrame:
    """Write every table below ``path`` with a manifest: name, rows, checksum, schema."""
    spark = next(iter(tables.values())).sparkSession
    found = []
    for name, table in tables.items():
        table.write.mode("errorifexists").option("compression", "zstd").parquet(f"{path}/{name}")
        found.append((name, *checksum(spark.read.parquet(f"{path}/{name}")), table.schema.simpleString()))
    manifest = spark.createDataFrame(found, "name string, rows long, checksum string, schema string")
    manifest.coalesce(1).write.json(f"{path}/manifest")
    return manifest


def read_ranked(spark: SparkSession, path: str) -> DataFrame:
    """(origin, rank_bucket, yyyymm) of compressed lines "origin,rank" in folders by month; a heading has no rank."""
    line = spark.read.text(path)
    rank = F.substring_index("value", ",", -1).try_cast("long")
    origin = F.expr("left(value, length(value) - length(substring_index(value, ',', -1)) - 1)")
    return line.select(origin.alias("origin"), rank.alias("rank_bucket"), "yyyymm").filter("rank_bucket is not null")

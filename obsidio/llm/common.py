"""What the operators share: scratch tables, text normal forms, hashing and Arrow slices."""

from __future__ import annotations

import gc
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import scratch

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Python code holds at most this many bytes of text at a time, one longer text aside.
SLICE_BYTES = 4 << 20

#: Bits of the bitmap of ``maybe_in`` at most: what is broadcast is 32 MB at most, for any input.
FILTER_BITS = 28


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new place in the folder that ``spark.checkpoint.dir`` names."""
    return scratch(spark, tag)


def materialise(df: DataFrame, tag: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.option("compression", codec).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def numbered(docs: DataFrame, tag: str) -> DataFrame:
    """(number, row): the rows of ``docs`` as structs, so that no column of theirs can clash, each with a number of its own.
    Written, as numbers must not change."""
    return materialise(docs.select(F.monotonically_increasing_id().alias("number"), F.struct(*docs.columns).alias("row")), tag)


def without(rows: DataFrame, dropped: DataFrame, key: str) -> DataFrame:
    """The rows whose ``key`` is not in ``dropped``, a written table. Few rows but those that go are shuffled."""
    there = maybe_in(rows, dropped, key).join(dropped.select(key), key, "left_anti")
    return maybe_in(rows, dropped, key, keep=False).unionByName(there)


def release(spark: SparkSession) -> None:
    """Let go of the shuffle files of finished steps. They stay until the driver collects its garbage, which it may not do
    for long: it is asked to here."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialise`` wrote and that nothing reads any more, and the shuffles of finished steps."""
    for df in tables:
        context = df.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(df._scratch)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
    release(tables[0].sparkSession)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else. ``lower`` does just that for texts of one byte a character, and runs faster."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())
    )


def held_out(doc_id: Column) -> Column:
    """Rows that no model learns labels from: crc32 of the id as text, mod 3, is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def unit_hash(col: Column, seed: int) -> Column:
    """A value of [0, 1) that depends on ``col`` and ``seed`` alone."""
    return F.pmod(F.xxhash64(col, F.lit(seed)), F.lit(1 << 40)) / F.lit(float(1 << 40))


def maybe_in(rows: DataFrame, ids: DataFrame, key: str, keep: bool = True) -> DataFrame:
    """Rows of ``rows`` whose ``key`` may be among those of ``ids``: all that are, and few others.

    The ids are counted and hashed into a bitmap of 8 to 16 bits for each, which is broadcast if it has 2 ** FILTER_BITS
    bits at most: then no rows are shuffled. More ids are matched by a join, which moves the rows once. With ``keep`` off,
    the rows left out.
    """
    bits = max(16, (8 * ids.count()).bit_length())
    if bits > FILTER_BITS:
        ids = ids.select(F.col(key).alias("_id")).distinct()
        return rows.join(ids, rows[key].eqNullSafe(ids["_id"]), "left_semi" if keep else "left_anti")
    slot = F.pmod(F.xxhash64(key), F.lit(1 << bits))
    bitmaps = (
        ids.select(slot.alias("_slot"))
        .groupBy(F.expr("bitmap_bucket_number(_slot)").alias("_bucket"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(_slot))").alias("_bits"))
    )
    probed = rows.withColumn("_slot", slot).withColumn("_bucket", F.expr("bitmap_bucket_number(_slot)"))
    byte = "conv(hex(substring(_bits, cast(bitmap_bit_position(_slot) div 8 as int) + 1, 1)), 16, 10)"
    hit = F.expr(f"coalesce((shiftright(cast({byte} as int), cast(bitmap_bit_position(_slot) % 8 as int)) & 1) = 1, false)")
    return probed.join(F.broadcast(bitmaps), "_bucket", "left").filter(hit if keep else ~hit).select(*rows.columns)


def bounded_sample(df: DataFrame, key: Column, most: int, seed: int) -> DataFrame:
    """About ``most`` rows of ``df`` at most, chosen by the hash of ``key``; all of them where there are no more."""
    n = df.count()
    return df if n <= most else df.filter(unit_hash(key, seed) < most / n)


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches``, cut so that ``column`` holds about ``limit`` bytes in each piece."""
    import numpy as np

    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(batch.schema.get_field_index(column))
        size = np.asarray(pc.fill_null(pc.binary_length(col), 0), dtype=np.int64)
        piece = (np.cumsum(size) - size) // limit
        cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(a, b - a)

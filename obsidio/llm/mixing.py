"""Mixing sources to target weights by Pfair scheduling.

Each source's rows, in the order of a hash, form blocks of equal size. A source of weight w is owed block j in the window
of slots from floor(j / w) to ceil((j + 1) / w); in every slot the released block of the earliest deadline is served, ties
by the source's name. So after any number of slots each source is less than one block away from its share. When a source
runs out, the others share its slots by their weights from there on. Executors compute the windows from the weights
themselves, kept as integers of WEIGHT_BITS bits, and the driver serves them in stretches of slots.
"""

from __future__ import annotations

import heapq
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import materialise, numbered, scratch_path, unit_hash

BLOCK_ROWS = 64
#: Bits of the largest weight, and slots that a computed time may be off: windows are narrower by it, so none is too wide.
WEIGHT_BITS, MARGIN = 52, 1 / 128
#: Slots that the driver serves at once.
SLOTS = 1 << 18
#: Rows of a stretch of the hash order that are numbered together, and sources that are cut into stretches at most.
STRETCH, MOST_CUT = 4096, 1000
#: Bits of a number's place in its list, and rows whose positions are broadcast at most: 64 MB.
LISTED, MOST_LISTED = 8, 1 << 24
SEED = 17


def plan_of(rows: DataFrame, weights: dict[str | None, float] | None, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """The sources and their blocks' windows, as tables that executors compute.

    Sources: _name, _sid (in the order of names), _n rows, _blocks. Windows: _sid, _block, _release, _deadline, in order of
    release. In the fluid schedule every source that still has blocks is served at its weight over the weights of all that
    have. With v = blocks served / weight, the same for all of them, block k of a source ends at v = k / weight, and the
    slot of any v is (blocks of the sources that ended) + v * (weights of the others): sums along the sorted ends.
    """
    spark = rows.sparkSession
    sizes = rows.groupBy("_name").agg(F.count(F.lit(1)).alias("_n"))
    if weights:
        named = [("n" if s is None else f"={s}", float(w)) for s, w in weights.items()]
        sizes = sizes.join(F.broadcast(spark.createDataFrame(named, "_name string, _given double")), "_name", "left").withColumn("_w", F.coalesce("_given", F.lit(1.0)))
    else:
        sizes = sizes.withColumn("_w", F.sqrt("_n"))
    sizes = sizes.repartitionByRange("_name").sortWithinPartitions("_name").select("_name", F.monotonically_increasing_id().alias("_sid"), "_n", F.ceil(F.col("_n") / block_rows).alias("_blocks"), "_w")
    sizes = materialise(sizes, "mix-sizes")
    largest = sizes.agg(F.max("_w")).first()[0] or 1.0
    sized = sizes.withColumn("_w", F.greatest(F.round(F.col("_w") / largest * float(1 << WEIGHT_BITS)).cast("long"), F.lit(1)))
    total = int(sized.agg(F.sum(F.col("_w").cast("decimal(20,0)"))).first()[0] or 0)

    runs = sized.withColumn("_at", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_blocks") - 1) / STRETCH)))).repartition("_sid", "_at")
    ends = runs.withColumn("_k", F.explode(F.sequence(F.col("_at") * STRETCH + 1, F.least(F.col("_blocks"), (F.col("_at") + 1) * STRETCH))))
    last = F.col("_k") == F.col("_blocks")
    ends = ends.select(
        "_sid", "_k", (F.col("_k") / F.col("_w")).alias("_v"), F.when(last, F.col("_blocks")).otherwise(0).alias("_gone"), F.when(last, F.col("_w")).otherwise(0).cast("decimal(20,0)").alias("_less")
    )
    # sums along the ends: each range apart, then shifted by the ranges before it
    ends = materialise(ends.repartitionByRange("_v", "_sid").sortWithinPartitions("_v", "_sid").withColumn("_part", F.spark_partition_id()), "mix-ends")
    before, gone, left = [], 0, total
    for part, g, w in ends.groupBy("_part").agg(F.sum("_gone"), F.sum("_less")).orderBy("_part").collect():
        before.append((part, gone, Decimal(left)))
        gone, left = gone + g, left - int(w)
    so_far = Window.partitionBy("_part").orderBy("_v", "_sid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = ends.join(F.broadcast(spark.createDataFrame(before, "_part int, _before long, _left decimal(38,0)")), "_part")
    weight = (F.col("_left") - F.sum("_less").over(so_far)).cast("double")
    ends = ends.select("_sid", "_k", (F.col("_before") + F.sum("_gone").over(so_far) + F.col("_v") * weight).alias("_t"))
    ends = materialise(ends, "mix-fluid")
    starts = ends.select("_sid", (F.col("_k") + 1).alias("_k"), F.col("_t").alias("_from"))
    windows = ends.join(starts, ["_sid", "_k"], "left").select(
        "_sid", (F.col("_k") - 1).alias("_block"), F.floor(F.coalesce("_from", F.lit(0.0)) + MARGIN).alias("_release"), F.ceil(F.col("_t") - MARGIN).alias("_deadline")
    )
    return sizes, materialise(windows.repartitionByRange("_release", "_sid").sortWithinPartitions("_release"), "mix-windows")


def serve(release: np.ndarray, deadline: np.ndarray, sid: np.ndarray, slot: int, end: int) -> np.ndarray:
    """The slots, from ``slot`` to ``end`` - 1, of blocks released before ``end``, earliest deadline first; -1 for those that wait on."""
    order = np.lexsort((sid, deadline))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    coming = np.argsort(release, kind="stable")
    times, ranks = release[coming].tolist(), rank[coming].tolist()
    i = int(np.searchsorted(release[coming], slot, side="right"))
    ready, served = sorted(ranks[:i]), []
    for t in range(slot, end):
        while i < len(times) and times[i] <= t:
            heapq.heappush(ready, ranks[i])
            i += 1
        served.append(heapq.heappop(ready))
    out = np.full(len(order), -1, np.int64)
    out[order[served]] = np.arange(slot, end)
    return out


def slots_of(windows: DataFrame, slots: int, at_once: int = SLOTS) -> DataFrame:
    """(_sid, _block, slot) of every window, found stretch by stretch of ``at_once`` slots.

    A schedule is one after the other by nature. The driver holds the windows released in one stretch and those that wait,
    one a source at most, and writes each stretch's slots out.
    """
    spark = windows.sparkSession
    if not slots:
        return spark.createDataFrame([], "_sid long, _block long, slot long")
    path = scratch_path(spark, "mix-slots")
    waiting = [np.zeros(0, np.int64)] * 3
    for at in range(0, slots, at_once):
        end = min(slots, at + at_once)
        found = windows.filter((F.col("_release") >= at) & (F.col("_release") < end)).select("_release", "_deadline", "_sid", "_block").toArrow()
        fresh = [found.column(c).to_numpy() for c in range(4)]
        release = np.concatenate((np.full(len(waiting[0]), at), fresh[0]))
        deadline, sid, block = (np.concatenate(x) for x in zip(waiting, fresh[1:], strict=True))
        slot = serve(release, deadline, sid, at, end)
        done = slot >= 0
        spark.createDataFrame(pa.table({"_sid": sid[done], "_block": block[done], "slot": slot[done]})).write.mode("append").parquet(path)
        waiting = [x[~done] for x in (deadline, sid, block)]
    return spark.read.schema("_sid long, _block long, slot long").parquet(path)


def mix(docs: DataFrame, weights: dict[str, float] | None = None, block_rows: int = BLOCK_ROWS, source: str = "source", key: str = "doc_id", tie: str | None = None, keep: str | None = None) -> DataFrame:
    """The place of every row of ``docs`` in the mixture; no row is left out or repeated.

    ``weights`` gives each source a positive weight; sources that it doesn't name weigh 1. Without it a source weighs the
    square root of its size. A null source is a source of its own, served after equals. A source's last block may be
    shorter. Rows that repeat a key take neighbouring places, in the order of the column ``tie``, by which rows without a
    key are also placed; extra columns are ignored, and an empty table gives an empty result. There may be any number of
    sources.

    Returns the key, source, block, slot and position (slot * block_rows + place in the block; unique but for gaps); with
    ``keep`` also that column of the row that has this place.
    """
    if any(not 0 < w < float("inf") for w in (weights or {}).values()):
        raise ValueError("weights must be positive")
    name = F.when(F.col(source).isNull(), F.lit("n")).otherwise(F.concat(F.lit("="), F.col(source).cast("string")))
    more = {"_tie": tie, "_keep": keep}
    by = F.coalesce(F.col(key).cast("string"), *([F.col(tie).cast("string")] if tie else []), F.lit(""))
    rows = docs.select(F.col(key).alias("_key"), F.col(source).alias("_source"), name.alias("_name"), unit_hash(by, SEED).alias("_u"), *[F.col(c).alias(n) for n, c in more.items() if c])
    sizes, windows = plan_of(rows.select("_name"), weights, block_rows)
    slots = slots_of(windows, sizes.agg(F.sum("_blocks")).first()[0] or 0)
    # number the rows of a source: stretches of its hash order are numbered apart, then shifted by the rows before them;
    # a source that isn't among the largest has a small part of the rows, and is one stretch
    large = sizes.filter(F.col("_n") > STRETCH).orderBy(F.desc("_n"), "_sid").limit(MOST_CUT)
    cuts = F.broadcast(large.select("_name", F.ceil(F.col("_n") / STRETCH).alias("_stretches")))
    placed = rows.join(cuts, "_name", "left").withColumn("_stretch", F.floor(F.col("_u") * F.coalesce("_stretches", F.lit(1))))
    before = Window.partitionBy("_name").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("_name", "_stretch").count().select("_name", "_stretch", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    starts = materialise(starts.join(sizes.select("_name", "_sid"), "_name"), "mix-starts")
    inside = Window.partitionBy("_name", "_stretch").orderBy("_u", "_key", *(["_tie"] if tie else []))
    at = placed.withColumn("_i", F.row_number().over(inside) - 1).join(starts, ["_name", "_stretch"])
    rank = F.col("_start") + F.col("_i")
    out = at.withColumn("_block", F.floor(rank / block_rows)).withColumn("_place", rank % block_rows).join(slots, ["_sid", "_block"])
    position = (F.col("slot") * block_rows + F.col("_place")).alias("position")
    return out.select(F.col("_key").alias(key), F.col("_source").alias(source), F.col("_block").alias("block"), "slot", position, *([F.col("_keep").alias(keep)] if keep else []))


def _rows_and_places(docs: DataFrame, weights: dict[str, float] | None, tag: str) -> tuple[DataFrame, DataFrame]:
    """(number, row) and (number, place), both written. Places are found from numbers, ids, sources and hashes alone."""
    rows = numbered(docs, tag)
    ids = rows.select("number", F.col("row.doc_id").alias("doc_id"), F.col("row.source").alias("source"), F.xxhash64(F.to_json("row")).alias("tie"))
    places = mix(ids, weights, tie="tie", keep="number").select("number", F.struct("source", "block", "slot", "position").alias("place"))
    return rows, materialise(places, f"{tag}-places")


def _looked_up(rows: DataFrame, table: DataFrame, key: str, value: str, tag: str) -> DataFrame:
    """``rows`` with the ``value`` that ``table`` has for their ``key``, from lists that are broadcast: no row is moved.

    Keys of the table are whole numbers without gaps within 2 ** LISTED of them, each once; values are below 2 ** 31.
    """
    bits = (1 << LISTED) - 1
    chunk = F.shiftright(key, LISTED).alias("_list")
    lists = table.groupBy(chunk).agg(F.array_sort(F.collect_list(F.struct(key, F.col(value).cast("int").alias(value)))).alias("_values"))
    lists = materialise(lists.select("_list", F.transform("_values", lambda x: x[value]).alias("_values")), tag)
    found = F.get("_values", F.col(key).bitwiseAND(F.lit(bits)).cast("int")).cast("long").alias(value)
    return rows.withColumn("_list", F.shiftright(key, LISTED)).join(F.broadcast(lists), "_list").select(*rows.columns, found)


def _positioned(rows: DataFrame, places: DataFrame, tag: str) -> DataFrame:
    """(number, row, position). Positions of up to MOST_LISTED rows are broadcast; more are joined, which moves the rows."""
    positions = places.select("number", F.col("place.position").alias("position"))
    if places.count() > MOST_LISTED:
        return rows.join(positions, "number")
    return _looked_up(rows, positions, "number", "position", f"{tag}-lists")


def placed_rows(docs: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """(row, place): every row of ``docs`` as a struct, with its source, block, slot and position in the mixture.

    ``docs`` has doc_id and source and any other columns, whatever their names. Rows that share the id are placed by a hash
    of the row; rows equal in all columns are alike.
    """
    rows, places = _rows_and_places(docs, weights, "mix-rows")
    if places.count() > MOST_LISTED:
        return rows.join(places, "number").select("row", "place")
    at = _positioned(rows, places, "mix-rows").withColumn("slot", F.floor(F.col("position") / BLOCK_ROWS))
    at = _looked_up(at, places.select("place.slot", "place.block").distinct(), "slot", "block", "mix-rows-blocks")
    return at.select("row", F.struct(F.col("row.source").alias("source"), "block", "slot", "position").alias("place"))


def in_order(docs: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """The rows of ``docs``, all their columns, in the order of the mixture: from the first partition to the last."""
    rows, places = _rows_and_places(docs, weights, "mix-order")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    end = (places.agg(F.max("place.position")).first()[0] or 0) + 1
    part = F.floor(F.col("position") * parts / end).cast("int")
    return _positioned(rows, places, "mix-order").repartitionById(parts, part).sortWithinPartitions("position").select("row.*")

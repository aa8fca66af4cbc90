"""Exact dedup by a log-structured merge index, in DataFrame operations only.

Flush: every row's digest goes to one of several memtables; each is pre-aggregated to (digest, largest id, count) and
written as a run sorted by digest, with a filter over its digests. Later batches append runs of their own. Compaction asks
the filters first: an entry that no other run may hold is final as it stands; only the others are merged, and the largest
id stays. Hits, that is the rows of digests with more than one row, are then verified byte by byte: their texts are
grouped by digest *and* text, so that two texts of one digest can't fall together. Only texts of hits are shuffled,
combined before the exchange; a group of copies reaches a reducer as one row from each task, however many rows it has.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import ascii_lower, materialise, maybe_in, scratch_path

#: Runs that a flush writes.
RUNS = 4
#: Bits of all filters together at most, as they are broadcast: 64 MB. Beyond, compaction merges all entries.
FILTER_BITS = 1 << 29


def sha256_digest(text: Column) -> Column:
    return F.sha2(text, 256)


def normal_text(text: Column) -> Column:
    """What is compared: the text in lower case as far as A-Z goes, null as empty."""
    return ascii_lower(F.coalesce(text.cast("string"), F.lit("")))


class MergeIndex:
    """Sorted runs of (run, digest, keep_id, n) in a folder."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path, self.runs = spark, path or scratch_path(spark, "lsm-runs"), 0

    def append(self, digests: DataFrame, runs: int = RUNS) -> MergeIndex:
        """Flush a batch of (doc_id, digest) rows as ``runs`` more runs."""
        run = F.pmod(F.xxhash64("doc_id"), F.lit(runs)).cast("int") + self.runs
        memtables = digests.groupBy(run.alias("run"), "digest").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
        memtables.sortWithinPartitions("run", "digest").write.mode("append").option("compression", "zstd").parquet(self.path)
        self.runs += runs
        return self

    def entries(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def _split(self) -> tuple[DataFrame | None, DataFrame]:
        """Entries of digests that no other run holds, as the filters say, and all others."""
        entries = self.entries()
        most = entries.groupBy("run").count().agg(F.max("count")).first()[0] or 0
        bits = max(16, (8 * most).bit_length())
        if (self.runs << bits) > FILTER_BITS:
            return None, entries
        slot = F.pmod(F.xxhash64("digest"), F.lit(1 << bits))
        marked = entries.withColumn("_bucket", F.bitmap_bucket_number(slot)).withColumn("_at", F.bitmap_bit_position(slot))
        filters = marked.groupBy("run", "_bucket").agg(F.bitmap_construct_agg("_at").alias("bits"))
        filters = materialise(filters.groupBy("_bucket").agg(F.collect_list(F.struct("run", "bits")).alias("_filters")), "lsm-filters")
        byte = lambda f: F.conv(F.hex(F.substring(f["bits"], (F.floor(F.col("_at") / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
        elsewhere = F.exists("_filters", lambda f: (f["run"] != F.col("run")) & (F.getbit(byte(f), (F.col("_at") % 8).cast("int")) == 1))
        probed = marked.join(F.broadcast(filters), "_bucket").withColumn("_elsewhere", elsewhere)
        probed = materialise(probed.select("digest", "keep_id", "n", "_elsewhere"), "lsm-probed")
        return probed.filter(~F.col("_elsewhere")).drop("_elsewhere"), probed.filter("_elsewhere")

    def compact(self) -> DataFrame:
        """One entry (digest, keep_id, n) for each digest: the id that stays and the number of rows."""
        alone, shared = self._split()
        merged = shared.groupBy("digest").agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("n"))
        return merged if alone is None else alone.unionByName(merged)


def exact_dedup(docs: DataFrame, digest=sha256_digest, batches: int = 1) -> DataFrame:
    """Groups of equal texts, equal after lower-casing A-Z only; the row with the largest doc_id of each group stays.

    ``docs`` has doc_id and text; other columns are ignored, whatever their names. Null text counts as empty, and empty
    texts form a group like any other. Rows that repeat a doc_id and a text count one by one in ``group_size``, and all
    carry ``kept`` if theirs is the id that stays. A null doc_id stays only where its group has no other id. An empty
    table gives an empty result. ``digest`` maps the normalised text to a string; equal digests of different texts are
    told apart by the byte verification. With ``batches`` the rows are flushed in so many batches, by a hash of the id.

    Returns doc_id, keep_id, group_size, kept, text_sha256.
    """
    texts = docs.select(F.col("doc_id"), normal_text(F.col("text")).alias("norm"))
    own = digest is sha256_digest
    digests = texts.select("doc_id", digest(F.col("norm")).alias("digest"), *([] if own else [F.sha2("norm", 256).alias("sha")]))
    # the memtables' log: ids and digests, so that texts are hashed once
    log = materialise(digests, "lsm-log")
    batch = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(batches))
    index = reduce(lambda found, b: found.append(log.filter(batch == b) if batches > 1 else log), range(batches), MergeIndex(docs.sparkSession))
    entries = materialise(index.compact(), "lsm-compacted")
    multi = entries.filter("n > 1").withColumnRenamed("n", "group_size")
    placed = materialise(maybe_in(log, multi, "digest").join(multi, "digest"), "lsm-placed")

    hits = maybe_in(texts, placed, "doc_id")
    verified = materialise(
        hits.groupBy(digest(F.col("norm")).alias("digest"), "norm")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("digest", F.sha2("norm", 256).alias("sha"), "keep_id", "group_size"),
        "lsm-verified",
    )
    clashes = materialise(verified.groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).filter(F.col("texts") > 1).select("digest"), "lsm-clashes")
    if own:
        single = entries.filter("n = 1").select(F.col("keep_id").alias("doc_id"), "digest", "keep_id", F.lit(1).cast("long").alias("group_size"), F.col("digest").alias("sha"))
        placed = placed.withColumn("sha", F.col("digest"))
    else:
        single = log.join(entries.filter("n = 1"), "digest").select("doc_id", "digest", "keep_id", F.lit(1).cast("long").alias("group_size"), "sha")
    names = ["doc_id", "digest", "keep_id", "group_size", "sha"]
    if clashes.isEmpty():
        resolved = single.unionByName(placed.select(names))
    else:  # different texts under one digest: these rows take the groups that the verification found
        fine = placed.join(clashes, "digest", "left_anti").select(names)
        split = placed.join(clashes, "digest", "left_semi").select("doc_id", "digest", "sha").join(verified, ["digest", "sha"])
        resolved = single.unionByName(fine).unionByName(split.select(names))
    return resolved.select(
        "doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"), F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("sha").alias("text_sha256")
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all their columns, one for each group of equal texts: that of the largest doc_id.

    ``docs`` has doc_id and text and any other columns, whatever their names. Of rows that repeat the id, that of the
    larger text stays, by its bytes, then that of the larger JSON form of the whole row; rows equal in all are alike. A
    null doc_id stays only where its group has no other id. The index finds the digests that occur more than once; only
    rows of these are moved, grouped by digest and normalised text, and the others pass.
    """
    text = normal_text(F.col("text"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("doc_id"), text.alias("norm"), sha256_digest(text).alias("digest"))
    log = materialise(rows.select("doc_id", "digest"), "lsm-log")
    multi = materialise(MergeIndex(docs.sparkSession).append(log).compact().filter("n > 1").select("digest"), "lsm-multi")
    alone = maybe_in(rows, multi, "digest", keep=False)
    hits = maybe_in(rows, multi, "digest")
    order = F.struct(F.col("doc_id").isNotNull(), F.col("doc_id"), F.col("row.text").cast("string"), F.to_json("row"))
    kept = hits.groupBy("digest", "norm").agg(F.max_by("row", order).alias("row"))
    return alone.select("row.*").unionByName(kept.select("row.*"))

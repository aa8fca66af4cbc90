"""The training-data pipeline over ``documents``: each stage is a table that the next one reads.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return
the columns of ``documents``, whatever their names. Every row is decided by itself, whatever its id: ids may be null or
repeat. Empty tables give empty results. ``run`` applies the stages in order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from obsidio.llm import bpe, exact_dedup, langid, mixing, neardup
from obsidio.llm.common import materialise, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter stay, whatever the language; null, empty and letterless texts go."""
    rows = docs.select("doc_id", "text", F.struct(*docs.columns).alias("row"))
    return langid.identify(rows, langid.fit(docs), keep="row").filter("lettered").select("row.*")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row stays: that of the largest id; a null id stays only where there is no other."""
    return exact_dedup.deduplicated(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one row stays: that of the smallest id, one without an id only if none has one."""
    return neardup.representatives(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mixture: read from the first file to the last, sources come by their weights."""
    return mixing.in_order(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, digests of these and of the decoded text, and the document's place in the mixture.

    Readers pack files as they like, so the order of rows tells nothing; the places are worked out again from the rows.
    """
    rows = mixing.placed_rows(docs).select(F.col("row.doc_id").alias("doc_id"), F.col("row.text").alias("text"), "place")
    return bpe.encode_texts(rows, keep="place").select(
        "doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), "place.*"
    )


STAGES = [
    ("language", language),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("mixing", mixed),
    ("bpe", encoded),
]

#: Languages and the order of the mixture are beyond SQL; tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

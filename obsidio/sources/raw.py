"""The raw layer: content-addressed payloads, observations, contracts, drift, lossless splits and the dataset registry."""

from __future__ import annotations

import json
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

def canonical_json(text: str | None) -> str | None:
    """JSON with sorted keys and no spaces; what doesn't parse stays as it is."""
    if text is None:
        return None
    try:
        return json.dumps(json.loads(text), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    except ValueError:
        return text


def canonical(payload: Column) -> Column:
    def run(x: pd.Series) -> pd.Series:
        return x.map(canonical_json)

    run.__annotations__ = {"x": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "string")(payload)


def content_address(observations: DataFrame, payload: str = "payload", ordered: bool = False) -> tuple[DataFrame, DataFrame]:
    """Split observations into distinct payloads (payload_sha256, payload, byte_size, first_seen_at) and pointers.

    ``ordered`` says that payloads are canonical already, so that nothing leaves the JVM.
    """
    text = F.col(payload) if ordered else canonical(F.col(payload))
    named = observations.withColumn(payload, text).withColumn("payload_sha256", F.sha2(F.coalesce(payload, F.lit("")), 256))
    payloads = named.groupBy("payload_sha256").agg(
        F.any_value(payload).alias("payload"), F.max(F.octet_length(payload)).alias("byte_size"), F.min("fetched_at").alias("first_seen_at")
    )
    return payloads, named.drop(payload)


def append_payloads(payloads: DataFrame, known: DataFrame) -> DataFrame:
    """The payloads that ``known`` doesn't have: what an idempotent sink appends."""
    return payloads.join(known.select("payload_sha256"), "payload_sha256", "left_anti")


def raw_entity(observations: DataFrame, payloads: DataFrame, source: str, entity: str, ok_only: bool = True) -> DataFrame:
    """The observations of one source and entity type with their payloads; only successful ones unless asked otherwise."""
    chosen = observations.filter((F.col("source") == source) & (F.col("entity_type") == entity))
    if ok_only:
        chosen = chosen.filter(F.col("http_status").between(200, 299))
    return chosen.join(payloads.select("payload_sha256", "payload"), "payload_sha256")


class Keys(frozenset):
    """The paths below one JSON object, each with the mark that joins it to what stands above."""


def _below(value) -> Keys:
    """Paths of a parsed value, whose objects are Keys already; those of a list's items start with []."""
    if isinstance(value, list):
        return Keys("[]" + path for paths in set(map(_below, value)) for path in paths)
    return value if isinstance(value, Keys) else Keys()


def _object(pairs: list[tuple]) -> Keys:
    """What the parser makes of an object: its keys, and with each the paths below it."""
    return Keys(f".{key}{path}" for key, value in dict(pairs).items() for path in {"", *_below(value)})


def shape(text: str | None) -> list[str]:
    """Sorted dotted key paths of a JSON text, however deep; [] stands for the items of a list, all of which count. Null,
    scalars and what doesn't parse have none. Objects turn into paths while the text is parsed, from the innermost out."""
    try:
        found = _below(json.loads(text, object_pairs_hook=_object)) if text else Keys()
    except (ValueError, RecursionError):
        return []
    return sorted(path.removeprefix(".") for path in found)


def field_paths(payload: Column) -> Column:
    """The shape of a payload as a sorted array; empty for null and what doesn't parse."""

    def run(x: pd.Series) -> pd.Series:
        return x.map(shape)

    run.__annotations__ = {"x": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "array<string>")(payload)


def drift(batch: DataFrame, known: DataFrame, keys: Sequence[str] = ("source", "entity_type")) -> DataFrame:
    """Paths of a batch that ``known`` (keys, field_path) lacks, where it has any for that entity: a first batch is the baseline."""
    paths = batch.select(*keys, F.explode(field_paths(F.col("payload"))).alias("field_path")).distinct()
    seen = known.select(*keys).distinct()
    return paths.join(seen, list(keys), "left_semi").join(known, [*keys, "field_path"], "left_anti")


def contract(payload: Column, required: Sequence[str]) -> Column:
    """The required paths that a payload lacks; empty where it holds to the contract."""
    return F.filter(F.array(*[F.when(F.get_json_object(payload, f"$.{p}").isNull(), F.lit(p)) for p in required]), lambda p: p.isNotNull())


def quarantine(observations: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows that hold to the contract, and those that don't with their reasons. Only successful fetches are judged."""
    judged = observations.withColumn("errors", contract(F.col("payload"), required))
    bad = F.col("http_status").between(200, 299) & (F.size("errors") > 0)
    return judged.filter(~bad).drop("errors"), judged.filter(bad)


def split_lossless(payload: Column, moving: Sequence[str]) -> tuple[Column, Column]:
    """A JSON object as two maps: the stable keys and the ``moving`` ones. ``merge_split`` gives the whole again."""
    fields = F.from_json(payload, "map<string,string>")
    names = F.array(*[F.lit(k) for k in moving])
    return F.map_filter(fields, lambda k, v: ~F.array_contains(names, k)), F.map_filter(fields, lambda k, v: F.array_contains(names, k))


def merge_split(stable: Column, moved: Column) -> Column:
    return F.map_concat(stable, moved)


def latest_dataset(registry: DataFrame, name: str) -> DataFrame:
    """The newest version of a dataset: by release date, undated ones last, then by load time."""
    return registry.filter(F.col("name") == name).orderBy(F.desc_nulls_last("release_date"), F.desc("loaded_at")).limit(1)


def empty(spark: SparkSession, schema: str) -> DataFrame:
    """A typed relation without rows, for a dataset that isn't there yet."""
    return spark.createDataFrame([], schema)


def portable(df: DataFrame) -> DataFrame:
    """Scalars as they are, nested columns as JSON text."""
    nested = ("struct", "array", "map")
    return df.select(*[F.to_json(c).alias(c) if t.startswith(nested) else F.col(c) for c, t in df.dtypes])


def strip_tokens(payload: Column, pattern: str, mark: str = "~") -> Column:
    """A payload without its volatile tokens, so that equal contents hash alike, and the tokens: struct<stable, tokens>."""
    return F.struct(F.regexp_replace(payload, pattern, mark).alias("stable"), F.regexp_extract_all(payload, F.lit(pattern), 0).alias("tokens"))


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Write a table over what was there, and read it back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""Typed views of raw payloads from a table of fields: which record, which path, which kind of value.

A payload is parsed once to a variant and each field taken from it by its path, all in the JVM. A value that doesn't fit
its kind is null.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import clean
from ..sources import raw

#: What a row of a raw entity has beside its payload.
LINEAGE = ["observation_id", "run_id", "fetched_at"]


def at(record: Column, path: str, kind: str = "string") -> Column:
    """The value at a path of a variant; null where there is none or it is of another kind."""
    return F.try_variant_get(record, f"${path}" if path.startswith(("[", ".")) else f"$.{path}" if path else "$", kind)


def json_at(record: Column, path: str) -> Column:
    """The JSON text of what is at a path; null for JSON null."""
    return F.nullif(F.to_json(at(record, path, "variant")), F.lit("null"))


def items(record: Column, path: str) -> Column:
    """The elements of the array at a path; none where there is no array."""
    return F.coalesce(at(record, path, "array<variant>"), F.array().cast("array<variant>"))


def texts(record: Column, path: str) -> Column:
    """The elements of the array at a path as texts."""
    return F.transform(items(record, path), lambda v: F.try_variant_get(v, "$", "string"))


KINDS = {
    "text": lambda r, p: at(r, p),
    "filled": lambda r, p: clean.blank_to_null(at(r, p)),
    "clean": lambda r, p: clean.clean_text(at(r, p)),
    "url": lambda r, p: clean.clean_url(at(r, p)),
    "domain": lambda r, p: clean.registrable_domain(at(r, p)),
    "host": lambda r, p: clean.domain(at(r, p)),
    "phone": lambda r, p: clean.phone_e164(at(r, p)),
    "postcode": lambda r, p: clean.postcode(at(r, p)),
    "int": lambda r, p: at(r, p).try_cast("double").try_cast("int"),
    "long": lambda r, p: at(r, p).try_cast("bigint"),
    "double": lambda r, p: at(r, p).try_cast("double"),
    "bool": lambda r, p: at(r, p).try_cast("boolean"),
    "money": lambda r, p: at(r, p).try_cast("decimal(10,2)"),
    "cents": lambda r, p: clean.cents(at(r, p).try_cast("decimal(18,0)")),
    "rating": lambda r, p: at(r, p).try_cast("decimal(4,2)"),
    "time": lambda r, p: F.try_to_timestamp(at(r, p)),
    "epoch": lambda r, p: F.timestamp_seconds(F.when(at(r, p).rlike("^[0-9]+([.][0-9]+)?$"), at(r, p).try_cast("double"))),
    "day": lambda r, p: F.to_date(F.try_to_timestamp(F.regexp_extract(at(r, p), "^\\d{2}\\.\\d{2}\\.\\d{4}$", 0), F.lit("dd.MM.yyyy"))),
    "day8": lambda r, p: F.to_date(F.try_to_timestamp(F.substring(at(r, p), 1, 8), F.lit("yyyyMMdd"))),
    "json": json_at,
    "texts": texts,
    "size": lambda r, p: F.size(items(r, p)),
    "price_level": lambda r, p: F.nullif(F.length(F.regexp_replace(at(r, p), "[^$€£]", "")), F.lit(0)).cast("smallint"),
    "digits": lambda r, p: clean.blank_to_null(F.regexp_replace(at(r, p), "[^0-9.]", "")).try_cast("decimal(20,2)"),
    "code": lambda r, p: clean.blank_to_null(F.regexp_replace(F.upper(at(r, p)), "[^A-Z0-9]", "")),
}


@dataclass
class View:
    """One typed view: the raw entity, the lists in it that are spread (an item of the last one is a row), and its fields.

    ``fields`` lines are "column kind path [path ...]": the first path with a value counts. A path that begins with ^
    starts at the payload, any other at the item. ``rank`` names the place of the item in its list, from 1. ``latest``
    are the columns of which only the newest row stays.
    """

    source: str
    entity: str
    fields: str
    spread: list[str] = field(default_factory=list)
    ok_only: bool = True
    rank: str | None = None
    keys: dict[str, str] = field(default_factory=dict)
    latest: list[str] = field(default_factory=list)
    newest_payload: bool = False


def latest_of(rows: DataFrame, keys: list[str], *first: Column) -> DataFrame:
    """The newest row of each key; of equally new ones that of the smallest observation."""
    w = Window.partitionBy(*keys).orderBy(*first, F.desc("fetched_at"), F.col("observation_id"))
    return rows.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def records(observations: DataFrame, payloads: DataFrame, view: View) -> DataFrame:
    """The rows of a view before its fields: lineage, natural_key, request_meta, payload and item as variants, rank."""
    rows = raw.raw_entity(observations, payloads, view.source, view.entity, view.ok_only)
    if view.newest_payload:
        rows = latest_of(rows, ["natural_key"])
    rows = rows.select(*LINEAGE, "natural_key", "payload_sha256", F.try_parse_json("request_meta").alias("meta"), F.try_parse_json("payload").alias("payload"))
    rows = rows.withColumn("item", F.col("payload")).withColumn("rank", F.lit(None).cast("int"))
    for path in view.spread:
        rows = rows.select("*", F.posexplode(items(F.col("item"), path)).alias("_at", "_item"))
        rows = rows.withColumn("item", F.col("_item")).withColumn("rank", F.col("_at") + 1).drop("_at", "_item")
    return rows


def typed(rows: DataFrame, view: View) -> DataFrame:
    """The fields of a view, with the lineage of each row."""
    columns = []
    for line in filter(str.strip, view.fields.splitlines()):
        name, kind, *paths = line.split()
        found = [KINDS[kind](F.col("payload") if p.startswith("^") else F.col("item"), p.lstrip("^")) for p in paths]
        columns.append((found[0] if len(found) == 1 else F.coalesce(*found)).alias(name))
    keys = [F.col(c).alias(name) if "." not in c else at(F.col("meta"), c.removeprefix("meta.")).alias(name) for name, c in view.keys.items()]
    rank = [F.col("rank").alias(view.rank)] if view.rank else []
    out = rows.select(*LINEAGE, *keys, *rank, *columns)
    return latest_of(out, view.latest) if view.latest else out

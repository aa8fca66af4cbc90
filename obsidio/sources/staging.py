"""Typed views of raw payloads: one builder for each kind of record, without business logic.

Each takes the rows of ``raw.raw_entity``, with ``payload`` as JSON text, ``observation_id`` and ``fetched_at``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import clean

_VENUE = """struct<title:string, track_id:string, venue:struct<id:string, name:string, slug:string, address:string, city:string, currency:string, location:array<double>, delivers:boolean, online:boolean,
    franchise:string, price_range:int, rating:struct<rating:int, score:double, volume:bigint>, short_description:string, tags:array<string>>, sorting:struct<sortables:array<struct<id:string, value:int>>>>"""


def _listed(df: DataFrame, kind: str) -> DataFrame:
    """The elements of a JSON list with their rank from 1."""
    spread = df.withColumn("_items", F.from_json("payload", f"array<{kind}>")).select("*", F.posexplode("_items").alias("_pos", "item"))
    return spread.withColumn("list_rank", F.col("_pos") + 1).drop("_items", "_pos")


def _latest(df: DataFrame, keys: list[str]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.desc("fetched_at"), F.desc("observation_id"))
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def venue_listing(df: DataFrame) -> DataFrame:
    """Venue x observation of list responses."""
    v = F.col("item.venue")
    return _listed(df, _VENUE).select(
        "observation_id", "fetched_at", "list_rank", v["id"].alias("venue_id"), clean.clean_text(v["name"]).alias("name"), v["slug"].alias("slug"), clean.clean_text(v["address"]).alias("address"),
        F.get(v["location"], F.lit(1)).alias("lat"), F.get(v["location"], F.lit(0)).alias("lon"), v["price_range"].cast("smallint").alias("price_range"), v["franchise"].alias("franchise"),
        v["rating"]["score"].try_cast("decimal(4,2)").alias("rating_value"), v["rating"]["volume"].alias("rating_count"), v["tags"].alias("cuisine_tags"),
    )


def venue_coverage(df: DataFrame) -> DataFrame:
    """Venue x place of query x observation: whether it delivers there, and the sortable values by their names."""
    sortable = lambda name: F.filter("item.sorting.sortables", lambda s: s["id"] == name)
    return _listed(df, _VENUE).select(
        "observation_id", "fetched_at", "natural_key", F.col("item.venue.id").alias("venue_id"), "list_rank", F.coalesce("item.venue.delivers", F.lit(False)).alias("offered"),
        F.get(sortable("rating"), F.lit(0))["value"].alias("sort_rating"), F.get(sortable("distance"), F.lit(0))["value"].alias("sort_distance"),
    )


_POSTS = """struct<data:array<struct<id:string, subreddit:string, author:string, title:string, selftext:string, created_utc:bigint, score:bigint, num_comments:bigint, is_video:boolean, is_gallery:boolean,
    is_self:boolean, url:string, over_18:boolean, link_flair_text:string>>>"""


def archive_post(df: DataFrame) -> DataFrame:
    """The latest state of each archived post; removed texts are null."""
    p = df.select("observation_id", "fetched_at", F.explode(F.from_json("payload", _POSTS)["data"]).alias("p"))
    body = F.when(~F.col("p.selftext").isin("[removed]", "[deleted]"), clean.clean_text(F.col("p.selftext")))
    kind = F.when(F.col("p.is_video"), "video").when(F.col("p.is_gallery"), "gallery").when(F.col("p.is_self"), "text").otherwise("link")
    rows = p.select(
        "observation_id", "fetched_at", F.col("p.id").alias("post_id"), F.col("p.subreddit").alias("context"), clean.clean_text(F.col("p.title")).alias("title"), body.alias("caption"), kind.alias("post_type"),
        F.timestamp_seconds("p.created_utc").alias("posted_at"), F.col("p.score").alias("score"), F.col("p.num_comments").alias("comments"), clean.domain(F.col("p.url")).alias("link_domain"),
    )
    return _latest(rows, ["post_id"])


def event_feed(df: DataFrame) -> DataFrame:
    """Event x observation of a feed with German dates."""
    kind = "struct<index:array<struct<id:bigint, bezeichnung:string, bezirk:string, strasse:string, plz:string, von:string, bis:string, zeit:string, veranstalter:string, www:string>>>"
    e = df.select("observation_id", "fetched_at", F.explode(F.from_json("payload", kind)["index"]).alias("e"))
    day = lambda c: F.try_to_date(F.col(c), "dd.MM.yyyy") if hasattr(F, "try_to_date") else F.to_date(F.try_to_timestamp(F.col(c), F.lit("dd.MM.yyyy")))
    return e.select(
        "observation_id", "fetched_at", F.col("e.id").alias("event_id"), clean.clean_text(F.col("e.bezeichnung")).alias("name"), F.col("e.bezirk").alias("district"), clean.clean_text(F.col("e.strasse")).alias("street"),
        clean.postcode(F.col("e.plz")).alias("postcode"), day("e.von").alias("starts"), F.coalesce(day("e.bis"), day("e.von")).alias("ends"), clean.clean_url(F.col("e.www")).alias("url"),
    )


def _at(payload: Column, *path: int) -> Column:
    """A place in nested JSON arrays, as text; null where the record is shorter."""
    return F.try_variant_get(payload, "$" + "".join(f"[{i}]" for i in path), "string")


def positional_place(df: DataFrame) -> DataFrame:
    """Place x observation of an undocumented record, whose fields are known by position."""
    v = F.col("_v")
    return df.withColumn("_v", F.try_parse_json("payload")).select(
        "observation_id", "fetched_at", _at(v, 78).alias("place_id"), _at(v, 10).alias("feature_id"), clean.clean_text(_at(v, 11)).alias("name"), _at(v, 9, 2).try_cast("double").alias("lat"),
        _at(v, 9, 3).try_cast("double").alias("lon"), _at(v, 4, 7).try_cast("decimal(3,1)").alias("rating"), _at(v, 4, 8).try_cast("bigint").alias("rating_count"), clean.clean_url(_at(v, 7, 0)).alias("website"),
        clean.phone_e164(_at(v, 178, 0, 3)).alias("phone"), F.try_variant_get(v, "$[13]", "array<string>").alias("categories"), F.col("payload").contains("Permanently closed").alias("closed"),
    )


def duration_seconds(iso: Column) -> Column:
    """Seconds of an ISO 8601 duration of days and time; null for anything else."""
    part = lambda unit: F.coalesce(F.nullif(F.regexp_extract(iso, f"(\\d+){unit}", 1), F.lit("")).cast("int"), F.lit(0))
    return F.when(iso.rlike("^P(\\d+D)?(T(\\d+H)?(\\d+M)?(\\d+S)?)?$") & (F.length(iso) > 2), part("D") * 86400 + part("H") * 3600 + part("M") * 60 + part("S"))


def video(df: DataFrame) -> DataFrame:
    """Video x observation."""
    kind = "struct<items:array<struct<id:string, snippet:struct<title:string, description:string, publishedAt:string, tags:array<string>>, contentDetails:struct<duration:string>, statistics:struct<viewCount:string, likeCount:string>>>>"
    v = df.select("observation_id", "fetched_at", F.explode(F.from_json("payload", kind)["items"]).alias("v"))
    return v.select(
        "observation_id", "fetched_at", F.col("v.id").alias("video_id"), clean.clean_text(F.col("v.snippet.title")).alias("title"), clean.clean_text(F.col("v.snippet.description")).alias("caption"),
        F.try_to_timestamp("v.snippet.publishedAt").alias("posted_at"), duration_seconds(F.col("v.contentDetails.duration")).alias("duration_s"), F.col("v.statistics.viewCount").try_cast("bigint").alias("views"),
        F.col("v.statistics.likeCount").try_cast("bigint").alias("likes"), F.col("v.snippet.tags").alias("tags"),
    )


def sheet_long(cells: DataFrame, keys: list[str], order: str, values: list[str]) -> DataFrame:
    """A sheet made for reading, as rows of one number each: keys are carried down over blank cells, columns unpivoted.

    ``cells``: ``sheet``, the row number ``order``, the key columns and the value columns, all text.
    """
    w = Window.partitionBy("sheet").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    filled = cells.select("sheet", order, *[F.last(clean.blank_to_null(F.btrim(k)), ignorenulls=True).over(w).alias(k) for k in keys], *values)
    long = filled.unpivot(["sheet", order, *keys], values, "column_label", "text_value")
    number = F.replace(F.replace(F.btrim("text_value"), F.lit("."), F.lit("")), F.lit(","), F.lit(".")).try_cast("double")
    return long.withColumn("value", number).filter(F.col("value").isNotNull())

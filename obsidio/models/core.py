"""Entities across sources: listings, offerings, posts, accounts, pages, and the real businesses behind them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import clean, geo
from ..operators.windows import scd2
from .catalog import model
from .typed import latest_of


def key_id(*parts: Column | str) -> Column:
    """An id in UUID form of parts joined by colons."""
    return clean.uuid_of(F.concat_ws(":", *[F.lit(p) if isinstance(p, str) else p for p in parts]))


def newest(value: str, at: str = "observed_at", when: Column | None = None) -> Column:
    """The value with the latest time among rows that have one."""
    there = F.col(value).isNotNull() if when is None else F.col(value).isNotNull() & when
    return F.max_by(value, F.when(there, F.col(at))).alias(value)


def lower_texts(x: Column) -> Column:
    return F.transform(x, F.lower)


def json_names(x: str, *fields: str) -> Column:
    """Lower-case values of fields of the objects in a JSON array, field by field."""
    kind = f"array<struct<{','.join(f'{f}:string' for f in fields)}>>"
    rows = F.coalesce(F.from_json(x, kind), F.array().cast(kind))

    def named(field: str) -> Column:
        return F.transform(rows, lambda c: F.lower(c[field]))

    return F.concat(*map(named, fields))


#: What a place observation says, whatever its source; the columns of int_listing_observation, with their kinds.
PLACE = """observation_id string, run_id string, observed_at timestamp, name string, address_line string, postcode string, city string, lat double, lon double, phone string,
    website string, legal_name string, legal_register_id string, vat_number string, brand_name string, cuisine_tags array<string>, price_range int, rating_value double, rating_count int,
    order_minimum double, delivery_fee double, delivery_estimate_min int, is_halal boolean, product_line string, description string, logo_url string, cover_image_url string,
    opening_hours_text string, business_status string, share_url string"""
PLACE_KINDS = dict(x.split() for x in PLACE.split(","))


def place(rows: DataFrame, platform: str, kind: str, lo: float, hi: float, **given: Column) -> DataFrame:
    """Rows of a view in the one shape: columns of the same name are taken over, ``given`` ones computed, others null."""
    found = {c: given.get(c, F.col(c) if c in rows.columns else F.lit(None)).cast(t).alias(c) for c, t in PLACE_KINDS.items()}
    if "observed_at" not in given and "fetched_at" in rows.columns:
        found["observed_at"] = F.col("fetched_at").cast("timestamp").alias("observed_at")
    head = [F.lit(platform).alias("platform"), F.col("platform_id").cast("string").alias("platform_id"), F.lit(kind).alias("obs_kind")]
    return rows.select(*head, *found.values(), F.lit(lo).alias("rating_lo"), F.lit(hi).alias("rating_hi"))


def _with_halal(tags: Column) -> Column:
    return F.exists(tags, lambda t: F.lower(t).contains("halal"))


@model
def int_listing_observation(
    stg_wolt__venue_listing: DataFrame, stg_wolt__venue_static: DataFrame, stg_wolt__venue_dynamic: DataFrame, stg_lieferando__restaurant_listing: DataFrame, stg_lieferando__manifest: DataFrame,
    stg_google_maps__place: DataFrame, stg_osm__poi: DataFrame, stg_overture__place: DataFrame, stg_uber_eats__store: DataFrame, stg_foursquare__place: DataFrame, stg_tripadvisor__restaurant: DataFrame,
) -> DataFrame:
    """Every observation of a place on any platform, in one shape; null where the observation doesn't say."""
    c = F.col
    listed_cuisines, manifest_cuisines = json_names("cuisines", "uniqueName", "name"), json_names("cuisines", "SeoName", "Name")
    levels = c("price_range").between(1, 4)
    band = F.when(c("price_band").rlike("^€+$"), F.length("price_band")).when(
        c("price_band").rlike("^[0-9]"), F.least(F.lit(4), F.greatest(F.lit(1), F.ceil(F.regexp_extract("price_band", "([0-9]+)\\s*€?\\s*$", 1).try_cast("double") / 15)))
    )
    closed = F.when(c("operating_status").isin("permanently_closed", "closed"), "closed_permanently").when(c("operating_status") == "temporarily_closed", "closed_temporarily")
    stores = F.transform(clean.json_array(c("cuisines")), lambda t: F.lower(F.replace(t, F.lit("-"), F.lit(" "))))
    parts = [
        place(stg_wolt__venue_listing, "wolt", "venue_listing", 0, 10, brand_name=c("franchise"), cuisine_tags=lower_texts(c("tags")), description=c("short_description")),
        place(
            stg_wolt__venue_static, "wolt", "venue_static", 0, 10, address_line=F.when(~F.lower("address_line").contains("virtuelles geschäft"), c("address_line")),
            website=F.when(~c("website").contains("wolt.com"), c("website")), cuisine_tags=lower_texts(c("food_tags")), delivery_fee=c("delivery_base_fee"),
        ),
        place(stg_wolt__venue_dynamic, "wolt", "venue_dynamic", 0, 10, business_status=F.when(c("open_status") == "CLOSED", "closed_now")),
        place(
            stg_lieferando__restaurant_listing, "lieferando", "restaurant_listing", 0, 5, cuisine_tags=listed_cuisines, is_halal=_with_halal(json_names("cuisines", "uniqueName")),
            business_status=F.when(c("is_test"), "test"),
        ),
        place(
            stg_lieferando__manifest, "lieferando", "menu_manifest", 0, 5, cuisine_tags=manifest_cuisines, is_halal=F.coalesce("is_halal", F.lit(False)) | _with_halal(json_names("cuisines", "SeoName")),
            product_line=c("storefront_type"), opening_hours_text=c("opening_times"), business_status=F.when(c("is_offline"), "offline"),
        ),
        place(
            stg_google_maps__place, "google_maps", "place", 1, 5, cuisine_tags=lower_texts(c("categories")), price_range=band, is_halal=_with_halal(c("categories")), product_line=c("result_type"),
            description=F.coalesce("description", "short_description"), logo_url=c("image_url"), opening_hours_text=c("opening_hours"),
        ),
        place(
            stg_osm__poi, "osm", "poi", 1, 5, observed_at=F.coalesce(c("osm_edited_at"), F.try_to_timestamp("dataset_version")), brand_name=c("brand"), is_halal=c("diet_halal").isin("yes", "only"),
            cuisine_tags=F.concat(F.coalesce("cuisines", F.array().cast("array<string>")), F.array("poi_type")), product_line=c("poi_type"), opening_hours_text=c("opening_hours"),
            business_status=F.when(c("is_disused"), "closed_permanently"),
        ),
        place(
            stg_overture__place, "overture", "place", 1, 5, observed_at=F.try_to_timestamp(F.split_part("dataset_version", F.lit("."), F.lit(1))), brand_name=c("brand"), product_line=c("basic_category"),
            cuisine_tags=F.concat(F.array("basic_category", "category_primary"), F.coalesce("category_alternates", F.array().cast("array<string>"))), business_status=closed,
        ),
        place(stg_uber_eats__store, "uber_eats", "store", 1, 5, city=F.lit("Berlin"), cuisine_tags=stores, price_range=F.when(levels, c("price_range")), is_halal=_with_halal(stores)),
        place(
            stg_foursquare__place, "foursquare", "place", 1, 5, observed_at=F.coalesce("date_refreshed", "date_created"), business_status=F.when(c("date_closed").isNotNull(), "closed_permanently"),
            cuisine_tags=F.transform(F.flatten(F.transform("category_labels", lambda t: F.split(t, ">"))), lambda t: F.lower(F.btrim(t))),
        ),
        place(stg_tripadvisor__restaurant, "tripadvisor", "baseline_2021", 1, 5, observed_at=c("observed_on"), city=F.lit("Berlin"), cuisine_tags=c("cuisines"), price_range=F.when(levels, c("price_range")), is_halal=F.array_contains("cuisines", "halal")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return observed_places(out)


def observed_places(rows: DataFrame) -> DataFrame:
    """Place observations with their keys and what is derived from each by itself."""
    return rows.select(
        F.concat_ws(":", "platform", "platform_id").alias("listing_key"), key_id(F.col("platform"), F.col("platform_id")).alias("listing_id"), "*", clean.name_key(F.col("name"), cleaned=True).alias("name_key"),
        clean.street(F.col("address_line"), cleaned=True).alias("street"), clean.house_number(F.col("address_line"), cleaned=True).alias("house_number"), clean.registrable_domain(F.col("website")).alias("website_domain"),
        F.when(F.col("rating_value").isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col("rating_value") - F.col("rating_lo")) / (F.col("rating_hi") - F.col("rating_lo")))).cast("decimal(6,4)")).alias("rating_norm"),
    )


#: Attributes of a listing that are the newest that any of its observations gives.
NEWEST = """name name_key address_line street house_number postcode city phone website website_domain legal_name legal_register_id vat_number brand_name product_line description logo_url
    cover_image_url opening_hours_text share_url""".split()
#: Observations that know a place's position best.
PLACED = ["venue_static", "menu_manifest", "place", "poi"]


@model
def listing(int_listing_observation: DataFrame, geo_area: DataFrame, market_id: str = "berlin") -> DataFrame:
    """One business on one platform as it is now: of each attribute the newest value, with the areas around it."""
    o = int_listing_observation
    sound = F.col("price_range").between(1, 4)
    best = F.when(F.col("lat").isNotNull() & F.col("lon").isNotNull(), F.struct(F.col("obs_kind").isin(PLACED), F.col("observed_at")))
    current = o.groupBy("listing_key", "listing_id", "platform", "platform_id").agg(
        *[newest(c) for c in NEWEST], newest("price_range", when=sound), F.max_by("lat", best).alias("lat"), F.max_by("lon", best).alias("lon"), F.bool_or("is_halal").alias("is_halal"),
        F.array_sort(F.array_distinct(F.filter(F.flatten(F.collect_list("cuisine_tags")), lambda t: t != ""))).alias("source_tags"), F.max_by("business_status", "observed_at").alias("last_status"),
        F.min("observed_at").alias("first_seen_at"), F.max("observed_at").alias("last_seen_at"), F.count(F.lit(1)).alias("observation_count"),
    )
    gone = ["closed_permanently", "offline", "test", "closed_temporarily"]
    out = current.withColumn("status", F.when(F.col("last_status").isin(gone), F.col("last_status")).otherwise("active"))
    around = geo.covering_areas(o, geo_area.filter((F.col("kind") != "market") | (F.col("market_id") == market_id)))
    of = lambda kind, field: F.col("areas")[kind][field]
    out = out.join(around, ["lat", "lon"], "left").withColumns({
        "in_market": of("market", "code").isNotNull(), "district": of("district", "name"), "locality": of("locality", "name"), "planning_area_id": of("planning_area", "code"),
        "planning_area": of("planning_area", "name"), "postcode_resolved": F.coalesce("postcode", of("postcode", "code")),
    })
    return out.drop("areas")


#: Attributes whose change makes a new version of a listing.
VERSIONED = ["name", "address_line", "postcode", "phone", "website", "legal_name", "legal_register_id", "vat_number", "brand_name", "price_range"]


@model
def listing_history(int_listing_observation: DataFrame) -> DataFrame:
    """Listing x version: a row for each time that its lasting attributes changed."""
    kinds = [*PLACED, "restaurant_listing", "venue_listing"]
    rows = int_listing_observation.filter(F.col("obs_kind").isin(kinds) & F.col("name").isNotNull())
    return scd2(rows, ["listing_id", "listing_key", "platform"], ["observed_at", "obs_kind"], VERSIONED)


@model
def listing_snapshot(int_listing_observation: DataFrame) -> DataFrame:
    """Listing x observation of what moves; equal readings of a run fall together."""
    numbers = ["rating_value", "rating_count", "order_minimum", "delivery_fee", "delivery_estimate_min", "business_status"]
    rows = int_listing_observation.filter(F.coalesce(*[F.col(c).cast("string") for c in numbers]).isNotNull())
    rows = rows.withColumn("_run", F.coalesce("run_id", F.col("observed_at").cast("string")))
    same = ["listing_id", "listing_key", "platform", "obs_kind", "_run", *numbers]
    out = rows.groupBy(*same).agg(F.min_by(F.struct("run_id", "observed_at", "rating_lo", "rating_hi", "rating_norm"), "observed_at").alias("r"))
    reason = F.when((F.col("delivery_fee") > 30) | (F.col("order_minimum") > 150), "catering_or_error")
    return out.select(
        "listing_id", "listing_key", "platform", F.col("obs_kind").alias("observed_via"), "r.run_id", "r.observed_at", "rating_value", F.col("r.rating_lo").alias("rating_scale_min"),
        F.col("r.rating_hi").alias("rating_scale_max"), "r.rating_norm", "rating_count", "order_minimum", F.col("delivery_fee").alias("base_delivery_fee"), "delivery_estimate_min", "business_status",
        F.lit("EUR").alias("currency"), reason.alias("outlier_reason"),
    )


@model
def listing_cuisine(listing: DataFrame, cuisine_map: DataFrame) -> DataFrame:
    """Listing x cuisine of the taxonomy, by the listing's tags.

    A map tag of five letters or more matches at the start of any word of a tag, a shorter one a whole run of words. Tags
    meet map tags by the start of a word, not pair by pair.
    """
    tags = listing.select("listing_id", F.explode("source_tags").alias("source_tag")).withColumn("tag", clean.fold(F.col("source_tag")))
    distinct = tags.select("tag").distinct()
    starts = distinct.withColumn("_at", F.explode(F.sequence(F.lit(1), F.greatest(F.length("tag"), F.lit(1)))))
    starts = starts.filter((F.col("_at") == 1) | ~F.expr("substring(tag, _at - 1, 1)").rlike("[a-z0-9_]")).withColumn("_rest", F.expr("substring(tag, _at)"))
    starts = starts.withColumn("_head", F.substring("_rest", 1, 3))
    known = cuisine_map.select(F.col("tag").alias("map_tag"), "cuisine_id", "cuisine_group", F.substring("tag", 1, 3).alias("_head"))
    after = F.expr("substring(_rest, length(map_tag) + 1, 1)")
    found = starts.join(known, "_head").filter(F.expr("startswith(_rest, map_tag)") & ((F.length("map_tag") >= 5) | ~after.rlike("[a-z0-9_]")))
    found = found.select("tag", "map_tag", "cuisine_id", "cuisine_group").distinct()
    return tags.join(found, "tag").groupBy("listing_id", "cuisine_id").agg(
        F.min("cuisine_group").alias("cuisine_group"), F.count(F.lit(1)).alias("tag_hits"), F.bool_or(F.col("tag") == F.col("map_tag")).alias("exact_match"), F.sort_array(F.collect_set("source_tag")).alias("source_tags")
    )


#: The order in which platforms are believed; others come last.
BELIEVED = ["google_maps", "wolt", "lieferando", "osm"]
DELIVERY = ["wolt", "lieferando", "uber_eats"]


@model
def business(listing: DataFrame, listing_cuisine: DataFrame, business_assignment: DataFrame, brand_assignment: DataFrame) -> DataFrame:
    """One real business with what its listings say, each field by the platform most likely right about it."""
    m = business_assignment.select("business_id", "listing_key", "match_prob", "method").join(listing, "listing_key")
    place_of = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, BELIEVED)), F.col("platform")), F.lit(0)), F.lit(5))
    m = m.withColumn("_order", F.struct(place_of, -F.col("observation_count"), F.col("listing_key")))
    own_site = ~F.col("website").rlike("(wolt|lieferando|ubereats)\\.")

    def best(c: str, alias: str | None = None, when: Column | None = None) -> Column:
        there = F.col(c).isNotNull() if when is None else F.col(c).isNotNull() & when
        return F.min_by(c, F.when(there, F.col("_order"))).alias(alias or c)

    fields = ["name", "name_key", "lat", "lon", "address_line", "street", "house_number", "district", "locality", "planning_area_id", "planning_area", "phone", "website_domain", "legal_name", "legal_register_id", "vat_number", "price_range"]
    on = {"on_wolt": "wolt", "on_lieferando": "lieferando", "on_uber_eats": "uber_eats", "on_google_maps": "google_maps", "in_osm": "osm", "in_overture": "overture"}
    status = (
        F.when(F.bool_and(F.col("status").isin("closed_permanently", "offline")), "closed")
        .when(F.bool_or((F.col("status") == "active") & F.col("platform").isin("wolt", "lieferando", "google_maps")), "active")
        .when(F.bool_or(F.col("status") == "closed_temporarily"), "closed_temporarily")
        .otherwise("unverified")
    )
    out = m.groupBy("business_id").agg(
        *[best(c) for c in fields], best("postcode_resolved", "postcode"), best("website", when=own_site), F.bool_or("is_halal").alias("is_halal"), *[F.bool_or(F.col("platform") == p).alias(c) for c, p in on.items()],
        F.count_if(F.col("platform").isin(DELIVERY)).alias("delivery_platform_count"), F.count(F.lit(1)).alias("listing_count"), F.sort_array(F.collect_list("listing_key")).alias("listing_keys"), status.alias("status"),
        F.bool_or("in_market").alias("in_market"), F.min("first_seen_at").alias("first_seen_at"), F.max("last_seen_at").alias("last_seen_at"), F.min("match_prob").alias("min_match_prob"),
    )
    hits = m.join(listing_cuisine, "listing_id").groupBy("business_id", "cuisine_id", "cuisine_group").agg(F.sum("tag_hits").alias("hits"))
    ranked = hits.groupBy("business_id").agg(F.array_sort(F.collect_list(F.struct((-F.col("hits")).alias("h"), "cuisine_id", "cuisine_group"))).alias("c"))
    ranked = ranked.select("business_id", F.col("c")[0]["cuisine_id"].alias("primary_cuisine"), F.col("c")[0]["cuisine_group"].alias("primary_cuisine_group"), F.col("c.cuisine_id").alias("cuisines"))
    return out.join(ranked, "business_id", "left").join(brand_assignment.select("business_id", "brand_id", "brand_name"), "business_id", "left")


@model
def business_geo(business: DataFrame) -> DataFrame:
    """The grid cells of businesses, in three sizes."""
    return business.select("business_id", "lat", "lon", *[geo.grid_cell(F.col("lat"), F.col("lon"), size).alias(f"cell_{size}") for size in (200, 500, 1500)])


@model
def brand(brand_assignment: DataFrame) -> DataFrame:
    """Chains with their number of places."""
    return brand_assignment.groupBy("brand_id").agg(F.min("brand_name").alias("brand_name"), F.count(F.lit(1)).alias("locations"))


@model
def external_id(listing: DataFrame, business_assignment: DataFrame, stg_google_maps__place: DataFrame) -> DataFrame:
    """Every id that other sources know a business by."""
    own = business_assignment.join(listing.select("listing_key", "platform", "platform_id"), "listing_key")
    names = ["business_id", "source", "external_id", "listing_key", "match_prob", "method"]
    place_ids = latest_of(stg_google_maps__place.filter("google_place_id is not null"), ["platform_id"]).select("platform_id", "google_place_id")
    second = own.filter("platform = 'google_maps'").join(place_ids, "platform_id").withColumn("source", F.lit("google_place_id")).withColumnRenamed("google_place_id", "external_id")
    return own.withColumn("source", F.col("platform")).withColumn("external_id", F.col("platform_id")).select(names).unionByName(second.select(names))


@model
def coverage_observation(stg_wolt__coverage: DataFrame, stg_lieferando__coverage: DataFrame) -> DataFrame:
    """Listing x area x observation: whether it delivers there, for how much and how soon."""
    n = lambda kind: F.lit(None).cast(kind)
    count = lambda c: F.size(F.try_variant_get(F.try_parse_json(c), "$", "array<variant>"))
    estimate = F.col("delivery_estimate_min")
    wolt = stg_wolt__coverage.select(
        key_id("wolt", F.col("platform_id")).alias("listing_id"), F.lit("wolt").alias("platform"), F.lit("cell").alias("area_type"), F.col("cell").alias("area_id"), "point_lat", "point_lon", "run_id",
        F.col("fetched_at").alias("observed_at"), "list_position", F.col("delivers").alias("offered"), F.col("online").alias("open_now"), n("decimal(10,2)").alias("delivery_fee"), n("decimal(10,2)").alias("order_minimum"),
        estimate.alias("eta_min_lower"), estimate.alias("eta_min_upper"), n("int").alias("distance_m"), "delivery_price_rank", n("int").alias("promoted_rank"), count("promotions").alias("promotion_count"), "wolt_plus",
    )
    other = stg_lieferando__coverage.select(
        key_id("lieferando", F.col("platform_id")).alias("listing_id"), F.lit("lieferando").alias("platform"), F.lit("postcode").alias("area_type"), F.col("postcode").alias("area_id"), "point_lat", "point_lon", "run_id",
        F.col("fetched_at").alias("observed_at"), "list_position", F.lit(True).alias("offered"), F.col("open_now_delivery").alias("open_now"), "delivery_fee", "order_minimum", "eta_min_lower", "eta_min_upper",
        "distance_m", n("int").alias("delivery_price_rank"), "promoted_rank", count("deals").alias("promotion_count"), n("boolean").alias("wolt_plus"),
    )
    return wolt.unionByName(other)


@model
def int_offering_observation(stg_wolt__menu_item: DataFrame, stg_lieferando__menu_item: DataFrame) -> DataFrame:
    """Every menu item of every menu seen."""
    names = ["platform_id", "offering_platform_id", "observation_id", "run_id", "fetched_at", "category", "name", "description", "price", "currency", "dietary_tags", "image_url", "position"]
    more = {"original_price": "decimal(10,2)", "price_max": "decimal(10,2)", "deposit": "decimal(10,2)", "size_variants": "string", "option_group_count": "int", "alcohol_permille": "int", "unavailable": "boolean"}

    def shaped(rows: DataFrame, platform: str) -> DataFrame:
        rest = [(F.col(c) if c in rows.columns else F.lit(None)).cast(t).alias(c) for c, t in more.items()]
        return rows.filter("name is not null").select(F.lit(platform).alias("platform"), *names, *rest)

    both = shaped(stg_wolt__menu_item, "wolt").unionByName(shaped(stg_lieferando__menu_item, "lieferando")).withColumnRenamed("fetched_at", "observed_at")
    p = F.col("platform")
    return both.select(key_id(p, F.col("platform_id"), F.col("offering_platform_id")).alias("offering_id"), key_id(p, F.col("platform_id")).alias("listing_id"), "*", clean.fold(F.col("name"), cleaned=True).alias("name_folded"))


#: Dietary and other flags of an offering, by what its folded text holds.
OFFERING_FLAGS = {
    "halal": "\\bhalal\\b", "vegan": "\\bvegan", "vegetarian": "\\b(vegetari|veggie)", "spicy": "\\b(scharf|spicy|hot|chili|chilli)\\b", "gluten_free": "(glutenfrei|gluten free|gluten-free)",
    "contains_pork": "\\b(schwein|pork|bacon|speck|salami|schinken)", "alcohol": "\\b(bier|beer|wein|wine|vodka|whisky|rum|gin|sekt|prosecco)\\b",
    "drink": "\\b(getraenk|drinks?|cola|fanta|sprite|wasser|water|saft|juice|lassi|tee|tea|kaffee|coffee|ayran|borhani)",
}


def dishes_of(names: DataFrame, dish_map: DataFrame) -> DataFrame:
    """(name_folded, dish_id, dish_pattern): the dish of each name, that of the lowest priority, then the longest pattern.

    A pattern of up to four letters is a whole run of words, a longer one begins a word. Names meet patterns by the first
    three letters of a word.
    """
    starts = names.select("name_folded").distinct().withColumn("_at", F.explode(F.sequence(F.lit(1), F.greatest(F.length("name_folded"), F.lit(1)))))
    starts = starts.filter((F.col("_at") == 1) | ~F.expr("substring(name_folded, _at - 1, 1)").rlike("[a-z0-9_]")).withColumn("_rest", F.expr("substring(name_folded, _at)"))
    known = dish_map.select("dish_id", "pattern", "priority", F.substring("pattern", 1, 3).alias("_head"))
    after = F.expr("substring(_rest, length(pattern) + 1, 1)")
    found = starts.withColumn("_head", F.substring("_rest", 1, 3)).join(known, "_head")
    found = found.filter(F.expr("startswith(_rest, pattern)") & ((F.length("pattern") > 4) | ~after.rlike("[a-z0-9_]")))
    best = F.min_by(F.struct("dish_id", "pattern"), F.struct(F.col("priority").cast("int"), -F.length("pattern"), "dish_id", "pattern"))
    return found.groupBy("name_folded").agg(best.alias("d")).select("name_folded", "d.dish_id", F.col("d.pattern").alias("dish_pattern"))


@model
def offering(int_offering_observation: DataFrame, dish_map: DataFrame) -> DataFrame:
    """One menu item as it is now, with its dish and its flags."""
    o = int_offering_observation
    fields = [c for c in o.columns if c not in ("offering_id", "observed_at")]
    now = o.groupBy("offering_id").agg(
        F.max_by(F.struct(*fields), F.struct("observed_at", "observation_id")).alias("now"), F.min("observed_at").alias("first_seen_at"), F.max("observed_at").alias("last_seen_at"), F.count(F.lit(1)).alias("observations")
    )
    now = now.select("offering_id", "now.*", "first_seen_at", "last_seen_at", "observations")
    text = clean.fold(F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in ("name", "description", "category", "dietary_tags")]))
    flags = clean.attribute_flags(F.col("_t"), OFFERING_FLAGS)
    strong = F.coalesce(F.col("alcohol_permille") > 0, F.lit(False))
    out = now.withColumn("_t", text).withColumn("attributes", flags).withColumn("attributes", F.col("attributes").withField("alcohol", F.col("attributes.alcohol") | strong))
    out = out.withColumn("unavailable_at_last_seen", F.coalesce("unavailable", F.lit(False))).drop("_t", "unavailable", "run_id", "observation_id")
    return out.join(dishes_of(out, dish_map), "name_folded", "left")


@model
def offering_price_snapshot(int_offering_observation: DataFrame) -> DataFrame:
    """Menu item x observation with its prices; what can't be a price is marked, not dropped."""
    same = ["offering_id", "listing_id", "platform", "run_id", "price", "original_price", "price_max"]
    s = int_offering_observation.filter("price is not null").groupBy(*same).agg(F.min_by(F.struct("observed_at", "deposit", "currency", "size_variants"), "observed_at").alias("r")).select(*same, "r.*")
    typical = s.groupBy("listing_id").agg(F.median("price").alias("listing_median"))
    price, typically = F.col("price"), F.col("listing_median")
    # Prices that stand for none
    reason = (
        F.when(price.isin(*[F.lit(x).cast("decimal(10,2)") for x in ("999", "999.99", "9999", "9999.99", "99999")]), "placeholder_price")
        .when((price > 20 * typically) & (price > 60), "far_above_listing_median")
        .when(price > 500, "above_500_eur")
        .when(price == 0, "zero_price")
    )
    discount = F.when(F.col("original_price") > price, F.round(1 - price / F.col("original_price"), 4))
    return s.join(typical, "listing_id").withColumn("discount_share", discount).withColumn("outlier_reason", reason)


@model
def review(stg_lieferando__review: DataFrame) -> DataFrame:
    """One review; its writer is a salted hash."""
    norm = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col("rating_value") - 1) / (F.col("rating_scale_max") - 1))).cast("decimal(6,4)")
    return stg_lieferando__review.select(
        key_id("lieferando", F.col("review_platform_id")).alias("review_id"), key_id("lieferando", F.col("platform_id")).alias("listing_id"), F.lit("lieferando").alias("platform"), "review_platform_id", "reviewer_hash",
        "posted_at", "rating_value", F.lit(1.0).alias("rating_scale_min"), "rating_scale_max", F.when(F.col("rating_value").isNotNull(), norm).alias("rating_norm"), "text", "owner_reply",
        F.col("owner_reply").isNotNull().alias("has_owner_reply"), F.length("text").alias("text_length"), F.col("fetched_at").alias("observed_at"),
    )


@model
def review_language(review: DataFrame, text_language: DataFrame) -> DataFrame:
    """The language of each review that has one."""
    found = text_language.filter("text_kind = 'review'").select(F.col("text_id").alias("review_id"), "lang", "confidence")
    return review.select("review_id").join(found, "review_id")


@model
def site(stg_web__page: DataFrame, business: DataFrame) -> DataFrame:
    """One website: whose it is, what kind it is and how its crawl went."""
    own = business.filter("website_domain is not null").groupBy(F.col("website_domain").alias("domain")).agg(F.max_by("business_id", F.struct("listing_count", "business_id")).alias("business_id"))
    both = own.join(stg_web__page.withColumn("_page", F.lit(1)), "domain", "full")
    kind = F.when(F.col("business_id").isNotNull(), "restaurant").when(F.max("site_kind") == "media", "media").otherwise("other")
    return both.groupBy("domain", "business_id").agg(
        kind.alias("kind"), F.count("_page").alias("pages_crawled"), F.count_if(F.col("status").between(200, 299)).alias("pages_ok"), F.bool_or("blocked_by_robots").alias("robots_blocked"),
        F.bool_and(F.col("error").isNotNull()).alias("unreachable"), F.max("fetched_at").alias("last_crawled_at"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("ordering_providers")))).alias("ordering_providers"),
    )


@model
def web_page(stg_web__page: DataFrame) -> DataFrame:
    """One version of one page; reads that find the same content make no new one."""
    read = stg_web__page.filter(F.col("status").between(200, 299) & F.col("main_text").isNotNull())
    before = F.lag("content_sha256").over(Window.partitionBy("url_canonical").orderBy("fetched_at", "observation_id"))
    names = ["url_canonical", "final_url", "domain", "site_kind", "seed_business_id", "title", "meta_description", "main_text", "main_text_length", "lang_attr", "jsonld", "opengraph", "social_links", "ordering_providers", "emails", "phones"]
    changed = read.withColumn("_before", before).filter(~F.col("content_sha256").eqNullSafe(F.col("_before")))
    return changed.select(key_id(F.col("url_canonical"), F.col("content_sha256")).alias("page_version_id"), *names, F.col("fetched_at").alias("valid_from"), "content_sha256")


@model
def mention(web_page: DataFrame, text_mention: DataFrame) -> DataFrame:
    """A business mentioned on a page version."""
    pages = web_page.select("page_version_id", "url_canonical", "domain", F.col("valid_from").alias("observed_at"))
    return text_mention.join(pages, "page_version_id").select(
        clean.uuid_of(F.concat("page_version_id", "business_id")).alias("mention_id"), "page_version_id", "url_canonical", "domain", "business_id", "matched_name", "snippet", F.lit(None).cast("double").alias("sentiment"), "observed_at", "matcher"
    )


@model
def social_account(stg_instagram__account: DataFrame, stg_tiktok__profile: DataFrame, social_assignment: DataFrame) -> DataFrame:
    """One account as it is now, with the business that it was found to belong to."""
    names = ["handle", "platform_account_id", "display_name", "bio", "website", "is_business", "profile_image_url", "fetched_at"]
    ig = latest_of(stg_instagram__account, ["handle"]).withColumn("platform", F.lit("instagram"))
    tt = latest_of(stg_tiktok__profile, ["handle"]).withColumn("platform", F.lit("tiktok")).withColumn("is_business", F.col("exists"))
    tt = tt.withColumn("website", F.lit(None).cast("string")).withColumn("profile_image_url", F.lit(None).cast("string"))
    both = ig.select("platform", *names).unionByName(tt.select("platform", *names)).withColumn("account_key", F.concat_ws(":", "platform", "handle"))
    links = social_assignment.select("account_key", "business_id", F.col("decision").alias("link_decision"), F.col("score").alias("link_score"))
    return both.join(links, "account_key", "left").withColumn("account_id", key_id(F.col("platform"), F.col("handle"))).drop("account_key")


@model
def social_account_snapshot(stg_instagram__account: DataFrame, stg_tiktok__profile: DataFrame) -> DataFrame:
    """Account x observation: its numbers."""
    ig = stg_instagram__account.filter("followers is not null").select(key_id("instagram", F.col("handle")).alias("account_id"), F.lit("instagram").alias("platform"), F.col("fetched_at").alias("observed_at"), "followers", "following", "post_count")
    tt = stg_tiktok__profile.filter("exists").select(
        key_id("tiktok", F.col("handle")).alias("account_id"), F.lit("tiktok").alias("platform"), F.col("fetched_at").alias("observed_at"), "followers", F.lit(None).cast("bigint").alias("following"), F.col("videos_listed").cast("bigint").alias("post_count")
    )
    return ig.unionByName(tt)


@model
def social_link_candidate(stg_web__page: DataFrame, stg_osm__poi: DataFrame, stg_overture__place: DataFrame, business_assignment: DataFrame) -> DataFrame:
    """Business x account that some evidence proposes; an account that many businesses claim is nobody's."""
    names = ["business_id", "platform", "handle", "evidence", "evidence_ref"]
    web = stg_web__page.filter("site_kind = 'business' and seed_business_id is not null").select(
        F.col("seed_business_id").alias("business_id"), F.explode(F.from_json("social_links", "map<string,array<string>>")).alias("platform", "handles"), F.lit("own_website").alias("evidence"), F.col("url_canonical").alias("evidence_ref")
    )
    web = web.withColumn("handle", F.explode("handles")).withColumn("handle", F.lower("handle")).select(names)
    owner = business_assignment.select("business_id", "listing_key")

    def tagged(rows: DataFrame, source: str, platform: Column, handle: Column, evidence: str) -> DataFrame:
        out = rows.withColumn("listing_key", F.concat(F.lit(f"{source}:"), "platform_id")).join(owner, "listing_key")
        return out.withColumns({"platform": platform, "handle": handle, "evidence": F.lit(evidence), "evidence_ref": F.col("platform_id")}).select(names)

    parts = [tagged(stg_osm__poi.filter(f"{host} is not null"), "osm", F.lit(host), clean.social_handle(F.col(host), host), "osm_tag") for host in ("instagram", "facebook")]
    s = stg_overture__place.withColumn("_s", F.explode("socials"))
    kind = F.when(F.col("_s").contains("facebook"), "facebook").when(F.col("_s").contains("instagram"), "instagram").otherwise("other")
    parts.append(tagged(s, "overture", kind, clean.social_handle(F.col("_s"), "(facebook|instagram)"), "overture_socials"))
    both = web
    for part in parts:
        both = both.unionByName(part)
    found = both.filter(F.col("handle").rlike("^[a-z0-9_.\\-]{2,60}$")).groupBy("business_id", "platform", "handle").agg(
        F.sort_array(F.collect_set("evidence")).alias("evidence"), F.count(F.lit(1)).alias("evidence_count"), F.min("evidence_ref").alias("example_ref")
    )
    return found.withColumn("businesses_claiming", F.count(F.lit(1)).over(Window.partitionBy("platform", "handle")))


WORD = "[a-zA-Z0-9_äöüßÄÖÜ]"


def found_in(text: Column, pattern: str) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(pattern), 1), F.lower)


POST_KINDS = {"handle": "string", "title": "string", "caption": "string", "posted_at": "timestamp", "post_type": "string", "duration_s": "int", "audio_title": "string", "permalink": "string", "thumbnail_url": "string", "fetched_at": "timestamp", "context": "string", "tags": "array<string>", "declared_language": "string", "category": "string", "observation_id": "string"}


@model
def post(stg_instagram__media: DataFrame, stg_tiktok__video: DataFrame, stg_reddit__post: DataFrame, stg_youtube__video: DataFrame) -> DataFrame:
    """One post with what doesn't change about it; of several reads one with text, then the newest."""

    def shaped(rows: DataFrame, platform: str, **given: Column) -> DataFrame:
        found = [given.get(c, F.col(c) if c in rows.columns else F.lit(None)).cast(t).alias(c) for c, t in POST_KINDS.items()]
        return rows.select(F.lit(platform).alias("platform"), "post_platform_id", *found)

    short = F.when(F.col("duration_s") <= 180, "short_or_clip").otherwise("video")
    both = (
        shaped(stg_instagram__media, "instagram", context=F.col("handle"))
        .unionByName(shaped(stg_tiktok__video, "tiktok", context=F.col("handle"), post_type=F.lit("video")))
        .unionByName(shaped(stg_reddit__post, "reddit", handle=F.lit(None), caption=F.col("selftext"), context=F.concat(F.lit("r/"), "subreddit"), category=F.col("flair")))
        .unionByName(shaped(stg_youtube__video, "youtube", handle=F.col("channel_id"), caption=F.col("description"), post_type=short, context=F.col("channel_title"), category=F.col("category_id")))
    )
    one = latest_of(both, ["platform", "post_platform_id"], F.coalesce("caption", "title").isNull())
    text, caption = F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("caption", F.lit(""))), F.coalesce("caption", F.lit(""))
    # The blocks whose characters count as emojis
    emojis = F.regexp_extract_all(text, F.lit("([\\x{1F300}-\\x{1FAFF}☀-➿])"), 1)
    return one.withColumns({
        "post_id": key_id(F.col("platform"), F.col("post_platform_id")), "account_id": F.when(F.col("handle").isNotNull(), key_id(F.col("platform"), F.lower("handle"))),
        "hashtags": found_in(text, f"#({WORD}+)"), "mentions": found_in(caption, "@([a-zA-Z0-9_.]+)"), "emojis": emojis, "caption_length": F.length("caption"), "title_length": F.length("title"),
    }).drop("observation_id", "fetched_at")


@model
def post_metrics_snapshot(stg_instagram__media: DataFrame, stg_tiktok__video: DataFrame, stg_reddit__post: DataFrame, stg_youtube__video: DataFrame) -> DataFrame:
    """Post x observation: its numbers and its age at that time. A score counts as likes."""
    numbers = ["likes", "comments", "views", "shares", "saves"]

    def shaped(rows: DataFrame, platform: str, at: str, **given: str) -> DataFrame:
        found = [(F.col(given.get(c, c)) if given.get(c, c) in rows.columns else F.lit(None)).cast("bigint").alias(c) for c in numbers]
        return rows.select(F.lit(platform).alias("platform"), "post_platform_id", F.col(at).alias("observed_at"), *found, "posted_at", "observation_id", "fetched_at")

    both = (
        shaped(stg_instagram__media, "instagram", "fetched_at").unionByName(shaped(stg_tiktok__video, "tiktok", "fetched_at"))
        .unionByName(shaped(stg_reddit__post, "reddit", "metrics_at", likes="score", shares="crossposts")).unionByName(shaped(stg_youtube__video, "youtube", "fetched_at"))
    )
    one = latest_of(both, ["platform", "post_platform_id", "observed_at"], F.col("views").isNull())
    hours = F.round((F.unix_micros("observed_at") - F.unix_micros("posted_at")) / 3.6e9, 1)
    hidden = F.col("likes").isNull() & F.col("platform").isin("instagram", "youtube")
    return one.select(key_id(F.col("platform"), F.col("post_platform_id")).alias("post_id"), "platform", "observed_at", *numbers, hidden.alias("likes_hidden"), hours.alias("post_age_hours"))


@model
def content_tag(text_tag: DataFrame, post: DataFrame) -> DataFrame:
    """Tags of the posts that there are."""
    tags = text_tag.filter("text_kind = 'post'").select(F.col("text_id").alias("post_id"), "tag_type", "tag_id", "matched", "matcher", "tagged_at")
    return tags.join(post.select("post_id"), "post_id", "left_semi")


@model
def hashtag_observation(stg_instagram__media: DataFrame) -> DataFrame:
    """Hashtag x post x rank x observation of hashtag searches."""
    rank = F.row_number().over(Window.partitionBy("via", "observation_id").orderBy(F.desc("posted_at"), "post_platform_id"))
    part = lambda k: F.split_part("via", F.lit(":"), F.lit(k))
    return stg_instagram__media.filter(F.col("via").startswith("hashtag:")).select(
        part(2).alias("hashtag"), part(3).alias("edge"), F.lit("instagram").alias("platform"), key_id("instagram", F.col("post_platform_id")).alias("post_id"), rank.alias("rank"), F.col("fetched_at").alias("observed_at")
    )


@model
def tenant_social_post(stg_first_party__own_post: DataFrame, stg_first_party__export: DataFrame, zone: str = "Europe/Berlin") -> DataFrame:
    """A tenant's own posts; the warehouse's copy goes before a delivered one."""
    names = ["tenant_id", "platform", "external_id", "posted_at", "content_type", "caption", "permalink"]
    both = stg_first_party__own_post.select(*names, F.lit(1).alias("_pref")).unionByName(stg_first_party__export.select(*names, F.lit(2).alias("_pref")))
    rest = ["posted_at", "content_type", "caption", "permalink"]
    one = both.groupBy("tenant_id", "platform", "external_id").agg(F.min_by(F.struct(*rest), F.struct("_pref", *rest)).alias("p")).select("tenant_id", "platform", "external_id", "p.*")
    local = F.from_utc_timestamp("posted_at", zone)
    return one.withColumns({
        "post_id": key_id(F.col("tenant_id"), F.col("platform"), F.col("external_id")), "content_type": F.coalesce("content_type", F.lit("unknown")), "caption_length": F.length("caption"),
        "hashtags": found_in(F.coalesce("caption", F.lit("")), f"#({WORD}+)"), "posted_weekday_berlin": F.weekday(local) + 1, "posted_hour_berlin": F.hour(local),
    })


@model
def tenant_social_metrics_snapshot(stg_first_party__own_post: DataFrame, stg_first_party__export: DataFrame) -> DataFrame:
    """Own post x time of reading; what a platform doesn't report is null."""
    numbers = ["impressions", "reach", "likes", "comments", "shares", "saves", "clicks"]
    kind = f"array<struct<captured_at:string,{','.join(f'{n}:bigint' for n in numbers)}>>"
    own = stg_first_party__own_post.select("tenant_id", "platform", "external_id", "posted_at", F.explode(F.from_json("snapshots", kind)).alias("s"))
    own = own.select("tenant_id", "platform", "external_id", "posted_at", F.try_to_timestamp("s.captured_at").alias("captured_at"), *[f"s.{n}" for n in numbers], F.lit("warehouse").alias("via"))
    sent = stg_first_party__export.select("tenant_id", "platform", "external_id", "posted_at", "captured_at", *[F.col(n).cast("bigint").alias(n) for n in numbers], F.lit("export").alias("via"))
    both = own.unionByName(sent).withColumn("post_id", key_id(F.col("tenant_id"), F.col("platform"), F.col("external_id"))).withColumn("_minute", F.date_trunc("minute", "captured_at"))
    w = Window.partitionBy("post_id", "_minute").orderBy(F.desc("via"), "captured_at")
    only = lambda c, where: F.when(where, F.col(c)).alias(c)
    p = F.col("platform")
    return both.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").select(
        "post_id", "tenant_id", "platform", "captured_at", only("reach", p != "threads"), only("impressions", p != "instagram"), "likes", "comments", "shares", "saves", only("clicks", p == "facebook"),
        F.round((F.unix_micros("captured_at") - F.unix_micros("posted_at")) / 3.6e9, 1).alias("post_age_hours"), "via",
    )


@model
def interest_daily(stg_wikipedia__pageviews: DataFrame) -> DataFrame:
    """Topic x day: views in all languages and in some."""
    groups = {"views_de": ["de"], "views_en": ["en"], "views_south_asian_langs": ["bn", "ur", "hi"], "views_ar_tr": ["ar", "tr"]}
    some = [F.sum(F.when(F.col("lang").isin(langs), F.col("views"))).alias(c) for c, langs in groups.items()]
    return stg_wikipedia__pageviews.groupBy("topic", "day").agg(F.sum("views").alias("views_all_languages"), *some)


@model
def osm_poi_history(stg_osm_history__element: DataFrame, extract_end: str = "2026-06-30") -> DataFrame:
    """One food place over its time on the map."""
    last = lambda c, alias: F.max_by(c, "valid_from").alias(alias)
    return stg_osm_history__element.groupBy("osm_id").agg(
        F.max("district").alias("district"), F.min("valid_from").alias("first_seen_on_map"), F.max("valid_to").alias("last_seen_on_map"), (F.max("valid_to") >= F.lit(extract_end).cast("date")).alias("on_map_at_extract_end"),
        F.count(F.lit(1)).alias("versions"), F.count_distinct("name").alias("distinct_names"), F.count_distinct("cuisine").alias("distinct_cuisines"), last("name", "latest_name"), last("cuisine", "latest_cuisine"),
        last("poi_type", "latest_type"), last("lat", "lat"), last("lon", "lon"),
    )


#: How the columns of a grid of statistics are brought to areas: rates by the people that live there, counts as sums.
RATE = "^(anteil|durchschn|auslaenderanteil)|quote$"
NOT_A_VALUE = "^werterlaeuternde"


def area_sums(cells: DataFrame, population: DataFrame, area: str) -> DataFrame:
    """Area x variable from grid cells (grid_id, an area column, variable, value)."""
    name = F.regexp_replace("variable", "^.*\\.", "")
    people = population.select("grid_id", F.col("population").alias("_people"))
    rows = cells.filter(F.col("value").isNotNull() & F.col(area).isNotNull() & ~name.rlike(NOT_A_VALUE)).join(people, "grid_id", "left").withColumn("_w", F.coalesce("_people", F.lit(0)))
    rows = rows.withColumn("aggregation", F.when(name.rlike(RATE), "weighted_mean").otherwise("sum"))
    mean = F.sum(F.col("value") * F.col("_w")) / F.nullif(F.sum("_w"), F.lit(0))
    value = F.when(F.col("aggregation") == "sum", F.sum("value")).otherwise(mean)
    return rows.groupBy(F.col(area).alias("area_id"), "variable", "aggregation").agg(value.alias("value"), F.count(F.lit(1)).alias("source_cells"))


@model
def area_stat(grid_value: DataFrame, grid_population: DataFrame, market_cell: DataFrame, reference_date: str = "2022-05-15") -> DataFrame:
    """Cell of the market x variable, from statistics on a finer grid."""
    rows = grid_value.join(market_cell.select("cell"), "cell", "left_semi")
    return area_sums(rows, grid_population, "cell").withColumn("area_type", F.lit("cell")).withColumn("reference_date", F.lit(reference_date).cast("date"))


@model
def area_stat_lor(grid_value: DataFrame, grid_population: DataFrame, geo_area: DataFrame, reference_date: str = "2022-05-15") -> DataFrame:
    """Planning area x variable, from statistics on a grid, by the point of each grid cell."""
    around = geo.covering_areas(grid_population, geo_area.filter("kind = 'planning_area'"))
    named = grid_population.join(around, ["lat", "lon"]).select("grid_id", F.col("areas")["planning_area"]["code"].alias("_code"))
    rows = area_sums(grid_value.join(named, "grid_id"), grid_population, "_code")
    return rows.withColumn("area_type", F.lit("lor_planning_area")).withColumn("reference_date", F.lit(reference_date).cast("date"))


@model
def community_audience(stg_afs__citizenship: DataFrame, stg_afs__origin_area: DataFrame, community: DataFrame) -> DataFrame:
    """Community x area: residents by citizenship in the whole city, by origin in districts and planning areas."""
    listed = lambda c: F.explode(F.split(F.nullif(F.col(c), F.lit("")), "\\|"))
    cit = stg_afs__citizenship.filter("not is_aggregate").join(community.select("community_id", listed("afs_citizenship").alias("citizenship")), "citizenship")
    cit = cit.groupBy("reference_date", "community_id").agg(F.sum("residents").cast("int").alias("residents"))
    cit = cit.select("reference_date", "community_id", F.lit("berlin_citizens").alias("level"), F.lit("11").alias("area_code"), "residents", F.lit(None).cast("double").alias("share"))
    o = stg_afs__origin_area.filter("person_group = 'insgesamt' and sex = 'insgesamt'").withColumn("area_code", F.coalesce("lor_code", "district_code"))
    total = o.filter("origin_code = 'ALL'").select("reference_date", "level", "area_code", F.col("residents").alias("_total"))
    mh = o.join(community.select("community_id", listed("afs_origin").alias("origin_code")), "origin_code").groupBy("reference_date", "community_id", "level", "area_code").agg(F.sum("residents").alias("residents"))
    mh = mh.join(total, ["reference_date", "level", "area_code"])
    level = F.when(F.col("level") == "lor", "lor_mh").otherwise("district_mh")
    return cit.unionByName(mh.select("reference_date", "community_id", level.alias("level"), "area_code", F.col("residents").cast("int").alias("residents"), (F.col("residents") / F.nullif("_total", F.lit(0))).alias("share")))


@model
def occasion_day(stg_occasions__calendar: DataFrame, occasion_type: DataFrame, community_greeting: DataFrame, sun_times: DataFrame) -> DataFrame:
    """Day x community x occasion with its meaning, the greeting to use, and the times of fasting days."""
    fasting = ["ramadan_period", "iftar_season_peak", "laylat_al_qadr"]
    cal = stg_occasions__calendar.filter("occasion_type <> 'other'").groupBy("day", "community_id", "occasion_type").agg(
        F.sort_array(F.collect_set("holiday_name")).alias("holiday_names"), F.sort_array(F.collect_set("holiday_name_native")).alias("holiday_names_native"), F.sort_array(F.collect_set("country")).alias("countries"),
        F.bool_or("is_estimated").alias("is_estimated"), F.min("source").alias("source"), F.max("calendar_version").alias("calendar_version"),
    )
    meaning = occasion_type.select("occasion_type", "food_role", "tone", F.col("lead_days").cast("int").alias("lead_days"))
    cal = cal.join(meaning, "occasion_type", "left").withColumn("content_window_start", F.date_sub("day", F.col("lead_days")))
    own = community_greeting.filter("greeting_key = 'orthodox_christmas'").select("community_id", F.lit(True).alias("_own")).distinct()
    cal = cal.join(own, "community_id", "left")
    key = F.when(F.col("occasion_type").isin(fasting), "ramadan").when((F.col("occasion_type") == "orthodox_christmas") & F.col("_own").isNull(), "christmas").otherwise(F.col("occasion_type"))
    greet = community_greeting.select("community_id", "greeting_key", F.col("text").alias("greeting"), F.col("translit").alias("greeting_translit"), F.col("needs_review").alias("greeting_needs_review"))
    out = cal.withColumn("greeting_key", key).join(greet, ["community_id", "greeting_key"], "left").drop("greeting_key", "_own")
    sun = sun_times.select("day", F.col("sunset").alias("_sunset"), F.col("dawn_18").alias("_dawn"))
    fasts = F.col("occasion_type").isin(*fasting, "ramadan")
    out = out.join(sun, "day", "left").withColumn("iftar_at", F.when(fasts, F.col("_sunset"))).withColumn("suhoor_ends_at", F.when(fasts, F.col("_dawn")))
    return out.drop("_sunset", "_dawn")

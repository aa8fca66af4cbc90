"""The typed views of each source. Adding a source means adding a table of fields."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import clean
from ..sources.staging import duration_seconds
from .catalog import model
from .typed import View, at, items, json_at, latest_of, records, typed

# The names of sources and entities, the columns of the typed views, and where the sources' records have them.
VIEWS = {
    "stg_wolt__venue_listing": View("wolt", "venue_listing", """
        name clean venue.name
        slug text venue.slug
        address_line clean venue.address
        city text venue.city
        lat double venue.location[1]
        lon double venue.location[0]
        price_range int venue.price_range
        rating_value rating venue.rating.score
        rating_count int venue.rating.volume
        franchise filled venue.franchise
        tags texts venue.tags
        product_line text venue.product_line
        short_description clean venue.short_description
        logo_url text venue.brand_image.url
        cover_image_url text image.url
        """, keys={"platform_id": "natural_key"}),
    "stg_wolt__venue_static": View("wolt", "venue_static", """
        name clean venue.name
        description clean venue.description
        address_line clean venue.address
        postcode filled venue.post_code
        city text venue.city
        lat double venue.lat
        lon double venue.lon
        phone phone venue.phone
        website url venue.website
        share_url text venue.share_url
        brand_name clean brand.name
        legal_name clean merchant.name
        vat_number code merchant.vat
        price_range int venue.price_range
        rating_value rating venue.rating.score
        rating_count int venue.rating.volume
        order_minimum cents order_minimum
        delivery_base_fee cents delivery_specs.base_price
        food_tags texts venue.food_tags
        """, keys={"slug": "natural_key", "platform_id": "meta.venue_id"}),
    "stg_wolt__venue_dynamic": View("wolt", "venue_dynamic", """
        order_minimum cents venue.order_minimum
        delivery_estimate_min int venue.delivery_open_status.estimate
        open_status text venue.open_status.status
        online bool venue.online
        """, keys={"slug": "natural_key", "platform_id": "meta.venue_id"}),
    "stg_wolt__coverage": View("wolt", "coverage", """
        point_lat double ^lat
        point_lon double ^lon
        platform_id text venue_id
        section text section
        delivers bool venue.delivers
        online bool venue.online
        delivery_estimate_min int venue.estimate
        delivery_estimate_range text venue.estimate_range
        promotions json venue.promotions
        badges json venue.badges_v2 venue.badges
        wolt_plus bool venue.show_wolt_plus
        sortables json sorting.sortables
        """, spread=["venues"], rank="list_position", keys={"cell": "natural_key"}),
    "stg_lieferando__coverage": View("lieferando", "coverage", """
        point_lat double ^metaData.location.coordinates[1]
        point_lon double ^metaData.location.coordinates[0]
        platform_id text id
        display_rank int defaultDisplayRank
        promoted texts ^promotedPlacement.rankedIds
        open_now_delivery bool isOpenNowForDelivery
        open_now_collection bool isOpenNowForCollection
        temporarily_offline bool isTemporarilyOffline
        delivery_fee money deliveryCost
        order_minimum money minimumDeliveryValue
        eta_min_lower int deliveryEtaMinutes.rangeLower
        eta_min_upper int deliveryEtaMinutes.rangeUpper
        distance_m int driveDistanceMeters
        is_premier bool isPremier
        deals json deals
        """, spread=["restaurants"], rank="list_position", keys={"postcode": "natural_key"}),
    "stg_lieferando__restaurant_listing": View("lieferando", "restaurant_listing", """
        name clean name
        slug text uniqueName
        address_line clean address.firstLine
        postcode text address.postalCode
        city text address.city
        lat double address.location.coordinates[1]
        lon double address.location.coordinates[0]
        rating_value rating rating.starRating
        rating_count int rating.count
        is_new bool isNew
        offers_delivery bool isDelivery
        offers_collection bool isCollection
        is_test bool isTestRestaurant
        cuisines json cuisines
        logo_url text logoUrl
        """, keys={"platform_id": "natural_key"}),
    "stg_lieferando__manifest": View("lieferando", "menu_manifest", """
        platform_id text RestaurantId
        menu_version text MenuVersion
        menu_published_at time MessageSentTimestamp
        name clean RestaurantInfo.Name
        description clean RestaurantInfo.Description
        address_line clean RestaurantInfo.Location.Address
        postcode text RestaurantInfo.Location.PostCode
        city text RestaurantInfo.Location.City
        lat double RestaurantInfo.Location.Latitude
        lon double RestaurantInfo.Location.Longitude
        phone_raw filled RestaurantInfo.AllergenPhoneNumber
        phone phone RestaurantInfo.AllergenPhoneNumber
        legal_name clean RestaurantInfo.Colophon.RestaurantName
        legal_representative clean RestaurantInfo.Colophon.LegalRepresentative
        vat_number code RestaurantInfo.Colophon.VatNumber
        legal_street clean RestaurantInfo.Colophon.LegalAddress.Address
        legal_postcode text RestaurantInfo.Colophon.LegalAddress.PostCode
        legal_city text RestaurantInfo.Colophon.LegalAddress.City
        is_halal bool RestaurantInfo.IsHalal
        storefront_type text RestaurantInfo.StoreFrontType
        new_until time RestaurantInfo.NewUntilDate
        is_offline bool RestaurantInfo.IsOffline
        cuisines json RestaurantInfo.CuisineTypes
        opening_times json RestaurantInfo.RestaurantOpeningTimes
        logo_url text RestaurantInfo.LogoUrl
        share_url text RestaurantInfo.ShareableLink
        """, keys={"slug": "natural_key"}),
    "stg_lieferando__review": View("lieferando", "reviews", """
        review_platform_id text reviewId
        reviewer_hash text customerName
        posted_at time rateDate
        rating_value rating ratingAverage
        rating_scale_max rating maxRating
        text clean customerComments
        owner_reply clean restaurantComments
        """, spread=["reviews"], keys={"platform_id": "meta.restaurant_id"}, latest=["review_platform_id"]),
    "stg_google_maps__search_result": View("google_maps", "search_page", """
        query text ^query
        cell text ^cell
        point_lat double ^lat
        point_lon double ^lon
        viewport_m int ^viewport_m
        platform_id text fid
        rank int rank
        """, spread=["results"]),
    "stg_google_maps__place": View("google_maps", "place", """
        google_place_id text entry[78]
        kg_mid text entry[89]
        name clean entry[11]
        address_full clean entry[39]
        address_line clean entry[2][0]
        postcode postcode entry[2][1]
        city filled entry[166]
        neighbourhood filled entry[14]
        lat double entry[9][2]
        lon double entry[9][3]
        rating_value rating entry[4][7]
        rating_count int entry[4][8]
        price_band filled entry[4][2]
        categories texts entry[13]
        primary_category filled entry[13][0]
        website url entry[7][0]
        phone_raw text entry[178][0][0]
        phone phone entry[178][0][3]
        short_description clean entry[32][0][1]
        description clean entry[32][1][1]
        owner_name clean entry[57][1]
        timezone text entry[30]
        opening_hours json entry[203]
        result_type text entry[88][1]
        image_url text entry[157]
        """, keys={"platform_id": "natural_key"}),
    "stg_osm_history__element": View("osm_history", "element_history", """
        osm_id text properties['@osmId']
        valid_from time properties['@validFrom']
        valid_to time properties['@validTo']
        osm_version int properties['@version']
        name text properties.name
        poi_type text properties.amenity properties.shop
        cuisine text properties.cuisine
        lat double geometry.coordinates[1]
        lon double geometry.coordinates[0]
        """, spread=["features"], keys={"district": "natural_key"}, newest_payload=True),
    "stg_osm_history__monthly": View("osm_history", "monthly_counts", """
        month time timestamp
        poi_count int value
        """, spread=["groupByResult", "result"], keys={"district": "natural_key"}, newest_payload=True),
    "stg_wikipedia__pageviews": View("wikipedia", "pageviews", """
        topic text ^seed
        lang text ^lang
        project text ^project
        article text ^title
        day day8 timestamp
        views int views
        """, spread=["items"], newest_payload=True),
    "stg_berlin_events__event": View("berlin_events", "feed", """
        event_id text id
        name clean bezeichnung
        district text bezirk
        address clean strasse
        postcode text plz
        starts_on day von
        ends_on day bis
        opening_times clean zeit
        organiser clean veranstalter
        website url www
        description clean bemerkungen
        """, spread=["index"], keys={"feed": "natural_key"}),
    "stg_first_party__own_post": View("first_party", "own_post", """
        tenant_id text tenant_id
        platform text platform
        external_id text external_id
        posted_at time posted_at
        content_type text content_type
        caption clean caption
        permalink text permalink
        snapshots json snapshots
        """, newest_payload=True),
    "stg_instagram__account": View("instagram_graph", "account", """
        not_business bool not_business
        platform_account_id text id
        display_name text name
        bio clean biography
        website url website
        followers long followers_count
        following long follows_count
        post_count long media_count
        profile_image_url text profile_picture_url
        """, ok_only=False, keys={"handle": "natural_key", "seed_business_id": "meta.business_id"}),
    "stg_tiktok__profile": View("tiktok", "profile", """
        exists bool exists
        discovered_via text via
        seed_business_id text business_id
        platform_account_id text channel_id
        display_name text uploader
        bio clean description
        followers long channel_follower_count
        videos_listed size videos
        videos json videos
        """, ok_only=False, keys={"handle": "natural_key"}),
    "stg_uber_eats__store": View("uber_eats", "store", """
        name clean title
        share_url text url
        address_full clean formattedAddress location.address address
        postcode postcode formattedAddress address
        lat double latitude location.latitude lat
        lon double longitude location.longitude lng lon
        rating_value digits ratingValue rating.ratingValue
        rating_count digits ratingCount reviewCount rating.reviewCount
        price_range price_level priceBucket
        eta_text text etaText
        cuisines json cuisineSlugs cuisines categories tags
        """, keys={"platform_id": "natural_key"}),
    "stg_web__page": View("web_crawl", "web_page", """
        url text url
        final_url text final_url
        status int status
        site_kind text kind
        site text site
        domain domain final_url
        seed_business_id text business_id
        depth int depth
        blocked_by_robots bool blocked_by_robots
        error text error
        title clean meta.title
        meta_description clean meta.description
        main_text clean main_text
        main_text_raw text main_text
        lang_attr text lang_attr meta.language
        jsonld json structured['json-ld']
        opengraph json structured.opengraph
        social_links json social_links
        ordering_providers texts ordering_providers
        emails texts emails
        phones texts phones
        outgoing_link_count size outgoing_links
        """, ok_only=False, keys={"url_canonical": "natural_key", "content_sha256": "payload_sha256"}),
    "stg_youtube__channel": View("youtube", "channels", """
        channel_id text id
        title clean snippet.title
        description clean snippet.description
        country text snippet.country
        created_at time snippet.publishedAt
        subscribers long statistics.subscriberCount
        video_count long statistics.videoCount
        views long statistics.viewCount
        """, spread=["items"]),
    "stg_youtube__comment": View("youtube", "comments", """
        comment_id text id
        post_platform_id text snippet.videoId
        text clean snippet.topLevelComment.snippet.textOriginal
        likes int snippet.topLevelComment.snippet.likeCount
        posted_at time snippet.topLevelComment.snippet.publishedAt
        """, spread=["items"]),
    "stg_youtube__search_hit": View("youtube", "search_page", """
        query text ^query
        post_platform_id text id.videoId
        """, spread=["items"], rank="rank"),
    "stg_youtube__video": View("youtube", "videos", """
        post_platform_id text id
        channel_id text snippet.channelId
        channel_title text snippet.channelTitle
        title clean snippet.title
        description clean snippet.description
        posted_at time snippet.publishedAt
        tags texts snippet.tags
        declared_language text snippet.defaultAudioLanguage snippet.defaultLanguage
        category_id text snippet.categoryId
        duration text contentDetails.duration
        thumbnail_url text snippet.thumbnails.high.url
        views long statistics.viewCount
        likes long statistics.likeCount
        comments long statistics.commentCount
        """, spread=["items"]),
}


def _plain(name: str):
    def view(observations: DataFrame, payloads: DataFrame) -> DataFrame:
        return typed(records(observations, payloads, VIEWS[name]), VIEWS[name])

    view.__name__, view.__doc__ = name, f"The typed view of {VIEWS[name].entity} records."
    return view


#: Views that need more than their fields; they are made below.
_MORE = {
    "stg_wolt__coverage", "stg_lieferando__coverage", "stg_google_maps__place", "stg_osm_history__monthly", "stg_berlin_events__event",
    "stg_instagram__account", "stg_uber_eats__store", "stg_web__page", "stg_youtube__video",
}
for _name in VIEWS:
    if _name not in _MORE:
        model(_plain(_name))


def _view(name: str, observations: DataFrame, payloads: DataFrame) -> DataFrame:
    return _plain(name)(observations, payloads)


@model
def stg_wolt__coverage(observations: DataFrame, payloads: DataFrame) -> DataFrame:
    """Venue x cell x observation, with its places in the sort orders by their names."""
    rows = _view("stg_wolt__coverage", observations, payloads)
    orders = F.from_json("sortables", "array<struct<id:string,value:int>>")
    rank = lambda name: F.get(F.filter(orders, lambda s: s["id"] == name), F.lit(0))["value"]
    named = {"delivery_price_rank": "delivery-price", "rating_rank": "rating", "distance_rank": "distance", "preparation_rank": "preparation-estimate"}
    return rows.withColumns({c: rank(n) for c, n in named.items()}).drop("sortables")


@model
def stg_lieferando__coverage(observations: DataFrame, payloads: DataFrame) -> DataFrame:
    """Restaurant x postcode x observation, with its place among the promoted ones."""
    rows = _view("stg_lieferando__coverage", observations, payloads)
    return rows.withColumn("promoted_rank", F.nullif(F.array_position("promoted", F.col("platform_id")), F.lit(0)).cast("int")).drop("promoted")


@model
def stg_google_maps__place(observations: DataFrame, payloads: DataFrame) -> DataFrame:
    """Place x observation; a notice of closing anywhere in the record sets its status."""
    notice = payloads.select("payload_sha256", F.col("payload").alias("_text"))
    rows = _view("stg_google_maps__place", observations, payloads).join(observations.select("observation_id", "payload_sha256"), "observation_id").join(notice, "payload_sha256")
    text = F.col("_text")
    status = F.when(text.rlike("Dauerhaft geschlossen|Permanently closed"), "closed_permanently").when(text.rlike("Vorübergehend geschlossen|Temporarily closed"), "closed_temporarily")
    return rows.withColumn("business_status", status.otherwise("operational")).drop("_text", "payload_sha256")


@model
def stg_osm_history__monthly(observations: DataFrame, payloads: DataFrame) -> DataFrame:
    """District x cuisine x month. The cuisine stands one list above the months."""
    view = VIEWS["stg_osm_history__monthly"]
    groups = records(observations, payloads, View(view.source, view.entity, "", spread=view.spread[:1], newest_payload=True))
    rows = groups.select(F.col("natural_key").alias("district"), F.replace(at(F.col("item"), "groupByObject"), F.lit("cuisine="), F.lit("")).alias("cuisine_tag"), F.explode(items(F.col("item"), "result")).alias("r"))
    return rows.select("district", "cuisine_tag", F.to_date(F.try_to_timestamp(at(F.col("r"), "timestamp"))).alias("month"), at(F.col("r"), "value").try_cast("double").cast("int").alias("poi_count"))


@model
def stg_berlin_events__event(observations: DataFrame, payloads: DataFrame) -> DataFrame:
    """Event x observation; entries without a first day are headings."""
    return _view("stg_berlin_events__event", observations, payloads).filter("starts_on is not null")


@model
def stg_instagram__account(observations: DataFrame, payloads: DataFrame) -> DataFrame:
    """Account x observation, answers that there is no such business account included."""
    return _view("stg_instagram__account", observations, payloads).withColumn("is_business", ~F.coalesce("not_business", F.lit(False))).drop("not_business")


@model
def stg_uber_eats__store(observations: DataFrame, payloads: DataFrame) -> DataFrame:
    """Store x observation; the street is what stands before the first comma."""
    rows = _view("stg_uber_eats__store", observations, payloads)
    return rows.withColumn("address_line", clean.clean_text(F.split_part("address_full", F.lit(","), F.lit(1)))).withColumn("rating_count", F.col("rating_count").cast("int"))


@model
def stg_web__page(observations: DataFrame, payloads: DataFrame) -> DataFrame:
    """Page x observation."""
    rows = _view("stg_web__page", observations, payloads)
    return rows.withColumn("main_text_length", F.length("main_text_raw")).drop("main_text_raw")


@model
def stg_web__schema_org(stg_web__page: DataFrame) -> DataFrame:
    """The entities of linked data that pages carry."""
    e = F.col("entity")
    rows = stg_web__page.withColumn("entity", F.explode(items(F.try_parse_json("jsonld"), "")))
    named = {
        "schema_type": "['@type']", "name": "name", "telephone": "telephone", "street_address": "address.streetAddress", "postal_code": "address.postalCode", "serves_cuisine": "servesCuisine",
        "price_range": "priceRange", "rating_value": "aggregateRating.ratingValue", "review_count": "aggregateRating.reviewCount",
    }
    nested = {"has_menu": "hasMenu", "opening_hours": "openingHoursSpecification", "same_as": "sameAs"}
    return rows.select(
        "observation_id", "fetched_at", "url_canonical", "domain", "seed_business_id",
        *[at(e, p).alias(c) for c, p in named.items()], *[json_at(e, p).alias(c) for c, p in nested.items()],
    )


@model
def stg_youtube__video(observations: DataFrame, payloads: DataFrame) -> DataFrame:
    """Video x observation, with its length in seconds."""
    rows = _view("stg_youtube__video", observations, payloads)
    return rows.withColumn("duration_s", duration_seconds(F.col("duration"))).drop("duration")


@model
def stg_instagram__media(observations: DataFrame, payloads: DataFrame) -> DataFrame:
    """Media x observation x route: an account's own list, or a search for a hashtag."""
    fields = """
        username text username
        post_platform_id text id
        caption clean caption
        posted_at time timestamp
        product text media_product_type
        kind text media_type
        likes long like_count
        comments long comments_count
        permalink text permalink
        thumbnail_url text thumbnail_url media_url
        """
    own = View("instagram_graph", "media_page", f"owner text ^username\n{fields}", spread=["media"])
    found = View("instagram_graph", "hashtag_media", f"tag text ^hashtag\nedge text ^edge\n{fields}", spread=["data"])
    own_rows = typed(records(observations, payloads, own), own).withColumn("via", F.lit("business_discovery"))
    tag_rows = typed(records(observations, payloads, found), found).withColumn("via", F.concat_ws(":", F.lit("hashtag"), "tag", "edge")).withColumn("owner", F.lit(None).cast("string"))
    both = own_rows.unionByName(tag_rows.drop("tag", "edge"))
    kind = F.lower(F.concat(F.coalesce("product", F.lit("")), F.lit(":"), F.coalesce("kind", F.lit(""))))
    return both.withColumn("handle", F.coalesce("owner", "username")).withColumn("post_type", kind).drop("owner", "username", "product", "kind")


@model
def stg_tiktok__video(observations: DataFrame, payloads: DataFrame) -> DataFrame:
    """Video x observation, from profile lists and from pages of their own."""
    fields = """
        post_platform_id text id
        caption clean description title
        posted_at epoch timestamp
        duration_s int duration
        views long view_count
        likes long like_count
        comments long comment_count
        shares long repost_count
        saves long save_count
        audio_title text track music.title
        audio_artist text artist
        permalink text webpage_url
        thumbnail_url text thumbnail
        """
    listed = View("tiktok", "profile", fields, spread=["videos"], ok_only=False, keys={"handle": "natural_key"})
    detail = View("tiktok", "video", f"handle text handle\n{fields}")
    rows = [typed(records(observations, payloads, v), v).withColumn("via", F.lit(n)) for v, n in ((listed, "listing"), (detail, "detail"))]
    return rows[0].unionByName(rows[1]).filter("post_platform_id is not null")


@model
def stg_reddit__post(observations: DataFrame, payloads: DataFrame) -> DataFrame:
    """The newest state of each archived post; removed texts are null."""
    view = View("reddit_archive", "posts_page", """
        post_platform_id text id
        subreddit text subreddit
        subreddit_subscribers long subreddit_subscribers
        author_hash text author
        title clean title
        body text selftext
        selftext clean selftext
        flair clean link_flair_text
        posted_at epoch created_utc
        metrics_at epoch _meta.retrieved_2nd_on retrieved_on
        second_read text _meta.retrieved_2nd_on
        score long score
        comments long num_comments
        upvote_ratio double upvote_ratio
        crossposts int num_crossposts
        is_video bool is_video
        is_gallery bool is_gallery
        is_self bool is_self
        hint text post_hint
        place text domain
        link_domain host url
        path text permalink
        over_18 bool over_18
        """, spread=["posts"])  # fmt: skip
    rows = latest_of(typed(records(observations, payloads, view), view).filter("post_platform_id is not null"), ["post_platform_id"])
    kinds = [
        (F.col("is_video"), "video"), (F.col("is_gallery"), "gallery"), ((F.col("hint") == "image") | F.col("place").isin("i.redd.it", "i.imgur.com"), "image"), (F.col("is_self"), "text"),
        (F.col("place").rlike("(youtube\\.com|youtu\\.be|tiktok\\.com|v\\.redd\\.it|instagram\\.com)"), "video_link"),
    ]
    kind = F.lit("link")
    for condition, name in reversed(kinds):
        kind = F.when(condition, name).otherwise(kind)
    return rows.withColumns({
        "subreddit": F.lower("subreddit"), "selftext": F.when(~F.col("body").isin("[removed]", "[deleted]"), F.col("selftext")), "metrics_mature": F.col("second_read").isNotNull(), "post_type": kind,
        "permalink": F.concat(F.lit("https://www.reddit.com"), "path"),
    }).drop("body", "second_read", "is_video", "is_gallery", "is_self", "hint", "place", "path")


@model
def stg_wolt__menu_item(observations: DataFrame, payloads: DataFrame) -> DataFrame:
    """Menu item x observation, with the first category that lists it; prices come in cents."""
    view = View("wolt", "menu", """
        offering_platform_id text id
        name clean name
        description clean description
        price cents price
        original_price cents original_price
        deposit cents deposit.amount
        dietary_tags json dietary_preferences
        alcohol_permille int alcohol_permille
        option_group_count size options
        image_url text images[0].url
        disabled json disabled_info
        """, spread=["items"], rank="position", keys={"platform_id": "meta.venue_id", "slug": "natural_key"})  # fmt: skip
    rows = typed(records(observations, payloads, view), view)
    menus = records(observations, payloads, View("wolt", "menu", "", spread=["categories"]))
    listed = menus.select("observation_id", F.col("rank").alias("_place"), at(F.col("item"), "name").alias("_category"), F.explode(texts_of(F.col("item"), "item_ids")).alias("offering_platform_id"))
    first = listed.groupBy("observation_id", "offering_platform_id").agg(F.min_by("_category", "_place").alias("category"))
    rows = rows.join(first, ["observation_id", "offering_platform_id"], "left")
    return rows.withColumn("unavailable", F.col("disabled").isNotNull()).withColumn("currency", F.lit("EUR")).drop("disabled")


def texts_of(record, path: str):
    return F.transform(items(record, path), lambda v: F.try_variant_get(v, "$", "string"))


@model
def stg_lieferando__menu_item(observations: DataFrame, payloads: DataFrame) -> DataFrame:
    """Menu item x observation: variations are prices of one item, categories come from the newest manifest."""
    view = View("lieferando", "menu_items", """
        offering_platform_id text Id
        name clean Name
        description clean Description
        variations json Variations
        variant_count size Variations
        dietary_tags json Labels
        item_type text Type
        image_url text ImageSources[0].Path
        """, spread=["Items"], rank="position", keys={"platform_id": "meta.restaurant_id", "slug": "natural_key"})  # fmt: skip
    rows = typed(records(observations, payloads, view), view)
    menus = records(observations, payloads, View("lieferando", "menu_manifest", "", spread=["Menus", "Categories"], newest_payload=True))
    listed = menus.select(F.col("natural_key").alias("slug"), F.col("rank").alias("_place"), at(F.col("item"), "Name").alias("_category"), F.explode(texts_of(F.col("item"), "ItemIds")).alias("offering_platform_id"))
    first = listed.groupBy("slug", "offering_platform_id").agg(F.min_by("_category", "_place").alias("category"))
    priced = F.from_json("variations", "array<struct<Name:string,BasePrice:decimal(10,2),DealOnly:boolean>>")
    prices = F.transform(priced, lambda v: v["BasePrice"])
    sizes = F.to_json(F.transform(priced, lambda v: F.struct(v["Name"].alias("name"), v["BasePrice"].alias("price"), v["DealOnly"].alias("deal_only"))))
    out = rows.withColumns({"price": F.array_min(prices), "price_max": F.array_max(prices), "size_variants": sizes, "currency": F.lit("EUR")}).drop("variations")
    return out.join(first, ["slug", "offering_platform_id"], "left")


@model
def stg_first_party__export(first_party_social_export: DataFrame, tenant: str = "tenant", zone: str = "Europe/Berlin") -> DataFrame:
    """A tenant's posts with one reading each, from delivered files; their times are local."""
    utc = lambda c: F.to_utc_timestamp(c, zone)
    return first_party_social_export.select(
        F.lit(tenant).alias("tenant_id"), "platform", "external_id", utc("posted_berlin").alias("posted_at"), "content_type", clean.clean_text(F.col("caption")).alias("caption"), "permalink",
        utc("captured_berlin").alias("captured_at"), "impressions", "reach", "likes", "comments", "shares", "saves", "clicks", F.col("file").alias("source_file"),
    )


@model
def stg_occasions__calendar(occasion_calendar: DataFrame, calendar_version: str = "1") -> DataFrame:
    """Day x community x holiday."""
    names = ["day", "community_id", "country", "occasion_type", "holiday_name", "holiday_name_native", "is_estimated", "source", "rule_kind"]
    return occasion_calendar.select(*names, F.lit(calendar_version).alias("calendar_version"))


def _tag(name: str):
    return F.col("tags")[name]


@model
def stg_osm__poi(osm_berlin_pois: DataFrame, dataset_version: str = "1") -> DataFrame:
    """Food places of a map extract, with their tags as a map."""
    # The tags by which a place counts as one for food
    places = ["restaurant", "fast_food", "cafe", "food_court", "bar", "pub", "biergarten", "ice_cream"]
    shops = ["deli", "bakery", "pastry", "confectionery", "butcher", "greengrocer", "seafood"]
    tags = {"opening_hours": "opening_hours", "brand": "brand", "brand_wikidata": "brand:wikidata", "diet_halal": "diet:halal", "diet_vegan": "diet:vegan", "delivery": "delivery", "takeaway": "takeaway", "wheelchair": "wheelchair", "capacity": "capacity"}
    chosen = _tag("amenity").isin(places) | _tag("shop").isin(shops) | F.map_contains_key("tags", "cuisine")
    address = F.concat_ws(" ", _tag("addr:street"), _tag("addr:housenumber"))
    return osm_berlin_pois.filter(F.coalesce(chosen, F.lit(False)) & F.col("name").isNotNull()).select(
        F.concat_ws("/", "osm_type", "osm_id").alias("platform_id"), F.lit(dataset_version).alias("dataset_version"), F.col("timestamp").alias("osm_edited_at"), clean.clean_text(F.col("name")).alias("name"), "lat", "lon",
        F.coalesce(_tag("amenity"), _tag("shop")).alias("poi_type"), _tag("cuisine").alias("cuisine_raw"), F.split(F.replace(F.lower(_tag("cuisine")), F.lit(" "), F.lit("")), ";").alias("cuisines"),
        clean.clean_text(address).alias("address_line"), _tag("addr:postcode").alias("postcode"), F.coalesce(_tag("addr:city"), F.lit("Berlin")).alias("city"),
        clean.clean_url(F.coalesce(_tag("website"), _tag("contact:website"), _tag("url"))).alias("website"), clean.phone_e164(F.coalesce(_tag("phone"), _tag("contact:phone"))).alias("phone"),
        F.coalesce(_tag("contact:instagram"), _tag("instagram")).alias("instagram"), F.coalesce(_tag("contact:facebook"), _tag("facebook")).alias("facebook"),
        *[_tag(t).alias(c) for c, t in tags.items()], (_tag("disused:amenity").isNotNull() | F.map_contains_key("tags", "was:amenity")).alias("is_disused"), "tags",
    )


@model
def stg_overture__place(overture_places: DataFrame, dataset_version: str = "1") -> DataFrame:
    """Food places of an open release, whose nested columns are JSON text."""
    # The categories by which a place counts as one for food
    basic = ["restaurant", "casual_eatery", "cafe", "coffee_shop", "bar", "fast_food_restaurant", "food_service"]
    baked = ["bakery", "patisserie", "confectionery", "dessert_shop", "ice_cream_shop"]
    j = lambda c: F.try_parse_json(c)
    hierarchy = texts_of(j("taxonomy"), "hierarchy")
    chosen = (F.get(hierarchy, F.lit(0)) == "food_and_drink") | F.col("basic_category").isin(basic) | F.arrays_overlap(hierarchy, F.array(*map(F.lit, baked)))
    return overture_places.filter(F.coalesce(chosen, F.lit(False))).select(
        F.col("id").alias("platform_id"), F.lit(dataset_version).alias("dataset_version"), clean.clean_text(at(j("names"), "primary")).alias("name"), "lat", "lon", "basic_category",
        at(j("taxonomy"), "primary").alias("category_primary"), hierarchy.alias("category_hierarchy"), texts_of(j("taxonomy"), "alternates").alias("category_alternates"),
        F.col("confidence").cast("decimal(5,4)").alias("confidence"), "operating_status", clean.clean_text(at(j("addresses"), "[0].freeform")).alias("address_line"), at(j("addresses"), "[0].postcode").alias("postcode"),
        at(j("addresses"), "[0].locality").alias("city"), clean.clean_url(at(j("websites"), "[0]")).alias("website"), clean.phone_e164(at(j("phones"), "[0]")).alias("phone"),
        texts_of(j("socials"), "").alias("socials"), at(j("brand"), "names.primary").alias("brand"), at(j("brand"), "wikidata").alias("brand_wikidata"),
    )


@model
def stg_foursquare__place(foursquare_os_places: DataFrame, dataset_version: str = "1") -> DataFrame:
    """Food places of an open release with category paths as JSON text."""
    label = F.col("fsq_category_labels")
    # Words of category paths by which a place counts as one for food
    chosen = F.lower(label).contains("dining and drinking") | F.lower(label).rlike("(restaurant|caf[eé]|bakery|food|bar|imbiss|pizza|coffee)")
    return foursquare_os_places.filter(chosen).select(
        F.col("fsq_place_id").alias("platform_id"), F.lit(dataset_version).alias("dataset_version"), clean.clean_text(F.col("name")).alias("name"), F.col("latitude").cast("double").alias("lat"),
        F.col("longitude").cast("double").alias("lon"), clean.clean_text(F.col("address")).alias("address_line"), "postcode", F.col("locality").alias("city"), clean.phone_e164(F.col("tel")).alias("phone"),
        clean.clean_url(F.col("website")).alias("website"), *[F.col(c).try_cast("date").alias(c) for c in ("date_created", "date_refreshed", "date_closed")], texts_of(F.try_parse_json(label), "").alias("category_labels"),
    )


@model
def stg_tripadvisor__restaurant(tripadvisor_eu_restaurants: DataFrame, observed_on: str = "2021-05-18") -> DataFrame:
    """Restaurants of a dated release, all text."""
    number = lambda c, kind: clean.blank_to_null(F.col(c)).try_cast("double").cast(kind)
    level = F.nullif(F.length(F.regexp_replace(F.coalesce("price_level", F.lit("")), "[^€$]", "")), F.lit(0)).cast("smallint")
    return tripadvisor_eu_restaurants.select(
        F.regexp_replace("restaurant_link", "^.*-d(\\d+)-.*$", "d$1").alias("platform_id"), F.to_date(F.lit(observed_on)).alias("observed_on"), clean.clean_text(F.col("restaurant_name")).alias("name"),
        clean.clean_text(F.split_part("address", F.lit(","), F.lit(1))).alias("address_line"), clean.postcode(F.col("address")).alias("postcode"), number("latitude", "double").alias("lat"),
        number("longitude", "double").alias("lon"), number("avg_rating", "decimal(3,2)").alias("rating_value"), number("total_reviews_count", "int").alias("rating_count"), level.alias("price_range"),
        F.split(F.lower(F.coalesce("cuisines", F.lit(""))), ", ").alias("cuisines"), F.col("restaurant_link").alias("share_url"),
    )


# The sections of the citizenship sheet, the ends of its labels, and the codes of areas of origin
CONTINENTS = ["Afrika", "Amerika", "Asien", "Australien/Ozeanien/Antarktis", "Sonstige Ausprägungen"]
EUROPEAN = ["Europäische Union (EU)", "Nicht-EU-Länder"]
FOOTNOTES = "[0-9⁰¹²³⁴⁵⁶⁷⁸⁹, ]+$"
TYPOS = {"Aurprägungen": "Ausprägungen", "/zeanien/": "/Ozeanien/", "’": "'"}
SUBTOTAL = "(?i)(^|\\s)(zusammen|insgesamt)$"
AGE_GROUPS = {"age_under_15": "unter 15", "age_15_45": "15 - 45", "age_45_65": "45 - 65", "age_65_plus": "65 und mehr"}
ORIGINS = {
    "Insgesamt": "ALL", "Europäische Union (EU) 1": "EU", "Frankreich": "FR", "Griechenland": "GR", "Italien": "IT", "Österreich": "AT", "Spanien": "ES", "Polen": "PL", "Bulgarien": "BG", "Rumänien": "RO",
    "Kroatien": "HR", "Vereinigtes Königreich": "UK", "Russische Föderation": "RU", "Ukraine": "UA", "Kasachstan": "KZ", "Türkei": "TR", "Afghanistan": "AF", "Iran": "IR", "Libanon": "LB", "Syrien": "SY",
    "Irak": "IQ", "China": "CN", "Indien": "IN", "Vietnam": "VN", "Vereinigte Staaten/ USA": "US",
}


@model
def stg_afs__citizenship(afs_population: DataFrame, afs_citizenship_alias: DataFrame) -> DataFrame:
    """Release x citizenship: residents, women and ages; rows that sum others are marked.

    ``afs_population``: reference_date, sheet, section, row_no, key1, key2, column_label, value. A bare subtotal ends its
    section and is named after it, or is the category itself where the section has no other row.
    """
    unmarked = lambda c: F.btrim(F.regexp_replace(c, FOOTNOTES, ""))
    cells = afs_population.filter((F.col("sheet") == "T10 G1") & F.coalesce("key2", "key1").isNotNull() & ~F.col("section").contains("Daten für Grafik"))
    part = lambda k: F.split_part("section", F.lit(" / "), F.lit(k))
    numbers = {
        "residents": F.col("column_label") == "Insgesamt / insgesamt", "female": F.col("column_label") == "Darunter weiblich / zusammen",
        **{c: F.col("column_label").like(f"Insgesamt / % / {ages}") for c, ages in AGE_GROUPS.items()},
    }
    rows = cells.groupBy("reference_date", "row_no").agg(
        F.min(part(1)).alias("_first"), F.min(part(2)).alias("_second"), F.min(F.coalesce("key2", "key1")).alias("source_label"), *[F.max(F.when(w, F.col("value"))).cast("int").alias(c) for c, w in numbers.items()]
    )
    label = unmarked(F.col("source_label"))
    for wrong, right in TYPOS.items():
        label = F.replace(label, F.lit(wrong), F.lit(right))
    section = clean.blank_to_null(unmarked(F.col("_second")))
    rows = rows.withColumn("_label", label).withColumn("_section", section)
    world = F.col("_section").isin(CONTINENTS)
    rows = rows.withColumn("_continent", F.when(F.col("_section").isin(EUROPEAN), "Europa").when(world, F.col("_section")).otherwise(clean.blank_to_null(F.col("_first"))))
    rows = rows.withColumn("_region", F.when(~F.coalesce(world, F.lit(False)), F.col("_section")))
    members = rows.groupBy("reference_date", "_first", "_second").agg(F.count_if(~F.col("_label").rlike(SUBTOTAL)).alias("_members"))
    rows = rows.join(members, ["reference_date", "_first", "_second"])
    rows = rows.join(afs_citizenship_alias.select(F.col("source_label").alias("_label"), F.col("citizenship").alias("_alias")), "_label", "left")
    bare, around = F.col("_label").rlike("(?i)^zusammen$"), F.coalesce("_region", "_continent")
    whole = clean.extract(F.col("_label"), "(?i)^(.+) zusammen$")
    name = F.when(bare & (F.col("_members") > 0), F.concat(around, F.lit(" zusammen"))).when(bare, around).otherwise(F.coalesce("_alias", "_label"))
    continent = F.when(F.col("_label") != "Insgesamt", F.coalesce(whole, F.col("_continent")))
    region = F.when(bare | ~F.col("_label").rlike(SUBTOTAL), F.col("_region"))
    return rows.select("reference_date", name.alias("citizenship"), continent.alias("continent"), region.alias("region"), name.rlike(SUBTOTAL).alias("is_aggregate"), "source_label", *numbers)


@model
def stg_afs__origin_area(afs_population: DataFrame) -> DataFrame:
    """Release x area x origin x sex: residents by the area that they or their parents came from."""
    fine = F.col("sheet") == "T4"
    rows = afs_population.filter(F.col("sheet").isin("T4", "T9") & F.col("key1").rlike("^[0-9]{2}"))
    label = F.replace(F.regexp_replace("column_label", "^(Darunter aus Herkunftsgebiet / )?(darunter / )?", ""), F.lit("-"), F.lit(""))
    codes = F.create_map(*[F.lit(x) for pair in ORIGINS.items() for x in pair])
    group = lambda k: F.when(fine, "insgesamt").otherwise(F.split_part("section", F.lit(" / "), F.lit(k)))
    return rows.withColumn("origin_label", label).select(
        "reference_date", F.when(fine, "lor").otherwise("district").alias("level"), F.when(fine, F.concat("key1", "key2", "key3", "key4")).alias("lor_code"),
        F.when(fine, F.col("key1")).otherwise(F.substring("key1", 1, 2)).alias("district_code"), group(1).alias("person_group"), group(2).alias("sex"), "origin_label",
        F.coalesce(F.element_at(codes, F.col("origin_label")), F.lit("OTHER")).alias("origin_code"), F.col("value").cast("int").alias("residents"),
    )

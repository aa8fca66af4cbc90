"""Marts and training features on the entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.windows import momentum, share_of
from .catalog import model


def _quantile(c: str, q: float) -> Column:
    return F.expr(f"percentile_cont({q}) WITHIN GROUP (ORDER BY {c})")


@model
def post_language(text_language: DataFrame) -> DataFrame:
    """Languages of posts that are sure enough to use."""
    return text_language.filter("text_kind = 'post' and lang is not null and confidence >= 0.6").select(F.col("text_id").alias("post_id"), "lang")


@model
def content_performance(post: DataFrame, post_metrics_snapshot: DataFrame, social_account_snapshot: DataFrame, social_account: DataFrame, min_post_age_h: int = 72, zone: str = "Europe/Berlin") -> DataFrame:
    """Each post among the mature posts of its account or forum: percentile, lift over the median, whether it went viral."""
    names = ["likes", "comments", "views", "shares", "saves", "post_age_hours"]
    m = post_metrics_snapshot.groupBy("post_id").agg(F.max_by(F.struct(*names), "observed_at").alias("m")).select("post_id", "m.*")
    f = social_account_snapshot.filter("followers is not null").groupBy("account_id").agg(F.max_by("followers", "observed_at").alias("followers"))
    p = post.join(m, "post_id").join(f, "account_id", "left").join(social_account.select("account_id", "business_id"), "account_id", "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    metric = F.when(F.col("platform") == "reddit", F.col("likes")).when(F.col("platform") == "instagram", zero("likes") + zero("comments")).otherwise(F.col("views"))
    local = F.from_utc_timestamp("posted_at", zone)
    p = p.withColumns({
        "peer_group": F.coalesce("account_id", "context"), "perf_metric": metric, "mature": F.col("post_age_hours") >= F.when(F.col("platform") == "reddit", 24).otherwise(min_post_age_h),
        "engagement_rate": (zero("likes") + zero("comments") + zero("shares") + zero("saves")) / F.nullif("followers", F.lit(0)), "hashtag_count": F.size("hashtags"), "emoji_count": F.size("emojis"),
        "posted_weekday_berlin": F.weekday(local) + 1, "posted_hour_berlin": F.hour(local),
    })
    counted = F.coalesce(F.col("mature"), F.lit(False)) & F.col("perf_metric").isNotNull()
    peer = p.filter(counted).groupBy("platform", "peer_group").agg(F.count(F.lit(1)).alias("peer_posts"), _quantile("perf_metric", 0.5).alias("peer_median"))
    p = p.join(peer, ["platform", "peer_group"], "left").withColumn("_counted", counted)
    rank = F.percent_rank().over(Window.partitionBy("platform", "peer_group", "_counted").orderBy("perf_metric"))
    by_views = F.percent_rank().over(Window.partitionBy("account_id", "mature", F.col("views").isNotNull()).orderBy("views"))
    p = p.withColumn("perf_pct_in_peer", F.when(F.col("_counted"), rank)).withColumn("perf_lift_vs_peer", F.when(F.col("_counted"), F.log((F.col("perf_metric") + 1) / (F.col("peer_median") + 1))))
    viral = F.when(F.col("_counted") & (F.col("peer_posts") >= 10), F.col("perf_pct_in_peer") >= 0.9)
    return p.withColumn("is_viral_in_peer", viral).withColumn("views_pct_rank_in_account", F.when(F.col("mature") & F.col("views").isNotNull(), by_views)).drop("_counted")


def judged(content_performance: DataFrame, now: Column, years: int = 3) -> DataFrame:
    """Mature posts of the last years that have a lift."""
    return content_performance.filter("mature and perf_lift_vs_peer is not null").filter(F.col("posted_at") >= F.add_months(now, -12 * years))


def _now(now: str | None) -> Column:
    return F.current_timestamp() if now is None else F.lit(now).cast("timestamp")


@model
def content_feature_performance(content_performance: DataFrame, content_tag: DataFrame, post_language: DataFrame, now: str | None = None) -> DataFrame:
    """How posts with a feature do against their peers: dishes, communities, occasions, cues, language, format, length."""
    cp = judged(content_performance, _now(now))
    steps = lambda c, edges, names: F.element_at(F.array(*map(F.lit, names)), F.size(F.filter(F.array(*map(F.lit, edges)), lambda e: c >= e)) + 1)
    length = steps(F.col("duration_s"), [15, 30, 60, 180, 600], ["<15s", "15-29s", "30-59s", "1-3min", "3-10min", "10min+"])
    tags = steps(F.col("hashtag_count"), [1, 4, 6, 11], ["0", "1-3", "4-5", "6-10", "11+"])
    of = lambda rows, kind, c: rows.select("post_id", F.lit(kind).alias("tag_type"), c.alias("tag_id")).filter("tag_id is not null")
    feat = (
        content_tag.select("post_id", "tag_type", "tag_id").unionByName(of(post_language, "language", F.col("lang"))).unionByName(of(cp, "post_type", F.col("post_type")))
        .unionByName(of(cp.filter("duration_s is not null"), "duration", length)).unionByName(of(cp, "hashtags", tags))
    )
    base = cp.groupBy("platform").agg(F.avg("perf_lift_vs_peer").alias("platform_mean_lift"), F.count(F.lit(1)).alias("platform_posts"))
    lift = F.col("perf_lift_vs_peer")
    out = feat.join(cp.select("post_id", "platform", "peer_group", lift, "perf_pct_in_peer", "is_viral_in_peer"), "post_id").join(base, "platform").groupBy("platform", "tag_type", "tag_id").agg(
        F.count(F.lit(1)).alias("posts"), F.count_distinct("peer_group").alias("peers"), _quantile("perf_lift_vs_peer", 0.5).alias("median_lift"), F.avg(lift).alias("mean_lift"),
        (F.avg(lift) - F.max("platform_mean_lift")).alias("mean_lift_vs_platform"), F.avg("perf_pct_in_peer").alias("mean_pct_in_peer"), F.avg(F.col("is_viral_in_peer").cast("int")).alias("viral_share"),
        (F.stddev_samp(lift) / F.sqrt(F.count(F.lit(1)))).alias("lift_std_error"), F.max("platform_posts").alias("platform_posts"),
    )
    return out.filter("posts >= 15")


@model
def posting_time_performance(content_performance: DataFrame, now: str | None = None) -> DataFrame:
    """Weekday x hour, with and without the kind of post: how posts of that time do against their peers."""
    cp = judged(content_performance, _now(now)).withColumnsRenamed({"posted_weekday_berlin": "iso_weekday", "posted_hour_berlin": "hour_berlin"})
    spread = cp.withColumn("post_type", F.explode(F.array(F.struct(F.lit(False).alias("all"), F.col("post_type").alias("t")), F.struct(F.lit(True).alias("all"), F.lit(None).cast("string").alias("t")))))
    out = spread.groupBy("platform", "post_type", "iso_weekday", "hour_berlin").agg(
        F.count(F.lit(1)).alias("posts"), F.count_distinct("peer_group").alias("peers"), _quantile("perf_lift_vs_peer", 0.5).alias("median_lift"), F.avg("perf_pct_in_peer").alias("mean_pct_in_peer"),
        F.avg(F.col("is_viral_in_peer").cast("int")).alias("viral_share"),
    )
    return out.filter("posts >= 20").withColumn("post_type", F.col("post_type.t"))


@model
def audio_performance(content_performance: DataFrame, now: str | None = None) -> DataFrame:
    """Sounds of the last twelve months and how videos with them did."""
    # How platforms name a creator's own sound
    own = "(?i)(original|originalton|orijinal|оригинальн|оригінальн|الصوت الأصلي|origineel)"
    at = _now(now)
    kind = F.when(F.col("audio_title").isNull(), "none").when(F.col("audio_title").rlike(own), "original_sound").otherwise("named_track")
    cp = content_performance.filter("platform = 'tiktok' and mature and perf_lift_vs_peer is not null").filter(F.col("posted_at") > at - F.expr("INTERVAL 365 DAYS")).withColumn("audio_kind", kind)
    cp = cp.withColumn("audio_title", F.when(F.col("audio_kind") == "named_track", F.col("audio_title")))
    out = cp.groupBy("audio_kind", "audio_title").agg(
        F.count(F.lit(1)).alias("videos"), F.count_distinct("peer_group").alias("accounts"), F.avg("perf_lift_vs_peer").alias("mean_lift"), F.avg(F.col("is_viral_in_peer").cast("int")).alias("viral_share"),
        F.max("posted_at").alias("last_used_at"), F.count_if(F.col("posted_at") > at - F.expr("INTERVAL 60 DAYS")).alias("videos_last_60d"),
    )
    return out.filter("accounts >= 5")


def tagged_posts(post: DataFrame, content_tag: DataFrame, content_performance: DataFrame) -> DataFrame:
    """Post x topic: tags, and hashtags as tags of their own kind."""
    tags = content_tag.select("post_id", "tag_type", "tag_id")
    hashtags = post.select("post_id", F.lit("hashtag").alias("tag_type"), F.explode("hashtags").alias("tag_id"))
    return tags.unionByName(hashtags).join(post.select("post_id", "platform", "posted_at"), "post_id").join(content_performance.select("post_id", "perf_lift_vs_peer"), "post_id", "left")


@model
def topic_trends_weekly(post: DataFrame, content_tag: DataFrame, content_performance: DataFrame, now: str | None = None) -> DataFrame:
    """Topic x platform x week: posts, their lift, and growth of the last four weeks over the twelve before."""
    t = tagged_posts(post, content_tag, content_performance).filter(F.col("posted_at") >= F.add_months(_now(now), -36))
    w = t.groupBy("tag_type", "tag_id", "platform", F.date_trunc("week", "posted_at").cast("date").alias("week")).agg(F.count(F.lit(1)).alias("posts"), F.avg("perf_lift_vs_peer").alias("mean_lift"))
    out = momentum(w, "tag_type, tag_id, platform", "week", "posts")
    return out.withColumn("posts_per_week_4w", F.col("last4") / 4).withColumn("posts_per_week_prev_12w", F.coalesce("prior12", F.lit(0)) / 12).drop("last4", "prior12")


@model
def trending_hashtags(post: DataFrame, content_performance: DataFrame, now: str | None = None) -> DataFrame:
    """Hashtags by use and engagement."""
    t = post.select("post_id", "platform", "posted_at", F.explode("hashtags").alias("hashtag")).join(content_performance.select("post_id", "engagement_rate", "views"), "post_id", "left")
    out = t.groupBy("hashtag", "platform").agg(
        F.count(F.lit(1)).alias("posts"), F.count_if(F.col("posted_at") > _now(now) - F.expr("INTERVAL 30 DAYS")).alias("posts_30d"), F.avg("engagement_rate").alias("mean_engagement_rate"), _quantile("views", 0.5).alias("median_views")
    )
    return out.filter("posts >= 3")


@model
def tenant_content_performance(tenant_social_post: DataFrame, tenant_social_metrics_snapshot: DataFrame, text_tag: DataFrame, text_language: DataFrame) -> DataFrame:
    """A tenant's own posts with their latest numbers, tags and language, ranked among its posts on the platform."""
    names = ["reach", "impressions", "likes", "comments", "shares", "saves", "clicks", "post_age_hours"]
    m = tenant_social_metrics_snapshot.groupBy("post_id").agg(F.max_by(F.struct(*names), "captured_at").alias("m")).select("post_id", "m.*")
    groups = {"cues": ["cue"], "dishes": ["dish", "rice_dish"], "communities": ["community"], "occasions": ["occasion"]}
    of = lambda kinds: F.sort_array(F.collect_set(F.when(F.col("tag_type").isin(kinds), F.col("tag_id"))))
    tags = text_tag.filter("text_kind = 'own_post'").groupBy(F.col("text_id").alias("post_id")).agg(*[of(k).alias(c) for c, k in groups.items()])
    lang = text_language.filter("text_kind = 'own_post' and confidence >= 0.5").select(F.col("text_id").alias("post_id"), F.col("lang").alias("language"))
    b = tenant_social_post.join(m, "post_id", "left").join(tags, "post_id", "left").join(lang, "post_id", "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    b = b.withColumns({c: F.coalesce(c, F.array().cast("array<string>")) for c in groups}).withColumns({
        "audience": F.coalesce("reach", "impressions"), "engagement": zero("likes") + zero("comments") + zero("shares") + zero("saves"), "mature": F.col("post_age_hours") >= 72, "hashtag_count": F.size("hashtags"),
    })
    counted = F.coalesce(F.col("mature"), F.lit(False)) & F.col("audience").isNotNull()
    rank = F.percent_rank().over(Window.partitionBy("platform", counted).orderBy("audience"))
    return b.withColumn("eng_rate", F.col("engagement") / F.nullif("audience", F.lit(0))).withColumn("pct_in_platform", F.when(counted, rank))


@model
def menu_price_index(offering: DataFrame, offering_price_snapshot: DataFrame, listing: DataFrame, business_assignment: DataFrame) -> DataFrame:
    """Each offering's newest sound price against the median of its dish."""
    price = offering_price_snapshot.filter("outlier_reason is null").groupBy("offering_id").agg(F.max_by("price", "observed_at").alias("price"))
    places = listing.filter("in_market").select("listing_id", "listing_key").join(business_assignment.select("listing_key", "business_id"), "listing_key")
    p = offering.filter("dish_id is not null").select("offering_id", "listing_id", "platform", "dish_id", "name").join(places, "listing_id").join(price, "offering_id").select("business_id", "listing_id", "platform", "offering_id", "dish_id", "name", "price")
    dish = p.groupBy("dish_id").agg(F.count(F.lit(1)).alias("berlin_offerings"), *[_quantile("price", q).alias(c) for c, q in (("_median", 0.5), ("_p25", 0.25), ("_p75", 0.75))])
    money = lambda c: F.col(c).cast("decimal(10,2)")
    return p.join(dish, "dish_id").select(
        "business_id", "listing_id", "platform", "offering_id", "dish_id", "name", "price", money("_median").alias("berlin_median_price"), money("_p25").alias("berlin_p25"), money("_p75").alias("berlin_p75"), "berlin_offerings",
        F.round(F.col("price").cast("double") / F.nullif("_median", F.lit(0)), 3).alias("price_index"),
    )


@model
def dish_market(menu_price_index: DataFrame) -> DataFrame:
    """Each dish: who sells it, where and for how much."""
    on = lambda p: F.count_distinct(F.when(F.col("platform") == p, F.col("business_id"))).alias(f"on_{p}")
    return menu_price_index.groupBy("dish_id").agg(
        F.count_distinct("business_id").alias("businesses"), F.count(F.lit(1)).alias("offerings"), F.min("berlin_median_price").alias("median_price"), F.min("berlin_p25").alias("p25"), F.min("berlin_p75").alias("p75"),
        on("wolt"), on("lieferando"),
    )


@model
def dish_interest_weekly(interest_daily: DataFrame) -> DataFrame:
    """Topic x week: views."""
    week = F.date_trunc("week", "day").cast("date").alias("week")
    return interest_daily.groupBy("topic", week).agg(F.sum("views_all_languages").alias("views"), F.sum("views_de").alias("views_de"), F.sum("views_south_asian_langs").alias("views_south_asian_langs"))


@model
def cuisine_supply_monthly(stg_osm_history__monthly: DataFrame) -> DataFrame:
    """District x cuisine x month with the change over twelve rows before."""
    before = F.lag("poi_count", 12).over(Window.partitionBy("district", "cuisine_tag").orderBy("month"))
    return stg_osm_history__monthly.withColumn("yoy_change", F.col("poi_count") - before)


@model
def search_visibility(stg_google_maps__search_result: DataFrame, business_assignment: DataFrame) -> DataFrame:
    """Business x query: where it shows, how high, and its share of what searchers see."""
    r = stg_google_maps__search_result.withColumn("listing_key", F.concat(F.lit("google_maps:"), "platform_id")).join(business_assignment.select("listing_key", "business_id"), "listing_key")
    out = r.groupBy("business_id", "query").agg(
        F.count_distinct("cell").alias("cells_visible"), F.min("rank").alias("best_rank"), F.round(F.avg("rank"), 1).alias("avg_rank"), F.sum(1 / (F.col("rank") + 1)).alias("visibility")
    )
    return share_of(out, ["business_id"], ["query"], F.col("visibility")).select("business_id", "query", F.col("share").alias("share_of_search")).join(out, ["business_id", "query"])


@model
def area_demand(market_cell: DataFrame, area_stat: DataFrame, business: DataFrame, business_cell: DataFrame, coverage_observation: DataFrame, listing_cuisine: DataFrame) -> DataFrame:
    """Cell of the market: who lives there, what is there, and who delivers there."""
    # The variables that become columns
    names = {
        "population": "population.einwohner", "foreigner_share_pct": "foreigner_share.anteilauslaender", "mean_age": "mean_age.durchschnittsalter", "household_size": "household_size_mean.durchschnhhgroesse",
        "rent_eur_m2": "rent_net_cold.durchschnmieteqm", "share_under_18_pct": "share_under_18.anteilunter18", "share_65_plus_pct": "share_65_plus.anteilueber65",
    }
    pop = area_stat.groupBy(F.col("area_id").alias("cell")).agg(*[F.max(F.when(F.col("variable") == v, F.col("value"))).alias(c) for c, v in names.items()])
    counts = {"businesses": F.lit(True), "south_asian_businesses": F.col("primary_cuisine_group") == "south_asian", "halal_businesses": F.col("is_halal"), "delivery_businesses": F.col("delivery_platform_count") > 0}
    supply = business.filter("in_market and status <> 'closed'").join(business_cell, "business_id").groupBy("cell").agg(*[F.count_if(c).alias(n) for n, c in counts.items()])
    south = listing_cuisine.filter("cuisine_group = 'south_asian'").select("listing_id", F.lit(True).alias("_south")).distinct()
    reach = coverage_observation.filter("platform = 'wolt' and offered").join(south, "listing_id", "left").groupBy(F.col("area_id").alias("cell")).agg(
        F.count_distinct("listing_id").alias("wolt_venues_delivering"), F.count_distinct(F.when(F.col("_south"), F.col("listing_id"))).alias("south_asian_venues_delivering")
    )
    out = market_cell.join(pop, "cell", "left").join(supply, "cell", "left").join(reach, "cell", "left").withColumns({n: F.coalesce(n, F.lit(0)) for n in counts})
    served = F.col("south_asian_venues_delivering")
    return out.withColumn("residents_per_south_asian_venue", F.when(served > 0, F.round(F.col("population") / served, 1)))


@model
def competitor_overview(
    business: DataFrame, listing: DataFrame, listing_snapshot: DataFrame, offering: DataFrame, offering_price_snapshot: DataFrame, coverage_observation: DataFrame, business_assignment: DataFrame, crux_rank: DataFrame
) -> DataFrame:
    """One row a business of the market: where it is, what it sells, how it rates and what ordering costs."""
    rated = listing_snapshot.filter("rating_value is not null").groupBy("listing_id").agg(F.max_by(F.struct("rating_value", "rating_norm", "rating_count"), "observed_at").alias("r")).select("listing_id", "r.*")
    paid = ["order_minimum", "base_delivery_fee", "delivery_estimate_min"]
    fees = listing_snapshot.filter("coalesce(order_minimum, base_delivery_fee) is not null and outlier_reason is null")
    fees = fees.groupBy("listing_id").agg(F.max_by(F.struct(*paid), "observed_at").alias("f")).select("listing_id", "f.*")
    price = offering_price_snapshot.filter("outlier_reason is null").groupBy("offering_id").agg(F.max_by("price", "observed_at").alias("price"))
    flag = lambda c: F.avg(F.col(f"attributes.{c}").cast("int"))
    menu = offering.filter("not attributes.drink").select("offering_id", "listing_id", "dish_id", "attributes").join(price, "offering_id").groupBy("listing_id").agg(
        F.count(F.lit(1)).alias("menu_items"), F.count_distinct("dish_id").alias("canonical_dishes"), _quantile("price", 0.5).alias("median_item_price"), flag("halal").alias("halal_item_share"), flag("vegan").alias("vegan_item_share")
    )
    areas = coverage_observation.filter("offered").groupBy("listing_id").agg(F.count_distinct("area_id").alias("delivery_areas"))
    each = business_assignment.select("business_id", "listing_key").join(listing.select("listing_key", "listing_id", "platform"), "listing_key")
    for part in (rated, fees, menu, areas):
        each = each.join(part, "listing_id", "left")
    on = lambda p, c: F.max(F.when(F.col("platform") == p, F.col(c)))
    scored = F.when(F.col("rating_norm").isNotNull(), F.col("rating_count"))
    totals = each.groupBy("business_id").agg(
        on("google_maps", "rating_value").alias("google_rating"), on("google_maps", "rating_count").alias("google_review_count"), on("wolt", "rating_value").alias("wolt_rating"),
        on("wolt", "rating_count").alias("wolt_rating_count"), on("lieferando", "rating_value").alias("lieferando_rating"), on("lieferando", "rating_count").alias("lieferando_rating_count"),
        (F.sum(F.col("rating_norm").cast("double") * F.col("rating_count")) / F.nullif(F.sum(scored), F.lit(0))).alias("rating_norm_weighted"), F.sum("rating_count").alias("rating_count_total"),
        F.min("order_minimum").alias("min_order_minimum"), F.min("base_delivery_fee").alias("min_base_delivery_fee"), F.min("delivery_estimate_min").alias("min_delivery_estimate_min"),
        F.max("menu_items").alias("menu_items"), F.max("canonical_dishes").alias("canonical_dishes"), F.avg("median_item_price").cast("decimal(10,2)").alias("median_item_price"),
        F.max("halal_item_share").alias("halal_item_share"), F.max("vegan_item_share").alias("vegan_item_share"), F.max("delivery_areas").alias("delivery_areas_max"),
    )
    crux = crux_rank.groupBy("yyyymm", F.regexp_replace("origin", "^https?://(www\\.)?", "").alias("website_domain")).agg(F.min("rank_bucket").alias("crux_rank_bucket"))
    months = crux_rank.agg(F.max("yyyymm").alias("yyyymm"))
    crux = crux.join(F.broadcast(months), "yyyymm").drop("yyyymm")  # one row
    return business.filter("in_market").join(totals, "business_id", "left").join(crux, "website_domain", "left")


@model
def survival_since_2021(listing: DataFrame, business_assignment: DataFrame, business: DataFrame, listing_snapshot: DataFrame, competitor_overview: DataFrame) -> DataFrame:
    """Each restaurant of the dated baseline: whether its business is still there, and how its rating moved."""
    then = listing.filter("platform = 'tripadvisor'").select("listing_key", "listing_id", F.col("name").alias("name_2021")).join(business_assignment.select("listing_key", "business_id"), "listing_key")
    rated = listing_snapshot.filter("platform = 'tripadvisor'").select("listing_id", F.col("rating_value").alias("rating_2021"), F.col("rating_count").alias("reviews_2021"))
    now = business.select("business_id", F.col("name").alias("name_now"), "primary_cuisine", "district", "status", "listing_count", "delivery_platform_count")
    google = competitor_overview.select("business_id", F.col("google_rating").alias("google_rating_now"), F.col("google_review_count").alias("google_reviews_now"))
    out = then.join(now, "business_id").join(rated, "listing_id", "left").join(google, "business_id", "left")
    others = F.col("listing_count") > 1
    fate = F.when(F.col("status") == "closed", "closed").when(others & (F.col("status") == "active"), "surviving").when(F.col("listing_count") == 1, "not_seen_since_2021").otherwise(F.col("status"))
    return out.select(
        "business_id", "name_2021", "name_now", "primary_cuisine", "district", "rating_2021", "reviews_2021", "google_rating_now", "google_reviews_now", F.round(F.col("google_rating_now") - F.col("rating_2021"), 2).alias("rating_change_vs_google"),
        others.alias("seen_on_other_sources"), (F.col("delivery_platform_count") > 0).alias("on_delivery_apps_now"), fate.alias("survival_status"),
    )


@model
def occasion_content_calendar(occasion_day: DataFrame, community: DataFrame, community_dish: DataFrame, community_audience: DataFrame, stg_berlin_events__event: DataFrame, today: str | None = None, zone: str = "Europe/Berlin") -> DataFrame:
    """Every occasion from a week ago to fifteen months ahead: when to start, how to greet, for whom, and what else is on."""
    day0 = F.current_date() if today is None else F.lit(today).cast("date")
    newest = community_audience.agg(F.max("reference_date").alias("reference_date"))
    sized = community_audience.join(F.broadcast(newest), "reference_date")  # one row
    top = F.slice(F.sort_array(F.collect_list(F.when(F.col("level") == "district_mh", F.struct((-F.col("residents")).alias("n"), "area_code", "residents")))), 1, 3)
    size = sized.groupBy("community_id").agg(
        F.max(F.when(F.col("level") == "berlin_citizens", F.col("residents"))).alias("berlin_citizens"), F.transform(top, lambda x: F.concat_ws(":", x["area_code"], x["residents"].cast("string"))).alias("top_districts_mh")
    )
    dishes = community_dish.groupBy("community_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("dish_id", F.concat_ws(" — ", "english", "native_name").alias("n")))), lambda x: x["n"]).alias("bridge_dishes"))
    events = stg_berlin_events__event.groupBy("event_id", "feed").agg(F.max_by(F.struct("name", "starts_on", "ends_on"), "fetched_at").alias("e")).filter("e.ends_on >= e.starts_on")
    events = events.select("e.name", F.explode(F.sequence("e.starts_on", "e.ends_on")).alias("day")).groupBy("day").agg(F.sort_array(F.collect_set("name")).alias("berlin_events"))
    o = occasion_day.filter(F.col("day").between(F.date_sub(day0, 7), F.date_add(day0, 460)) & (F.col("occasion_type") != "payday"))
    out = o.join(community.select("community_id", "label"), "community_id", "left").join(dishes, "community_id", "left").join(size, "community_id", "left").join(events, "day", "left")
    clock = lambda c: F.date_format(F.from_utc_timestamp(c, zone), "HH:mm")
    return out.withColumns({"community": F.coalesce("label", F.lit("All Berlin")), "iso_weekday": F.weekday("day") + 1, "iftar_local": clock("iftar_at"), "suhoor_ends_local": clock("suhoor_ends_at")}).drop("label")


@model
def feature_offering(offering: DataFrame, offering_price_snapshot: DataFrame, listing_snapshot: DataFrame) -> DataFrame:
    """Each price observation with what was known of its listing by then."""
    seen = listing_snapshot.filter("rating_value is not null").select("listing_id", F.col("observed_at").alias("_at"), "rating_norm", "rating_count")
    p = offering_price_snapshot.filter("outlier_reason is null").select("offering_id", "listing_id", "observed_at", "price", "discount_share", "listing_median")
    both = p.withColumn("_is", F.lit(1)).unionByName(seen.select("listing_id", F.col("_at").alias("observed_at"), "rating_norm", "rating_count", F.lit(0).alias("_is")), allowMissingColumns=True)
    w = Window.partitionBy("listing_id").orderBy("observed_at", "_is").rowsBetween(Window.unboundedPreceding, 0)
    known = both.withColumn("listing_rating_then", F.last("rating_norm", True).over(w)).withColumn("listing_reviews_then", F.last("rating_count", True).over(w)).filter("_is = 1")
    about = offering.select("offering_id", "dish_id", "category", F.length("name").alias("name_length"), "attributes.*")
    return known.drop("_is", "rating_norm", "rating_count").join(about, "offering_id")

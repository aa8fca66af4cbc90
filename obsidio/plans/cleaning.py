"""Queries over the cleaning expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import clean
from ..session import load
from .registry import query

_MESSY = "concat('  ', replace(text, ' ', '  '), '&amp; &lt;b&gt;', chr(8203), ' Cafe', chr(769), ' DO', chr(776), 'NER ')"
_CLEAN_D = f"regexp_replace(nfc_normalize({_MESSY}), '{clean.ZERO_WIDTH}', '', 'g')"
for _entity, _char in clean.ENTITIES:
    _CLEAN_D = f"replace({_CLEAN_D}, '{_entity}', '{_char.replace(chr(39), chr(39) * 2)}')"
_CLEAN_D = f"nullif(trim(regexp_replace({_CLEAN_D}, '\\s+', ' ', 'g')), '')"
_FOLD_D = f"strip_accents(replace(replace(replace(replace(lower({_CLEAN_D}), 'ä', 'ae'), 'ö', 'oe'), 'ü', 'ue'), 'ß', 'ss'))"


def _messy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text, made messier: doubled spaces, entities, a zero-width space and decomposed letters."""
    spelt = _MESSY
    for code in (8203, 769, 776):  # chr() of Spark stops at 255
        spelt = spelt.replace(f"chr({code})", f"'{chr(code)}'")
    return load(spark, sf_dir, "documents").select("doc_id", F.expr(spelt).alias("raw"))


@query(f"SELECT doc_id, md5({_CLEAN_D}) AS digest, length({_CLEAN_D}) AS n FROM documents")
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _messy(spark, sf_dir).withColumn("c", clean.clean_text(F.col("raw")))
    return out.select("doc_id", F.md5("c").alias("digest"), F.length("c").cast("long").alias("n"))


@query(f"SELECT doc_id, md5({_FOLD_D}) AS digest FROM documents")
def fold_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _messy(spark, sf_dir).select("doc_id", F.md5(clean.fold(F.col("raw"))).alias("digest"))


_LEGAL = "|".join(clean.LEGAL_WORDS)


@query(f"SELECT doc_id, nullif(trim(regexp_replace(regexp_replace(regexp_replace({_FOLD_D}, '[^a-z0-9 ]', ' ', 'g'), '\\b({_LEGAL})\\b', ' ', 'g'), '\\s+', ' ', 'g')), '') AS name_key FROM documents")
def name_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _messy(spark, sf_dir).select("doc_id", clean.name_key(F.col("raw")).alias("name_key"))


_DOMAIN_D = "nullif(regexp_replace(regexp_replace(regexp_extract(lower(url), '^(?:[a-z]+://)?([^/?#:]+)', 1), '^(www\\d?|m)\\.', ''), '\\.$', ''), '')"


@query(f"""SELECT page_id, {_DOMAIN_D} AS domain, nullif(CASE WHEN regexp_matches({_DOMAIN_D}, '\\.(co|com|org|net|ac|gov)\\.[a-z]{{2}}$') THEN regexp_extract({_DOMAIN_D}, '([^.]+\\.[^.]+\\.[^.]+)$', 1)
    ELSE regexp_extract({_DOMAIN_D}, '([^.]+\\.[^.]+)$', 1) END, '') AS registrable FROM pages""")
def url_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return load(spark, sf_dir, "pages").select("page_id", clean.domain(url).alias("domain"), clean.registrable_domain(url).alias("registrable"))


_TRACKED = "url || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END || 'utm_source=x&GCLID=7&keep=' || page_id || '&sa=1'"


@query(f"""SELECT page_id, nullif(regexp_replace(regexp_replace(regexp_replace({_TRACKED}, '([?&])({clean.TRACKING})=[^&#]*', '\\1', 'gi'), '([?&])&+', '\\1', 'g'), '[?&]+(#|$)', '\\1'), '') AS url FROM pages""")
def clean_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    tracked = F.expr(_TRACKED)
    return load(spark, sf_dir, "pages").select("page_id", clean.clean_url(tracked).alias("url"))


@query("""
    SELECT page_id, lower(regexp_extract(url, '^([A-Za-z]+)://', 1)) || '://' || lower(regexp_extract(url, '^[A-Za-z]+://([^/?#]*)', 1)) ||
        regexp_replace(CASE WHEN regexp_extract(url, '^[A-Za-z]+://[^/?#]*(/[^?#]*)', 1) = '' THEN '/' ELSE regexp_extract(url, '^[A-Za-z]+://[^/?#]*(/[^?#]*)', 1) END, '/{2,}', '/', 'g') ||
        CASE WHEN q = '' THEN '' ELSE '?' || q END AS url
    FROM (SELECT *, array_to_string(list_filter(string_split(regexp_extract(url, '\\?([^#]*)', 1), '&'), lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_|fbclid|gclid|ref=)')), '&') AS q FROM pages)""")
def canonical_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "pages").select("page_id", clean.canonical_url(F.col("url")).alias("url"))


def _amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts of the parts in several spellings."""
    price = F.col("p_retailprice").cast("decimal(10,2)")
    whole, part = F.floor(price).cast("string"), F.lpad(F.floor(price * 100 % 100).cast("string"), 2, "0")
    forms = F.array(
        F.concat(whole, F.lit(","), part, F.lit(" €")), F.concat(F.lit("€"), whole, F.lit("."), part), F.concat(F.lit("1.234,"), part), F.concat(whole, F.lit(" EUR")), F.lit("auf Anfrage")
    )
    return load(spark, sf_dir, "part").select("p_partkey", F.posexplode(forms).alias("form", "raw"))


@query("""
    SELECT p_partkey, form, CAST(CASE form WHEN 2 THEN 1234 + c / 100.0 WHEN 3 THEN w WHEN 4 THEN NULL ELSE w + c / 100.0 END AS DOUBLE) AS amount FROM (
        SELECT p_partkey, CAST(floor(CAST(p_retailprice AS DECIMAL(10,2))) AS BIGINT) AS w, CAST(floor(CAST(p_retailprice AS DECIMAL(10,2)) * 100) AS BIGINT) % 100 AS c FROM part),
    (SELECT CAST(unnest(range(5)) AS INTEGER) AS form)""")
def parse_money(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _amounts(spark, sf_dir).select("p_partkey", "form", clean.parse_money(F.col("raw")).cast("double").alias("amount"))


@query("""
    SELECT p_partkey, form, CAST(CASE form WHEN 0 THEN p_size * 1000 + 200 WHEN 1 THEN p_size * 1000000 WHEN 2 THEN p_size * 1000 + 234 WHEN 3 THEN p_size END AS BIGINT) AS n
    FROM part, (SELECT CAST(unnest(range(5)) AS INTEGER) AS form)""")
def parse_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size").cast("string")
    forms = F.array(F.concat(size, F.lit(",2 Tsd.")), F.concat(size, F.lit(" Mio")), F.concat(size, F.lit(".234")), F.concat(F.lit(" "), size, F.lit(" ")), F.lit("viele"))
    spread = load(spark, sf_dir, "part").select("p_partkey", F.posexplode(forms).alias("form", "raw"))
    return spread.select("p_partkey", "form", clean.parse_count(F.col("raw")).alias("n"))


@query("""
    SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN '+49305' || d WHEN 1 THEN '+49305' || d WHEN 2 THEN '+43305' || d END AS phone FROM (SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS d FROM customer)""")
def phone_e164(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.lpad(F.col("c_custkey").cast("string"), 6, "0")
    k = F.col("c_custkey") % 4
    raw = F.when(k == 0, F.concat(F.lit("030/5-"), d)).when(k == 1, F.concat(F.lit("+49 (30) 5"), d)).when(k == 2, F.concat(F.lit("0043 305 "), d)).otherwise(F.concat(F.lit("5"), d))
    return load(spark, sf_dir, "customer").select("c_custkey", clean.phone_e164(raw).alias("phone"))


@query("""
    SELECT s_suppkey, 'Lange Straße' AS street, (s_suppkey % 90 + 1) || CASE WHEN s_suppkey % 3 = 0 THEN 'a' ELSE '' END AS house_number, lpad(CAST(10115 + s_suppkey % 900 AS VARCHAR), 5, '0') AS postcode,
        'lange strasse ' || (s_suppkey % 90 + 1) || CASE WHEN s_suppkey % 3 = 0 THEN 'a' ELSE '' END AS street_key FROM supplier""")
def street_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.concat((F.col("s_suppkey") % 90 + 1).cast("string"), F.when(F.col("s_suppkey") % 3 == 0, "a").otherwise(""))
    line = F.concat(F.lit(" Lange  Straße "), number)
    place = F.concat(line, F.lit(", "), (F.lit(10115) + F.col("s_suppkey") % 900).cast("string"), F.lit(" Stadt"))
    return load(spark, sf_dir, "supplier").select(
        "s_suppkey", clean.street(line).alias("street"), clean.house_number(line).alias("house_number"), clean.postcode(place).alias("postcode"), clean.street_key(line).alias("street_key")
    )


@query("SELECT c_custkey, CAST(greatest(0, least(1, floor((c_acctbal + 1000) / 8000 * 1000) / 1000)) AS DOUBLE) AS rating FROM customer")
def rating_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = F.floor((F.col("c_acctbal") + 1000) / 8000 * 1000) / 1000
    return load(spark, sf_dir, "customer").select("c_custkey", clean.rating_norm(scaled, 0.0, 1.0).cast("double").alias("rating"))


@query("""
    SELECT c_custkey, md5(c_name || '||' || CASE WHEN c_acctbal < 0 THEN '∅' ELSE c_mktsegment END) AS attr_hash,
        regexp_replace(md5('customer:' || c_custkey), '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\\1-\\2-\\3-\\4-\\5') AS id FROM customer""")
def attr_hash_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment"))
    return load(spark, sf_dir, "customer").select("c_custkey", clean.hash_of([F.col("c_name"), segment]).alias("attr_hash"), clean.uuid_of(F.concat(F.lit("customer:"), F.col("c_custkey").cast("string"))).alias("id"))


_TAGGED = "concat('#', replace(text, ' ', ' #'), ' @', source, ' @X_', cast(doc_id as string))"


@query("""
    SELECT doc_id, array_to_string(list_transform(regexp_extract_all(t, '#([a-zA-Z0-9_äöüß]+)', 1), lambda x: lower(x)), ',') AS hashtags,
        array_to_string(list_transform(regexp_extract_all(t, '@([a-zA-Z0-9_äöüß]+)', 1), lambda x: lower(x)), ',') AS mentions
    FROM (SELECT doc_id, concat('#', replace(text, ' ', ' #'), ' @', source, ' @X_', doc_id) AS t FROM documents)""")
def hashtags_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.expr(_TAGGED)
    return load(spark, sf_dir, "documents").select("doc_id", F.array_join(clean.tags_of(t, "#"), ",").alias("hashtags"), F.array_join(clean.tags_of(t, "@"), ",").alias("mentions"))


@query("""
    SELECT doc_id, length(text) AS n_chars, length(regexp_replace(text, '[^A-Z]', '', 'g')) AS capitals, contains(text, '?') AS question, regexp_matches(text, '[0-9]') AS number,
        length(text) - length(replace(text, '\n', '')) + 1 AS lines, len(regexp_extract_all(text, '[^ \t\n\r\f\v]+')) AS words FROM documents""")
def text_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    return load(spark, sf_dir, "documents").select(
        "doc_id", F.length(text).cast("long").alias("n_chars"), F.length(F.regexp_replace(text, "[^A-Z]", "")).cast("long").alias("capitals"), text.contains("?").alias("question"),
        text.rlike("[0-9]").alias("number"), (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long").alias("lines"),
        F.regexp_count(text, F.lit("[^ \\t\\n\\r\\f\\x0B]+")).cast("long").alias("words"),
    )


FLAGS = {"small": "\\bsmall\\b", "red": "\\bred", "metal": "\\b(bolt|nut|gear|ring)", "widget": "(widget|gizmo|gadget)"}


@query(f"SELECT p_partkey, {', '.join(f'''regexp_matches(lower(p_name), '{p}') AS {k}''' for k, p in FLAGS.items())} FROM part")
def attribute_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = clean.attribute_flags(F.lower("p_name"), FLAGS).alias("f")
    return load(spark, sf_dir, "part").select("p_partkey", flags).select("p_partkey", "f.*")

"""Cleaning expressions: functions from Column to Column, null where there is nothing to tell.

All run in the JVM. Composition of decomposed letters is the one thing that Spark has no function for; ``nfc`` does it in
a pandas UDF, to which only texts with combining marks are sent; for others it gets a null.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, functions as F

# Characters that are removed, entities and what they stand for, words that names drop, parameters that
# URLs drop, and second-level labels under which domains are registered.
ZERO_WIDTH = "[​-‍⁠﻿]"
ENTITIES = (("&amp;", "&"), ("&quot;", '"'), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&nbsp;", " "))
UMLAUTS = (("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("ß", "ss"))
LEGAL_WORDS = (
    "gmbh", "ug", "haftungsbeschraenkt", "e ?k", "ohg", "kg", "gbr", "ag", "co", "mbh", "ltd", "inc", "restaurant", "ristorante",
    "restaurante", "berlin", "lieferservice", "lieferdienst", "delivery", "imbiss", "bistro", "cafe", "bar", "grill", "the", "und", "and",
    "am", "an", "der", "die", "das", "zum", "zur", "im", "in", "by", "de", "la", "le", "il", "da",
)
TRACKING = "utm_[a-z_]+|fbclid|gclid|dclid|msclkid|mc_[a-z_]+|igshid|_ga|ref_src|opi|ved|usg|sa"
CANONICAL_DROPS = "utm_|fbclid|gclid|ref="
SECOND_LEVEL = "co|com|org|net|ac|gov"
COUNTRY = "+49"
COUNT_UNITS = {"k": 1000, "tsd": 1000, "tsd.": 1000, "tausend": 1000, "m": 10**6, "mio": 10**6, "mio.": 10**6, "million": 10**6, "millionen": 10**6}

#: Letters with accents and what is left without them, for Latin-1 and Latin Extended-A; built from their decomposition.
_ACCENTED = [chr(c) for c in range(0xC0, 0x180) if len(unicodedata.normalize("NFD", chr(c))) > 1]
_BASE = "".join(unicodedata.normalize("NFD", c)[0] for c in _ACCENTED)


def blank_to_null(x: Column) -> Column:
    return F.nullif(x, F.lit(""))


def extract(x: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match; null without one."""
    return blank_to_null(F.regexp_extract(x, pattern, group))


def _compose(x: pd.Series) -> pd.Series:
    return x.map(lambda s: None if s is None else unicodedata.normalize("NFC", s))


def nfc(x: Column) -> Column:
    """Canonical composition. Texts without combining marks don't leave the JVM."""
    return F.coalesce(F.pandas_udf(_compose, "string")(F.when(x.rlike("\\p{M}"), x)), x)


def clean_text(x: Column) -> Column:
    """Letters composed, zero-width characters out, entities unescaped once, white space collapsed and trimmed; empty becomes null."""
    out = F.regexp_replace(nfc(x), ZERO_WIDTH, "")
    for entity, char in ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(char))
    return blank_to_null(F.btrim(F.regexp_replace(out, "\\s+", " ")))


def fold(x: Column, cleaned: bool = False) -> Column:
    """Clean, lower case, umlauts spelt out, other accents dropped. ``cleaned`` texts aren't cleaned again."""
    out = F.lower(x if cleaned else clean_text(x))
    for letter, spelt in UMLAUTS:
        out = F.replace(out, F.lit(letter), F.lit(spelt))
    return F.translate(out, "".join(_ACCENTED), _BASE)


def name_key(x: Column, cleaned: bool = False) -> Column:
    """What a business name is matched by: folded, letters and digits only, without legal forms and filler words."""
    plain = F.regexp_replace(fold(x, cleaned), "[^a-z0-9 ]", " ")
    short = F.regexp_replace(plain, f"\\b({'|'.join(LEGAL_WORDS)})\\b", " ")
    return blank_to_null(F.btrim(F.regexp_replace(short, "\\s+", " ")))


def _groups(digits: Column, marks: str) -> tuple[Column, Column]:
    """What stands between thousands marks, and whether these make groups of three."""
    groups = F.split(digits, marks)
    rest = F.slice(groups, 2, F.greatest(F.size(groups) - 1, F.lit(0)))
    return groups, (F.size(groups) > 1) & F.length(groups[0]).between(1, 3) & F.forall(rest, lambda g: F.length(g) == 3)


def brand_key(x: Column) -> Column:
    """What chains are matched by: accents dropped, runs of anything but letters and digits as one space, lower case."""
    plain = F.translate(nfc(x), "".join(_ACCENTED), _BASE)
    return blank_to_null(F.btrim(F.lower(F.regexp_replace(plain, "[^a-zA-Z0-9]+", " "))))


def parse_money(x: Column) -> Column:
    """German and English amounts as decimal(10,2); null for anything else.

    One comma after at most thousands groups is a decimal comma, and points between such groups go; else commas group
    thousands and a point is the decimal point.
    """
    kept = F.regexp_replace(x, "[^0-9,.\\-]", "")
    halves = F.split(kept, ",")
    whole, part = F.regexp_replace(halves[0], "^-", ""), F.get(halves, F.lit(1))
    groups, thousands = _groups(whole, "\\.")
    sign = F.when(kept.startswith("-"), "-").otherwise("")
    german = F.when((F.size(halves) == 2) & (thousands | (F.size(groups) == 1)), F.concat(sign, F.array_join(groups, ""), F.lit("."), part))
    german = german.when((F.size(halves) == 1) & thousands, F.concat(sign, F.array_join(groups, "")))
    valid = lambda c: F.when(c.rlike("^-?[0-9]+([.][0-9]+)?$"), c)
    return F.coalesce(valid(german), valid(F.replace(kept, F.lit(","), F.lit("")))).try_cast("decimal(10,2)")


def cents(x: Column) -> Column:
    return (x.cast("decimal(18,0)") / 100).cast("decimal(10,2)")


def parse_count(x: Column) -> Column:
    """Counts such as 1.2K, 3 Mio. or 1.234 as a long; null for anything else."""
    form = "^\\s*([0-9.,]+)\\s*([a-z]*\\.?)\\s*$"
    low = F.lower(x)
    amount, unit = F.regexp_extract(low, form, 1), F.regexp_extract(low, form, 2)
    factor = F.element_at(F.create_map(*[F.lit(v) for pair in COUNT_UNITS.items() for v in pair]), unit)
    number = F.replace(F.regexp_replace(amount, "[.,]+$", ""), F.lit(","), F.lit(".")).try_cast("decimal(20,6)")
    groups, thousands = _groups(amount, "[.,]")
    plain = F.when((unit == "") & (thousands | (F.size(groups) == 1)), F.array_join(groups, ""))
    return F.when(factor.isNotNull(), F.round(number * factor).cast("long")).otherwise(plain.try_cast("long"))


def rating_norm(x: Column, lo: float, hi: float) -> Column:
    """A rating of any scale as 0 to 1, decimal(6,4)."""
    part = (x - F.lit(lo)) / F.lit(hi - lo)
    return F.when(x.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), part)).cast("decimal(6,4)"))


def domain(url: Column) -> Column:
    """Host in lower case without www, m and a closing dot."""
    host = F.regexp_extract(F.lower(url), "^(?:[a-z]+://)?([^/?#:]+)", 1)
    return blank_to_null(F.regexp_replace(F.regexp_replace(host, "^(www\\d?|m)\\.", ""), "\\.$", ""))


def registrable_domain(url: Column) -> Column:
    host = domain(url)
    three = host.rlike(f"\\.({SECOND_LEVEL})\\.[a-z]{{2}}$")
    return F.when(three, extract(host, "([^.]+\\.[^.]+\\.[^.]+)$")).otherwise(extract(host, "([^.]+\\.[^.]+)$"))


def url_decode(x: Column) -> Column:
    """Percent and plus decoding; the input where it doesn't decode."""
    return F.coalesce(F.try_url_decode(x), x)


def unwrap_redirect(url: Column) -> Column:
    """The target of a search engine's redirect."""
    wrapped = url.rlike("^(https?://www\\.google\\.[a-z.]+)?/url\\?")
    return F.when(wrapped, url_decode(extract(url, "[?&]q=([^&]+)"))).otherwise(url)


def clean_url(url: Column) -> Column:
    """Redirects unwrapped, tracking parameters dropped, what joined them tidied."""
    out = F.regexp_replace(unwrap_redirect(F.btrim(url)), f"(?i)([?&])({TRACKING})=[^&#]*", "$1")
    out = F.regexp_replace(out, "([?&])&+", "$1")
    return blank_to_null(F.regexp_replace(out, "[?&]+(#|$)", "$1"))


def canonical_url(url: Column) -> Column:
    """Scheme and host in lower case, one slash at a time, no campaign parameters, no fragment."""
    u = F.regexp_replace(F.btrim(url), "#.*$", "")
    scheme = F.coalesce(F.lower(extract(u, "^([A-Za-z][A-Za-z0-9+.-]*)://")), F.lit("https"))
    rest = F.regexp_replace(u, "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_replace(F.regexp_extract(rest, "^([^/?]*)", 1), ":\\d+$", ""))
    path = F.regexp_replace(F.coalesce(extract(rest, "^[^/?]*(/[^?]*)"), F.lit("/")), "/{2,}", "/")
    params = F.filter(F.split(F.regexp_extract(rest, "\\?(.*)$", 1), "&"), lambda q: (q != "") & ~q.rlike(f"^({CANONICAL_DROPS})"))
    query = F.when(F.size(params) > 0, F.concat(F.lit("?"), F.array_join(params, "&"))).otherwise("")
    return F.concat(scheme, F.lit("://"), host, path, query)


def site_of(url: Column) -> Column:
    return F.regexp_replace(F.lower(F.regexp_extract(url, "^[a-zA-Z]+://([^/?#:]+)", 1)), "^www\\.", "")


def phone_e164(x: Column) -> Column:
    """A phone number with its country; null where there is no telling."""
    marked = F.regexp_replace(x, "[^0-9+]", "")
    number = F.when(marked.startswith("+"), marked).otherwise(F.replace(marked, F.lit("+"), F.lit("")))
    number = F.regexp_replace(F.regexp_replace(number, "^00", "+"), "^0", COUNTRY)
    return F.when(number.startswith("+"), number)


def postcode(x: Column) -> Column:
    """Five digits: those after a comma, else those before a name, else the first; house numbers can have five, too."""
    return F.coalesce(extract(x, ",\\s*(?:D-\\s?)?(\\d{5})\\b(?!\\s*[-/])"), extract(x, "\\b(\\d{5})\\s+\\p{L}"), extract(x, "\\b(\\d{5})\\b"))


_NUMBER = "\\d+\\s*[a-zA-Z]?(?:\\s*[-/]\\s*\\d+\\s*[a-zA-Z]?)?"


def street(x: Column, cleaned: bool = False) -> Column:
    return blank_to_null(F.btrim(F.regexp_replace(x if cleaned else clean_text(x), f"\\s+{_NUMBER}\\s*$", "")))


def house_number(x: Column, cleaned: bool = False) -> Column:
    return blank_to_null(F.btrim(F.regexp_extract(x if cleaned else clean_text(x), f"\\s({_NUMBER})\\s*$", 1)))


def street_key(x: Column) -> Column:
    """Street and number in one form: folded, the words for street alike."""
    return F.regexp_replace(fold(x), "(strasse|str\\.?)( |$)", "strasse$2")


def json_array(x: Column, element: str = "string") -> Column:
    """The elements of a JSON array; none for null, scalars, objects and what doesn't parse."""
    return F.coalesce(F.when(F.btrim(x).startswith("["), F.from_json(x, f"array<{element}>")), F.array().cast(f"array<{element}>"))


def json_text(x: Column, path: str) -> Column:
    return blank_to_null(F.get_json_object(x, path))


def social_handle(x: Column, host: str) -> Column:
    """A handle from a profile address or @name; null unless it can be one."""
    bare = F.lower(F.regexp_replace(F.regexp_replace(F.regexp_replace(x, f"^.*{host}\\.com/", ""), "[/?].*$", ""), "@", ""))
    return F.when(bare.rlike("^[a-z0-9_.\\-]{2,60}$"), bare)


def uuid_of(x: Column) -> Column:
    """An id in UUID form from the MD5 of a key."""
    return F.regexp_replace(F.md5(x), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def tags_of(x: Column, mark: str) -> Column:
    """Lower-case words after a mark such as # or @, in order."""
    return F.transform(F.regexp_extract_all(x, F.lit(f"{mark}([a-zA-Z0-9_äöüß]+)"), 1), F.lower)


def attribute_flags(text: Column, patterns: dict[str, str]) -> Column:
    """A struct of booleans, one for each pattern that a folded text may match."""
    return F.struct(*[text.rlike(p).alias(k) for k, p in patterns.items()])


def hash_of(cols: Sequence[Column], missing: str = "∅") -> Column:
    return F.md5(F.concat_ws("||", *[F.coalesce(c.cast("string"), F.lit(missing)) for c in cols]))

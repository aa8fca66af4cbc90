"""Expressions and operators on small tables, with nulls, ties and empty input."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from obsidio.functions import calendar, clean, similarity, text
from obsidio.operators import joins, resolve, windows
from obsidio.sources import files, raw


def one(spark, expr, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr(F.col("x")).alias("y")).first()[0]


@pytest.mark.parametrize(
    ("f", "value", "expected"),
    [
        (clean.clean_text, "  a &amp; b​\n c ", "a & b c"),
        (clean.clean_text, "   ", None),
        (clean.clean_text, None, None),
        (clean.fold, "Döner Größe", "doener groesse"),
        (clean.name_key, "Café Übersee GmbH", "uebersee"),
        (clean.parse_count, "1,2 Tsd.", 1200),
        (clean.parse_count, "1.234", 1234),
        (clean.parse_count, "many", None),
        (clean.domain, "HTTPS://www.Example.co.uk./x", "example.co.uk"),
        (clean.registrable_domain, "https://a.b.example.co.uk/x", "example.co.uk"),
        (clean.clean_url, "https://e.com/a?utm_source=x&b=1&gclid=2", "https://e.com/a?b=1"),
        (clean.clean_url, "/url?q=https%3A%2F%2Fe.com%2F&sa=1", "https://e.com/"),
        (clean.canonical_url, "HTTP://E.com//a//b?utm_x=1&c=2#f", "http://e.com/a/b?c=2"),
        (clean.phone_e164, "030 / 123", "+4930123"),
        (clean.phone_e164, "0043 1", "+431"),
        (clean.phone_e164, "123", None),
        (clean.postcode, "Weg 1, 10115 Stadt", "10115"),
        (clean.street, "Lange Straße 12 a", "Lange Straße"),
        (clean.house_number, "Lange Straße 12a", "12a"),
        (clean.uuid_of, "a", "0cc175b9-c0f1-b6a8-31c3-99e269772661"),
    ],
)
def test_clean(spark, f, value, expected):
    assert one(spark, f, value) == expected


@pytest.mark.parametrize(("value", "expected"), [("1.234,50", 1234.5), ("12,90 €", 12.9), ("€12.90", 12.9), ("free", None), (None, None)])
def test_money(spark, value, expected):
    found = one(spark, clean.parse_money, value)
    assert (None if found is None else float(found)) == expected


def test_nfc_joins_combining_marks(spark):
    assert one(spark, lambda x: clean.clean_text(x), "é") == "é"


def test_similarity():
    assert round(similarity.winkler("martha", "marhta"), 4) == 0.9611
    assert similarity.token_set_ratio("a b", "b a c") == 100.0
    assert similarity.winkler("", "a") == 0.0


def test_pseudonym_needs_a_salt(spark):
    with pytest.raises(ValueError):
        similarity.pseudonym(F.lit("x"), "n", "")


def test_calendar_dates():
    r = calendar.Rule
    assert calendar.days_of(r("x", "hijri", (9, 1)), 2027) == [dt.date(2027, 2, 8)]
    assert calendar.days_of(r("x", "easter", (47,)), 2027) == [dt.date(2027, 5, 14)]
    assert calendar.days_of(r("x", "weekday", (5, 6, 2)), 2027) == [dt.date(2027, 5, 9)]
    assert calendar.days_of(r("x", "persian", (9, 30)), 2026) == [dt.date(2026, 12, 21)]
    assert len(calendar.days_of(r("x", "month_end"), 2026)) == 12
    assert calendar.days_of(r("x", "advent", (1,)), 2026) == [dt.date(2026, 11, 29)]


def test_latest_by_is_null_safe_and_empty_safe(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, 2, "b"), (None, 1, "c")], "k int, t int, v string")
    out = {r.k: r.v for r in windows.latest_by(df, ["k"], [F.desc_nulls_last("t")]).collect()}
    assert out == {1: "b", None: "c"}
    assert windows.latest_by(df.limit(0), ["k"], [F.desc("t")]).count() == 0


def test_scd2_versions(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "a"), (1, 3, None), (1, 4, "a")], "k int, t int, v string")
    out = [(r.version, r.v, r.valid_from, r.valid_to, r.is_current) for r in windows.scd2(df, ["k"], ["t"], ["v"]).orderBy("version").collect()]
    assert out == [(1, "a", 1, 3, False), (2, None, 3, 4, False), (3, "a", 4, None, True)]


def test_features_ignore_what_comes_later(spark, sf):
    from obsidio.plans.history import customer_features
    from obsidio.session import load

    customers, orders = load(spark, sf, "customer"), load(spark, sf, "orders")
    later = orders.filter(F.col("o_orderdate") > F.lit("1998-01-01").cast("timestamp_ntz"))
    changed = orders.unionByName(later.withColumn("o_totalprice", F.col("o_totalprice") * 9).withColumn("o_orderkey", F.col("o_orderkey") + 10**9))
    a, b = (sorted(map(str, customer_features(customers, o, "1998-01-01").collect())) for o in (orders, changed))
    assert a == b


def test_as_of_takes_the_last_row_before(spark):
    left = spark.createDataFrame([(1, 5), (1, 0), (2, 5)], "k int, t int")
    right = spark.createDataFrame([(1, 1, "a"), (1, 5, "b"), (1, 6, "c")], "k int, s int, v string")
    out = sorted((r.k, r.t, r.v) for r in joins.as_of(left, right, ["k"], "t", "s", ["v"]).collect())
    assert out == [(1, 0, None), (1, 5, "b"), (2, 5, None)]


def test_polygon_border_is_inside(spark):
    ring = [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)]
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 1.0), (0.0, 0.0), (2.1, 1.0)], "x double, y double")
    assert [r[0] for r in df.select(joins.point_in_polygon(F.col("x"), F.col("y"), ring)).collect()] == [True, True, True, False]


def test_greedy_clusters_respect_exclusive_kinds_and_span():
    kinds = {1: "a", 2: "b", 3: "a", 4: "c"}
    places = {1: (52.0, 13.0), 2: (52.0, 13.0), 3: (52.0, 13.0), 4: (53.0, 13.0)}
    out = resolve.greedy_clusters([(1, 2, 0.9), (2, 3, 0.95), (1, 4, 0.99)], kinds, places, {"a"}, 400.0)
    assert out == {1: 1, 2: 2, 3: 2, 4: 4}


def test_page_extraction():
    page = '<html lang="de"><head><title> A &amp; B </title><meta name="description" content="d"><script type="application/ld+json">{"b":1,"a":2}</script></head><body>Hi <a href="https://instagram.com/foo_1/">x</a> mail a@b.de 030 123 45 67</body></html>'
    out = text.extract_page(page)
    assert (out["title"], out["lang"], out["description"]) == ("A & B", "de", "d")
    assert out["socials"] == {"instagram": "foo_1"} and out["emails"] == ["a@b.de"] and out["json_ld"] == ['{"a": 2, "b": 1}']
    assert text.extract_page(None)["text"] == ""


def test_payload_address_ignores_key_order(spark):
    df = spark.createDataFrame([('{"b":1,"a":2}',), ('{"a": 2, "b": 1}',), (None,)], "payload string").withColumn("fetched_at", F.current_timestamp())
    payloads, pointers = raw.content_address(df)
    assert payloads.count() == 2 and pointers.count() == 3
    assert raw.append_payloads(payloads, payloads).count() == 0


def test_drift_finds_new_paths_only(spark):
    batch = spark.createDataFrame([("s", "e", '{"x":1,"y":{"z":2}}')], "source string, entity_type string, payload string")
    known = spark.createDataFrame([("s", "e", "x")], "source string, entity_type string, field_path string")
    assert sorted(r.field_path for r in raw.drift(batch, known).collect()) == ["y", "y.z"]
    assert raw.drift(batch, known.limit(0)).count() == 0


def test_lossless_split_comes_back(spark):
    whole = {"a": "1", "b": "2", "c": "3"}
    df = spark.createDataFrame([(json.dumps(whole),)], "j string")
    stable, moved = raw.split_lossless(F.col("j"), ["b"])
    row = df.select(stable.alias("s"), moved.alias("m")).select(raw.merge_split(F.col("s"), F.col("m")).alias("w"), "s", "m").first()
    assert row.w == whole and row.m == {"b": "2"}


def test_statistics_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id;n;m\nx;1.234,5;–\ny;7;abc\n", encoding="utf-8")
    out = files.read_statistics_csv(spark, f"file://{tmp_path}/a.csv", ["id"]).orderBy("id").collect()
    assert [tuple(r) for r in out] == [("x", 1234.5, None), ("y", 7.0, None)]


def test_upsert_prefers_newer_rows(spark):
    a = spark.createDataFrame([(1, 1, "old"), (2, 5, "kept")], "k int, t int, v string")
    b = spark.createDataFrame([(1, 1, "new"), (2, 4, "late"), (3, 1, "added")], "k int, t int, v string")
    assert {r.k: r.v for r in files.upsert(a, b, ["k"], "t").collect()} == {1: "new", 2: "kept", 3: "added"}


def test_shapes_have_no_depth_and_no_item_limit():
    assert raw.shape('{"a": {"b": [{"c": 1}, {"d": [[{"e": null}]]}]}, "f": 2}') == ["a", "a.b", "a.b[].c", "a.b[].d", "a.b[].d[][].e", "f"]
    deep = "".join(f'{{"k{i}":' for i in range(30)) + "1" + "}" * 30
    assert raw.shape(deep)[-1] == ".".join(f"k{i}" for i in range(30))
    many = json.dumps([{"a": 1}] * 500 + [{"z": {}}])
    assert raw.shape(many) == ["[].a", "[].z"]
    assert [raw.shape(x) for x in (None, "", "{", "3", "[]", "{}")] == [[]] * 6
    assert raw.shape("[" * 100_000) == []


@pytest.mark.parametrize(
    ("value", "expected"),
    [("1.234", 1234), ("12.345,6", 12345.6), ("1,234", 1.23), ("1,234.5", 1234.5), ("1,234,567", 1234567), ("-1.234,50 €", -1234.5), ("1.234,", 1.23), (",5", 5), ("12.34.5", None), ("1-2", None), ("", None)],
)
def test_money_forms(spark, value, expected):
    found = one(spark, clean.parse_money, value)
    assert (None if found is None else float(found)) == expected


@pytest.mark.parametrize(("value", "expected"), [("3 Mio.", 3_000_000), ("1.2K", 1200), ("2k.", None), ("1 million", 1_000_000), ("12.34", None), (" 7 ", 7), ("1.234.567", 1234567), ("1.234,5 k", None), ("", None), (None, None)])
def test_count_forms(spark, value, expected):
    assert one(spark, clean.parse_count, value) == expected


def test_decomposed_letters(spark):
    assert one(spark, clean.fold, "Döner") == "doener" and one(spark, clean.name_key, "Café Döner") == "doener"

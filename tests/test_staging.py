"""Staging builders on synthetic payloads of the documented shapes."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from obsidio.functions import geo
from obsidio.sources import staging


def rows(spark, *payloads):
    data = [(f"o{i}", "cell", dt.datetime(2026, 1, 1 + i), None if p is None else json.dumps(p)) for i, p in enumerate(payloads)]
    return spark.createDataFrame(data, "observation_id string, natural_key string, fetched_at timestamp, payload string")


def test_venues(spark):
    item = {"title": "x", "venue": {"id": "v1", "name": " A &amp; B ", "location": [13.4, 52.5], "delivers": True, "rating": {"score": 8.4, "volume": 10}, "tags": ["pizza"]}, "sorting": {"sortables": [{"id": "rating", "value": 3}]}}
    df = rows(spark, [item, {"venue": {"id": "v2"}}], None)
    a, b = staging.venue_listing(df).orderBy("list_rank").collect()
    assert (a.venue_id, a.name, a.lat, a.lon, float(a.rating_value), a.cuisine_tags, a.list_rank) == ("v1", "A & B", 52.5, 13.4, 8.4, ["pizza"], 1)
    assert b.venue_id == "v2" and b.name is None
    a, b = staging.venue_coverage(df).orderBy("list_rank").collect()
    assert (a.offered, a.sort_rating, a.sort_distance, b.offered) == (True, 3, None, False)


def test_posts_keep_the_latest(spark):
    post = {"id": "p", "title": "t", "selftext": "hello", "created_utc": 0, "is_self": True, "score": 1, "url": "https://www.e.com/x"}
    out = staging.archive_post(rows(spark, {"data": [post]}, {"data": [post | {"selftext": "[removed]", "score": 2}]})).collect()
    assert [(r.post_id, r.caption, r.score, r.post_type, r.link_domain) for r in out] == [("p", None, 2, "text", "e.com")]


def test_events(spark):
    out = staging.event_feed(rows(spark, {"index": [{"id": 1, "bezeichnung": "Fest", "plz": "10115 Berlin", "von": "03.05.2026", "bis": "x"}]})).first()
    assert (out.starts, out.ends, out.postcode) == (dt.date(2026, 5, 3), dt.date(2026, 5, 3), "10115")


def test_positional_record(spark):
    record = [None] * 204
    record[4] = [None] * 7 + [4.6, 120]
    record[7], record[9], record[10], record[11], record[13], record[78], record[178] = ["https://e.com/?utm_source=g"], [None, None, 52.5, 13.4], "f", "Name", ["Café"], "pid", [[None, None, None, "030 12"]]
    out = staging.positional_place(rows(spark, record, [1, 2])).orderBy("observation_id").collect()
    a = out[0]
    assert (a.place_id, a.name, a.lat, a.lon, float(a.rating), a.rating_count, a.website, a.phone, a.categories, a.closed) == ("pid", "Name", 52.5, 13.4, 4.6, 120, "https://e.com/", "+493012", ["Café"], False)
    assert out[1].place_id is None


@pytest.mark.parametrize(("iso", "seconds"), [("PT1H2M", 3720), ("PT15S", 15), ("P1DT1S", 86401), ("1h", None), ("P", None), (None, None)])
def test_durations(spark, iso, seconds):
    assert spark.createDataFrame([(iso,)], "x string").select(staging.duration_seconds(F.col("x"))).first()[0] == seconds


def test_video(spark):
    out = staging.video(rows(spark, {"items": [{"id": "v", "snippet": {"title": "t", "publishedAt": "2026-01-01T00:00:00Z"}, "contentDetails": {"duration": "PT1M"}, "statistics": {"viewCount": "7"}}]})).first()
    assert (out.video_id, out.duration_s, out.views, out.likes) == ("v", 60, 7, None)


def test_sheet(spark):
    cells = spark.createDataFrame([("s", 1, "Mitte", "1.234", "–"), ("s", 2, "", "2,5", "x"), ("s", 3, "Pankow", "3", "4")], "sheet string, row_no int, area string, a string, b string")
    out = [(r.row_no, r.area, r.column_label, r.value) for r in staging.sheet_long(cells, ["area"], "row_no", ["a", "b"]).orderBy("row_no", "column_label").collect()]
    assert out == [(1, "Mitte", "a", 1234.0), (2, "Mitte", "a", 2.5), (3, "Pankow", "a", 3.0), (3, "Pankow", "b", 4.0)]


def test_equal_area_coordinates(spark):
    lat, lon = geo.laea_to_wgs84(F.col("x"), F.col("y"))
    out = spark.createDataFrame([(4321000.0, 3210000.0), (3962799.45, 2999718.85)], "x double, y double").select(lat, lon).collect()
    assert out[0][0] == pytest.approx(52.0, abs=1e-7) and out[0][1] == pytest.approx(10.0, abs=1e-7)
    assert out[1][0] == pytest.approx(50.0, abs=1e-4) and out[1][1] == pytest.approx(5.0, abs=1e-4)


def test_sun_rises_before_it_sets(spark):
    df = spark.createDataFrame([(dt.date(2026, 6, 21), 52.5, 13.4), (dt.date(2026, 6, 21), 80.0, 13.4)], "d date, lat double, lon double")
    rise, sets = (geo.sun_time(F.col("d"), F.col("lat"), F.col("lon"), rising=r) for r in (True, False))
    a, b = df.select(rise.alias("rise"), sets.alias("set")).collect()
    assert 150 < a["rise"] < 180 and 1150 < a["set"] < 1190 and b["rise"] is None

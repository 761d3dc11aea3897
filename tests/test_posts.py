"""Fixtures for the post operators: location, window, fallback, normalisation, text, map."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from postatlas.config import Config
from postatlas.functions import geo, text, times
from postatlas.operators import collect, locate, mapview, normalize
from postatlas.sources import live
from postatlas.sources.sample import sample_posts

def now():
    return F.lit(dt.datetime(2024, 1, 30, 12, 0, tzinfo=dt.timezone.utc))


POST = "id string, text string, tags array<string>, authorLocation string, geo struct<lat:double,lon:double>"


def estimates(spark, *rows):
    df = spark.createDataFrame([(str(i), *r) for i, r in enumerate(rows)], POST)
    return [r.estimate for r in locate.with_estimate(df).orderBy(F.col("id").cast("int")).select("estimate").collect()]


def test_geotag_wins_text_and_profile(spark):
    nan, inf = float("nan"), float("inf")
    e = estimates(spark, ("博多ラーメン", None, None, (35.69, 139.69)), ("喜多方ラーメンの朝ラー最高 #ラーメン", None, None, None), ("東京の博多で豚骨", [], None, None), ("", ["ラーメン"], "札幌", None), ("おいしい🍜", None, None, None), ("仙台", None, None, (nan, inf)), ("", None, None, (0.0, 0.0)), ("", None, None, (43.06, 141.35)))
    assert (e[0].confidence, e[0].method, e[0].lat, e[0].lon) == ("high", "geotag", 35.69, 139.69)
    assert "喜多方" in e[1].label and abs(e[1].lat - 37.65) < 0.06 and abs(e[1].lon - 139.87) < 0.06
    assert e[2].label.startswith("博多") and e[2].confidence == "medium"
    assert e[3].label.startswith("札幌") and e[4] is None and e[5].label == "仙台"
    assert e[6].label == "位置情報あり" and e[6].pref is None
    assert e[7].label == "札幌（札幌ラーメン） 付近"


@pytest.mark.parametrize("words, label, score", [("東京都", "東京都", 103), ("京都", "京都府", 102), ("東京都市大学", "京都（京都ラーメン）", 303), ("家系 博多", "横浜（家系ラーメン）", 302), ("台湾ラーメン 博多", "名古屋", 306), ("長崎の長浜", "博多（博多ラーメン）", 302), ("Sagamihara", "佐賀県", 104), ("Miele", "三重県", 103), ("大阪 難波 なんば", "大阪", 302), ("hokkaido", None, None)])
def test_gazetteer_scores(spark, words, label, score):
    b = spark.range(1).select(locate.best_place(F.lit(words)).alias("b")).first().b
    assert (b and (b.label, b.score)) == (label and (label, score))


def test_hash_vectors_and_jitter(spark):
    r = spark.range(1).select(geo.fnv1a(F.lit("a")), geo.fnv1a(F.lit("foobar")), geo.fnv1a(F.lit("sample:0lat")), F.array_join(geo.utf16_units(F.lit("a🍜")).cast("array<string>"), ",")).first()
    assert tuple(r) == (3826002220, 3214735720, 2273993998, "97,55356,57180")


def test_sample_golden(spark):
    e = collect.envelope(collect.collect_posts(None, sample_posts(spark, now()), now(), force_sample=True), now(), 60).first()
    assert e.demo and tuple(e.counts) == (20, 20, 0)
    assert [p.id.split(":")[1] for p in e.posts] == "0 8 16 1 9 17 2 10 18 3 11 19 4 12 5 13 6 14 7 15".split()
    by = {p.id: p for p in e.posts}
    assert (round(by["sample:4"].lat, 4), round(by["sample:4"].lon, 4)) == (35.7046, 139.7151)
    assert by["sample:9"].locationLabel == "京都（京都ラーメン）" and by["sample:10"].locationLabel == "大阪府 付近"
    assert '"url":null' in e.json and by["sample:0"].tags == ["札幌", "ラーメン", "味噌ラーメン"]


def test_window_edges(spark):
    times_ = {"keep": ["2024-01-30T11:00:00.000Z", "2024-01-30T12:01:00.000Z", "2024-01-30T20:30:00+09:00"], "drop": ["2024-01-30T10:59:59.999Z", "2024-01-30T12:01:00.001Z", "16:58", "x", None]}
    df = spark.createDataFrame([(k, v) for k, vs in times_.items() for v in vs], "k string, createdAt string")
    assert {r.k for r in collect.window_filter(df, now(), 60).collect()} == {"keep"}
    assert collect.window_filter(df, now(), 60).count() == 3


def test_fallback_rules(spark):
    sample = sample_posts(spark, now())
    lively = sample.limit(1).withColumn("ord", F.struct(F.lit(0).alias("s"), F.col("ord").alias("o")))
    old = lively.withColumn("createdAt", F.lit("2020-01-01T00:00:00Z"))

    def run(posts, **k):
        rows = collect.collect_posts(posts, sample, now(), **k).select("demo").collect()
        return len(rows), {r.demo for r in rows}

    assert run(old) == (20, {True}) and run(lively) == (1, {False})
    assert run(old, use_fallback=False) == (0, set())
    assert run(old, use_fallback=False, force_sample=True) == (20, {True})


def test_mastodon(spark):
    def status(id, url, media, name="", user="u", content="<p>x</p>"):
        return {"id": id, "url": url, "content": content, "created_at": "2024-01-30T11:30:00Z", "media_attachments": media, "tags": [{"name": "t"}], "account": {"display_name": name, "username": user, "acct": "a"}}

    image, video = {"type": "image", "preview_url": "", "url": "f"}, {"type": "video", "url": "v"}
    bodies = [(0, "i1", live.to_body([status("1", "u1", [video]), status("2", "u2", [image], name="N")])), (1, "i2", live.to_body([status("9", "u2", [image]), status("3", None, [{"type": "gifv", "url": "g", "preview_url": "p"}], user="")])), (2, "i3", '{"error": 1}')]
    rows = normalize.normalize_mastodon(live.parse_timelines(spark.createDataFrame(bodies, "job long, instance string, body string"))).orderBy("ord").collect()
    assert [(r.id, r.author, r.image, r.imageFull, r.authorHandle) for r in rows] == [("mastodon:i1:2", "N", "f", "f", "@a"), ("mastodon:i2:3", "unknown", "p", "g", "@a")]


def test_x(spark):
    import json

    body = json.dumps({"data": [{"id": "1", "text": "t", "author_id": "u", "attachments": {"media_keys": ["no", "v", "p"]}, "geo": {"place_id": "pl", "coordinates": {"coordinates": [1.0, 2.0]}}, "entities": {"hashtags": [{"tag": "h"}]}}, {"id": "2", "attachments": {"media_keys": ["v"]}}, {"id": "3", "author_id": "z", "attachments": {"media_keys": ["p"]}, "geo": {"coordinates": {"coordinates": [5.0, 6.0]}}}], "includes": {"media": [{"media_key": "v", "type": "video"}, {"media_key": "p", "type": "photo", "url": "full"}], "users": [{"id": "u", "name": "old"}, {"id": "u", "name": "new", "username": "n", "location": "L"}], "places": [{"id": "pl", "geo": {"bbox": [10.0, 20.0, 30.0, 40.0]}}]}})
    rows = normalize.normalize_x(live.parse_search(spark.createDataFrame([(body,), ("nonsense",)], "body string"))).orderBy("ord").collect()
    assert [(r.id, r.author, r.authorHandle, r.image, tuple(r.geo)) for r in rows] == [("x:1", "new", "@n", "full", (30.0, 20.0)), ("x:3", "unknown", None, "full", (6.0, 5.0))]


def test_text_functions(spark):
    r = spark.range(1).select(text.html_to_text(F.lit("　<p>a<BR/>b</p><p>c</p>")), text.html_to_text(F.lit("&amp;lt;&nbsp;")), text.html_to_text(F.lit(None).cast("string")), text.escape_html(F.lit("<a&'\">")), text.encode_uri(F.lit("a b'家")), text.image_number(F.lit("/x/ramen-07.svg")), text.image_number(F.lit("x")), text.guard_script(F.lit("a</SCRIPT>")), text.to_fixed(F.lit(1234.05), 1)).first()
    assert tuple(r) == ("a\nb\nc", "&lt;&nbsp;".replace("&lt;", "<"), "", "&lt;a&amp;&#39;&quot;&gt;", "a%20b'%E5%AE%B6", "7", None, "a<\\/script>", 1234.0)


def test_times(spark):
    def ago(seconds):
        return spark.range(1).select(times.time_ago(now() - F.make_dt_interval(secs=F.lit(float(seconds))), now())).first()[0]

    assert [ago(s) for s in (-5, 59, 60, 3599, 3600)] == ["0秒前", "59秒前", "1分前", "59分前", "1時間前"]


def test_projection_corners(spark):
    b = spark.createDataFrame([(130.0, 140.0, 30.0, 40.0)], "minLon double, maxLon double, minLat double, maxLat double")
    p = mapview.project(spark.createDataFrame([(130.0, 40.0), (140.0, 30.0)], "lon double, lat double"), b).orderBy("lon").collect()
    h = mapview.projection(b).first().height
    assert (round(p[0].x, 9), round(p[0].y, 9)) == (20, 20) and (round(p[1].x, 9), round(p[1].y - (h - 20), 9)) == (980, 0)
    empty = spark.createDataFrame([], "feature int, name string, polygons array<array<array<array<double>>>>")
    assert tuple(mapview.map_bounds(empty).first()) == (1e9, -1e9, 1e9, -1e9)


def test_static_page_and_config(spark):
    pins = mapview.static_pins(collect.located(sample_posts(spark, now())), now())
    images = spark.createDataFrame([("/i/ramen-01.svg", bytearray(b"<svg a='1'/>")), ("/i/x.svg", bytearray(b""))], "path string, content binary")
    html = mapview.static_page("G=/*__GEOJSON__*/;P=/*__POSTS__*/;I=/*__IMAGES__*/", spark.createDataFrame([('{"a":"</script>"}',)], "json string"), pins, mapview.image_table(images)).first().html
    assert "<\\/script>" in html and html.count('"minutesAgo"') == 20 and "%3Csvg%20a%3D'1'%2F%3E" in html
    c = Config.from_env({"RAMEN_TAGS": " a, ,b", "USE_SAMPLE_FALLBACK": "false", "WINDOW_MINUTES": "0"})
    assert c.tags == ("a", "b") and not c.use_fallback and c.window_minutes == 0


def test_failing_source_is_empty(spark):
    live.register(spark)
    assert spark.read.format("tag_timelines").option("instances", "127.0.0.1:1").option("tags", "a").option("timeout", "1").load().count() == 0
    assert spark.read.format("recent_search").load().count() == 0

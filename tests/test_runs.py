"""Whole runs: collection under the settings, the JSON face, the static page; and the normalisers' lookups."""

import datetime as dt
import json
import threading
import urllib.error
import urllib.request

import pytest
from pyspark.sql import functions as F

from postatlas import run, service
from postatlas.config import Config
from postatlas.operators import collect, mapview, normalize
from postatlas.sources import live
from postatlas.sources.sample import sample_posts

NOW = dt.datetime(2024, 1, 30, 12, 0, tzinfo=dt.timezone.utc)


def now():
    return F.lit(NOW)


def captured(statuses, tweets=None):
    """A stand-in for the live sources: captured bodies, read as live ones are."""

    def posts(spark, config):
        bodies = spark.createDataFrame([(0, config.instances[0], json.dumps(statuses)), (1, "down", "<html>502</html>")], "job long, instance string, body string")
        search = spark.createDataFrame([(json.dumps(tweets),)] if config.x_token else [], "body string")
        return collect.union_sources(normalize.normalize_mastodon(live.parse_timelines(bodies)), normalize.normalize_x(live.parse_search(search)))

    return posts


def status(id, minutes, content="博多", media="image"):
    t = (NOW - dt.timedelta(minutes=minutes)).strftime("%Y-%m-%dT%H:%M:%S.000Z")
    return {"id": id, "url": f"u{id}", "content": content, "created_at": t, "media_attachments": [{"type": media, "url": "f", "preview_url": "p"}], "tags": [], "account": {"username": "n"}}


TWEETS = {"data": [{"id": "5", "text": "仙台", "created_at": "2024-01-30T11:59:00.000Z", "author_id": "1", "attachments": {"media_keys": ["k"]}}], "includes": {"media": [{"media_key": "k", "type": "photo", "url": "old"}, {"media_key": "k", "type": "photo", "url": "new"}], "users": [{"id": "1", "name": "first"}, {"id": "1", "name": "last"}]}}


def test_a_run_under_settings(spark):
    config = Config.from_env({"MASTODON_INSTANCES": "a.example", "WINDOW_MINUTES": "30", "X_BEARER_TOKEN": "t"})
    source = captured([status("1", 10), status("2", 31), status("3", 5, "nowhere"), status("4", 1, media="video")], TWEETS)
    got = json.loads(run.response(spark, config, live=source, now=now()))
    assert (got["demo"], got["windowMinutes"], got["generatedAt"]) == (False, 30.0, "2024-01-30T12:00:00.000Z")
    assert got["counts"] == {"collected": 3, "located": 2, "unlocated": 1}
    assert [p["id"] for p in got["posts"]] == ["x:5", "mastodon:a.example:1"]
    assert (got["posts"][0]["author"], got["posts"][0]["image"]) == ("last", "new")
    assert [p["id"] for p in json.loads(run.response(spark, Config(), live=source, now=now()))["posts"]] == ["mastodon:pawoo.net:1", "mastodon:pawoo.net:2"]


def test_fallback_and_forced_sample(spark):
    old = captured([status("1", 500)])
    assert json.loads(run.response(spark, Config(), live=old, now=now()))["counts"]["collected"] == 20
    empty = json.loads(run.response(spark, Config(use_fallback=False), live=old, now=now()))
    assert (empty["demo"], empty["posts"]) == (False, [])

    def never(spark, config):
        raise AssertionError("a forced sample calls no source")

    forced = json.loads(run.response(spark, Config(use_fallback=False), force_sample=True, live=never, now=now()))
    assert forced["demo"] and len(forced["posts"]) == 20


def test_live_sources_without_network(spark):
    config = Config(instances=("127.0.0.1:9",), tags=("a", "b"), timeout_seconds=2.0, x_token=None)
    assert live.live_posts(spark, config).count() == 0
    assert json.loads(run.response(spark, config, now=now()))["demo"]


def test_one_deadline_for_all_calls(monkeypatch):
    waits = []
    monkeypatch.setattr(live, "_get", lambda url, headers, timeout: waits.append(timeout) or "[]")
    r = live._Reader([live._Job(0, "i", "u"), live._Job(1, "i", "u")], {}, 8.0)
    assert list(r.read(r.jobs[0])) == [(0, "i", "[]")] and 0 < waits[0] <= 8
    r.deadline -= 9
    assert list(r.read(r.jobs[1])) == [] and len(waits) == 1


def test_routes(tmp_path):
    (tmp_path / "index.html").write_text("home")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.svg").write_text("<svg/>")
    (tmp_path.parent / "secret.txt").write_text("no")

    def respond(sample):
        if sample:
            raise ValueError("broken")
        return '{"posts":[]}'

    s = service.server(respond, tmp_path, port=0)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{s.server_address[1]}"

    def get(path):
        try:
            with urllib.request.urlopen(base + path, timeout=10) as r:
                return r.status, r.read().decode(), r.headers
        except urllib.error.HTTPError as e:
            return e.code, e.read().decode(), e.headers

    assert get("/api/health")[:2] == (200, '{"ok":true}')
    status, body, headers = get("/api/posts?sample=0")
    assert (status, body, headers["Cache-Control"]) == (200, '{"posts":[]}', "no-store") and run.client_posts(body) == []
    assert get("/api/posts?sample=1")[:2] == (500, '{"error": "broken"}')
    assert get("/")[1] == "home" and get("/")[2]["Cache-Control"] == "no-cache"
    assert get("/sub/a.svg")[2]["Content-Type"] == "image/svg+xml" and get("/sub/a.svg")[2]["Cache-Control"] == "public, max-age=3600"
    for path in ("/none.js", "/../secret.txt", "/%2e%2e/secret.txt"):
        assert get(path)[:2] == (404, "404 Not Found")
    s.shutdown()


def test_static_page_from_files(spark, tmp_path):
    ring = [[130.0, 30.0], [140.0, 30.0], [140.0, 40.0]]
    (tmp_path / "map.json").write_text(json.dumps({"features": [{"geometry": {"coordinates": [[ring], [ring[:2]]]}, "properties": {"nam_ja": "</script>"}}, {"geometry": {"coordinates": [[[[120.0, 20.0]]]]}, "properties": {"nam_ja": "b"}}]}))
    images = tmp_path / "images"
    images.mkdir()
    for name, body in (("ramen-01.svg", "<svg a='1'/>"), ("ramen-1.svg", "<svg>later</svg>"), ("ramen-10.svg", "<b/>"), ("readme.txt", "x")):
        (images / name).write_text(body)
    shapes, bounds = run.map_features(spark, str(tmp_path / "map.json"))
    assert [(r.feature, r.name, len(r.polygons)) for r in shapes.orderBy("feature").collect()] == [(0, "</script>", 2), (1, "b", 1)]
    assert tuple(bounds.first()) == (120.0, 140.0, 20.0, 40.0)
    built = run.build_static(spark, "<x>/*__GEOJSON__*/</x>/*__POSTS__*/|/*__IMAGES__*/", str(tmp_path / "map.json"), str(images), now())
    assert (built.posts, built.images) == (20, 2) and built.kilobytes == round(len(built.html) / 1024)
    assert "</script>" not in built.html and "<\\/script>" in built.html
    table = json.loads(built.html.split("|")[1])
    assert table == {"1": "data:image/svg+xml;utf8,%3Csvg%3Elater%3C%2Fsvg%3E", "10": "data:image/svg+xml;utf8,%3Cb%2F%3E"}
    posts = json.loads(built.html.split("</x>")[1].split("|")[0])
    assert [p["id"] for p in posts][:2] == ["sample:0", "sample:1"] and set(posts[0]) >= {"img", "minutesAgo", "lat", "lon"}


def test_order_of_the_static_page(spark):
    located = collect.located(sample_posts(spark, now()))
    pins = mapview.static_pins(located, now()).withColumn("ord", F.regexp_extract("id", r"(\d+)", 1).cast("int"))
    images = spark.createDataFrame([("1", "x")], "img string, uri string")
    got = [r.ord for r in mapview.page_order(mapview.rehydrate(pins, images, now())).collect()]
    assert got == [0, 8, 16, 1, 9, 17, 2, 10, 18, 3, 11, 19, 4, 12, 5, 13, 6, 14, 7, 15]


@pytest.mark.parametrize("parts", [1, 7])
def test_ranks_are_those_of_the_order(spark, parts):
    p = sample_posts(spark, now()).repartition(parts)
    p = p.unionByName(p.withColumn("ord", F.col("ord") + 20)).withColumn("_n", F.lit(1)).drop("_n")
    got = collect.with_rank(p.select("ord", "createdAt")).collect()
    want = sorted(got, key=lambda r: (-dt.datetime.fromisoformat(r.createdAt).timestamp(), r.ord))
    assert [r.rank for r in want] == list(range(1, 41))


def test_x_is_looked_up_without_a_join(spark):
    body = spark.createDataFrame([(json.dumps(TWEETS),)], "body string")
    plan = normalize.normalize_x(live.parse_search(body))._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan


def test_fallback_with_a_clashing_column(spark):
    s = spark.createDataFrame([(1, 5)], "id int, _n int")
    assert [(r.id, r["_n"], r.demo) for r in collect.with_fallback(s.limit(0), s, True).collect()] == [(1, 5, True)]

"""Queries over captured upstream JSON and over the smaller scalar operators, with the same results as DuckDB SQL.

The JSON bodies are made from the driver tables, so that parsing, filters,
lookups and precedence are held against SQL over the tables themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text, times
from ..operators import collect, locate, mapview
from ..operators.normalize import normalize_mastodon, normalize_x
from ..sources.live import parse_search, parse_timelines
from ..sources.sample import SAMPLES, sample_posts
from .catalog import _DAY, _html, query
from .posts import latest, posts, table


def _nothing(kind: str) -> Column:
    return F.lit(None).cast(kind)


def _bodies(spark: SparkSession, sf: str) -> DataFrame:
    """One response for each document, of two statuses; every 17th is no list."""
    i = F.col("doc_id")

    def media(kind: str, preview: Column) -> Column:
        return F.struct(F.lit(kind).alias("type"), preview.alias("preview_url"), F.concat(F.lit("full"), "doc_id").alias("url"))

    def status(id: Column, url: Column, content: Column) -> Column:
        video, image, gif = media("video", F.lit("v")), media("image", F.concat(F.lit("small"), "doc_id")), media("gifv", F.lit(""))
        chosen = F.element_at(F.array(F.array().cast(f"array<{kind}>"), F.array(video), F.array(video, image), F.array(gif, image)), (i % 4 + 1).cast("int"))
        account = F.struct(F.when(i % 3 != 0, F.concat(F.lit("d"), "doc_id")).otherwise("").alias("display_name"), F.when(i % 2 == 0, F.concat(F.lit("u"), "doc_id")).alias("username"), F.when(i % 5 != 1, F.concat(F.lit("a"), "doc_id")).alias("acct"), F.lit("face").alias("avatar"))
        return F.struct(id.alias("id"), url.alias("url"), content.alias("content"), F.lit("2024-01-02T03:04:05.678Z").alias("created_at"), chosen.alias("media_attachments"), F.array(F.struct(F.col("lang").alias("name")), F.struct(F.col("source").alias("name"))).alias("tags"), account.alias("account"))

    kind = "struct<type:string,preview_url:string,url:string>"
    one = status(F.concat(F.lit("s"), i), F.when(i % 5 != 0, F.concat(F.lit("url"), i % 400)), F.concat(F.lit("<p>"), "text", F.lit("<br>&amp;lt;</p>")))
    two = status(F.concat(F.lit("t"), i), F.concat(F.lit("url"), i % 300), _nothing("string"))
    body = F.when(i % 17 == 0, F.lit('{"error": "no list"}')).otherwise(F.to_json(F.array(one, two)))
    return table(spark, sf, "documents").select(i.alias("job"), F.concat(F.lit("host"), i % 3).alias("instance"), body.alias("body"))


@query(f"""WITH s AS (SELECT doc_id * 1000000 + k AS ord, doc_id, 'host' || doc_id % 3 AS instance, k, CASE WHEN k = 1 THEN 'url' || doc_id % 300 WHEN doc_id % 5 <> 0 THEN 'url' || doc_id % 400 END AS url, CASE WHEN k = 0 THEN {_html("'<p>' || text || '<br>&amp;lt;</p>'")} ELSE '' END AS t, lang || ',' || source AS tags
  FROM documents, (VALUES (0), (1)) v(k) WHERE doc_id % 17 <> 0 AND doc_id % 4 >= 2),
f AS (SELECT arg_min(s, ord) AS s FROM s GROUP BY coalesce(url, instance || ':' || CASE k WHEN 0 THEN 's' ELSE 't' END || doc_id))
SELECT s.ord AS ord, 'mastodon:' || s.instance || ':' || CASE s.k WHEN 0 THEN 's' ELSE 't' END || s.doc_id AS id, 'Mastodon (' || s.instance || ')' AS "sourceLabel", s.url AS url, md5(s.t) AS text_md5, s.tags AS tags,
CASE WHEN s.doc_id % 3 <> 0 THEN 'd' || s.doc_id WHEN s.doc_id % 2 = 0 THEN 'u' || s.doc_id ELSE 'unknown' END AS author, CASE WHEN s.doc_id % 5 <> 1 THEN '@a' || s.doc_id END AS "authorHandle",
CASE s.doc_id % 4 WHEN 2 THEN 'small' || s.doc_id ELSE 'full' || s.doc_id END AS image, 'full' || s.doc_id AS "imageFull" FROM f""")
def mastodon_timelines(spark: SparkSession, sf: str) -> DataFrame:
    p = normalize_mastodon(parse_timelines(_bodies(spark, sf)))
    return p.select("ord", "id", "sourceLabel", "url", F.md5("text").alias("text_md5"), F.array_join("tags", ",").alias("tags"), "author", "authorHandle", "image", "imageFull")


def _responses(spark: SparkSession, sf: str) -> DataFrame:
    """One search response for 50 events each; users, media and places have repeated and missing keys."""
    i, s = F.col("event_id"), lambda *x: F.concat(*(F.lit(y) if isinstance(y, str) else y for y in x))
    media = F.struct(
        s("m", i).alias("media_key"), F.when(i % 2 == 1, "photo").otherwise("video").alias("type"), F.when(i % 4 == 1, s("url", i)).otherwise("").alias("url"), F.when(i % 4 == 2, s("pre", i)).alias("preview_image_url")
    )
    user = F.struct(F.col("user_id").cast("string").alias("id"), F.when(i % 6 != 0, s("name", i)).otherwise("").alias("name"), s("handle", i).alias("username"), s("face", i).alias("profile_image_url"), F.when(i % 3 == 0, s("town", i)).alias("location"))
    corner = F.array(*(x.cast("double") for x in (i % 90, i % 45, i % 90 + 2, i % 45 + 1)))
    place = F.struct(s("p", i % 7).alias("id"), F.struct(F.when(i % 4 != 0, corner).alias("bbox")).alias("geo"))
    point = F.when(i % 3 == 0, F.array((i % 100).cast("double"), (i % 50).cast("double")))
    tweet = F.struct(
        s("", i).alias("id"), s("text ", F.col("event_type")).alias("text"), times.iso(F.col("ts").cast("timestamp")).alias("created_at"), F.when(i % 11 != 0, F.col("user_id").cast("string")).otherwise("nobody").alias("author_id"),
        F.when(i % 13 != 0, F.struct(F.array(F.lit("none"), s("m", (i + 1) % 50 + F.floor(i / 50) * 50), s("m", i)).alias("media_keys"))).alias("attachments"),
        F.when(i % 2 == 0, F.struct(F.array(F.struct(F.col("event_type").alias("tag"))).alias("hashtags"))).alias("entities"),
        F.struct(F.when(i % 5 != 0, s("p", i % 9)).alias("place_id"), F.struct(point.alias("coordinates")).alias("coordinates")).alias("geo"),
    )
    e = table(spark, sf, "events").groupBy(F.floor(i / 50).alias("r")).agg(F.array_sort(F.collect_list(F.struct(i.alias("o"), tweet.alias("t"), media.alias("m"), user.alias("u"), place.alias("p")))).alias("x"))
    x = F.col("x")
    return e.select(F.to_json(F.struct(x["t"].alias("data"), F.struct(x["m"].alias("media"), x["u"].alias("users"), x["p"].alias("places")).alias("includes"))).alias("body"))


@query("""WITH e AS (SELECT *, event_id // 50 AS r FROM events),
m AS (SELECT event_id AS k, CASE WHEN event_id % 4 = 1 THEN 'url' || event_id END AS url, CASE WHEN event_id % 4 = 2 THEN 'pre' || event_id END AS pre FROM e WHERE event_id % 4 <> 0),
keys AS (SELECT event_id, unnest([(event_id + 1) % 50 + r * 50, event_id]) AS k, unnest([1, 2]) AS pos FROM e WHERE event_id % 13 <> 0),
img AS (SELECT event_id, arg_min({'u': url, 'p': pre}, pos) AS img FROM keys JOIN m USING (k) GROUP BY event_id),
us AS (SELECT r, user_id, max(event_id) AS u FROM e GROUP BY ALL),
pl AS (SELECT r, event_id % 7 AS p, max(event_id) AS l FROM e GROUP BY ALL),
j AS (SELECT e.*, img.img AS img, us.u, CASE WHEN e.event_id % 5 <> 0 AND l % 4 <> 0 THEN l END AS box FROM e JOIN img USING (event_id) LEFT JOIN us ON us.r = e.r AND us.user_id = e.user_id AND e.event_id % 11 <> 0 LEFT JOIN pl ON pl.r = e.r AND pl.p = e.event_id % 9)
SELECT 'x:' || event_id AS id, 'https://twitter.com/i/web/status/' || event_id AS url, 'text ' || event_type AS text, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS "createdAt", CASE WHEN event_id % 2 = 0 THEN event_type ELSE '' END AS tags,
CASE WHEN u % 6 <> 0 THEN 'name' || u ELSE 'unknown' END AS author, '@handle' || u AS "authorHandle", 'face' || u AS "authorAvatar", CASE WHEN u % 3 = 0 THEN 'town' || u END AS "authorLocation",
coalesce(img.p, img.u, '') AS image, coalesce(img.u, img.p, '') AS "imageFull",
CASE WHEN box IS NOT NULL THEN box % 45 + 0.5::DOUBLE WHEN event_id % 3 = 0 THEN (event_id % 50)::DOUBLE END AS lat, CASE WHEN box IS NOT NULL THEN box % 90 + 1::DOUBLE WHEN event_id % 3 = 0 THEN (event_id % 100)::DOUBLE END AS lon FROM j""")
def x_search(spark: SparkSession, sf: str) -> DataFrame:
    p = normalize_x(parse_search(_responses(spark, sf)))
    return p.select("id", "url", "text", "createdAt", F.array_join("tags", ",").alias("tags"), "author", "authorHandle", "authorAvatar", "authorLocation", F.coalesce("image", F.lit("")).alias("image"), F.coalesce("imageFull", F.lit("")).alias("imageFull"), "geo.lat", "geo.lon")


@query("SELECT event_id FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 3 DAY AND ts <= (SELECT max(ts) FROM events) - INTERVAL 2 DAY + INTERVAL 1 HOUR")
def window_future_bound(spark: SparkSession, sf: str) -> DataFrame:
    """A clock two days before the latest event: what lies further ahead than the tolerance is out."""
    now = latest(spark, sf) - F.expr("interval 2 days")
    return table(spark, sf, "events").where(times.in_window(F.col("ts").cast("timestamp"), now, _DAY, 3600)).select("event_id")


@query("SELECT 'doc:' || doc_id AS id, '#' || lang || ' #&lt;' || source || '&gt; #3 #4' AS tags FROM documents d JOIN events e ON e.event_id = d.doc_id")
def display_tags(spark: SparkSession, sf: str) -> DataFrame:
    """Six tags, of which four are shown."""
    p = posts(spark, sf).withColumn("tags", F.array(F.get("tags", F.lit(0)), F.concat(F.lit("<"), F.get("tags", F.lit(1)), F.lit(">")), F.lit("3"), F.lit("4"), F.lit("5"), F.lit("6")))
    p = p.withColumns({"locationLabel": F.lit("x"), "confidence": F.lit("low"), "method": F.lit("text")})
    return mapview.display_rows(p, latest(spark, sf)).select("id", "tags")


@query("SELECT i AS ord, 'sample:' || i AS id, '/images/ramen-' || lpad(img::VARCHAR, 2, '0') || '.svg' AS image FROM (VALUES " + ", ".join(f"({i}, {s[4]})" for i, s in enumerate(SAMPLES)) + ") v(i, img)")
def sample_images(spark: SparkSession, sf: str) -> DataFrame:
    return sample_posts(spark, latest(spark, sf)).select("ord", "id", "image")


@query("SELECT event_id, hour(ts) || strftime(ts, ':%M:%S') AS clock FROM events")
def clock_text(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", times.clock(F.col("ts").cast("timestamp")).alias("clock"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN '' ELSE '&lt;' || event_type || '&gt;' END AS e FROM events")
def escape_missing(spark: SparkSession, sf: str) -> DataFrame:
    x = F.when(F.col("event_id") % 3 != 0, F.concat(F.lit("<"), "event_type", F.lit(">")))
    return table(spark, sf, "events").select("event_id", text.escape_html(x).alias("e"))


@query("SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'geotag' WHEN 4 THEN NULL ELSE 'text' END AS method FROM events")
def geotag_guard(spark: SparkSession, sf: str) -> DataFrame:
    """Coordinates that are no finite numbers fall to the text, which every fifth post lacks."""
    i = F.col("event_id") % 5
    lat = F.when(i == 0, F.lit(35.0)).when(i == 1, F.lit(float("nan"))).when(i == 2, F.lit(float("inf")))
    p = table(spark, sf, "events").select("event_id", F.concat(F.lit("e"), "event_id").alias("id"), F.when(i != 4, "仙台").alias("text"), _nothing("array<string>").alias("tags"), _nothing("string").alias("authorLocation"), F.struct(lat.alias("lat"), F.lit(139.0).alias("lon")).alias("geo"))
    return locate.with_estimate(p).select("event_id", "estimate.method")


@query(r"""SELECT page_id, md5(regexp_replace(html || '</ScRiPt>', '(?i)</script>', '<\\/script>', 'g')) AS guarded, regexp_extract('<script id="posts" type="x">' || page_id || '[1]</script>' || html, '(?s)<script id="posts"[^>]*>(.*?)</script>', 1) AS inner FROM pages""".replace("AS inner", 'AS "inner"'))
def page_scripts(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "pages")
    inner = mapview.embedded_json(F.concat(F.lit('<script id="posts" type="x">'), "page_id", F.lit("[1]</script>"), "html"), "posts")
    return p.select("page_id", F.md5(text.guard_script(F.concat("html", F.lit("</ScRiPt>")))).alias("guarded"), inner.alias("inner"))


@query("""WITH live AS (SELECT doc_id FROM documents WHERE doc_id % 4 >= 2 AND doc_id % 17 <> 0) SELECT count(*) > 0 AS live, count(*) = 0 AS demo FROM live""")
def isolated_failure(spark: SparkSession, sf: str) -> DataFrame:
    """One source gives nothing but errors, the other its posts: no fallback, no error."""
    now = F.to_timestamp(F.lit("2024-01-02T03:30:00Z"))
    broken = normalize_x(parse_search(spark.createDataFrame([("<html>502</html>",), (None,)], "body string")))
    both = collect.union_sources(normalize_mastodon(parse_timelines(_bodies(spark, sf))), broken)
    recent = collect.collect_posts(both, sample_posts(spark, now), now)
    return recent.agg((F.count_if(F.col("source") == "mastodon") > 0).alias("live"), F.bool_or("demo").alias("demo"))


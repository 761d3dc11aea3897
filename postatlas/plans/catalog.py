"""Registry of the post-analytics queries and the same results as DuckDB SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo, text, times
from ..operators import collect, locate, mapview
from ..sources.gazetteer import places
from ..sources.live import fan_out
from ..sources.sample import SAMPLES, sample_posts
from ..shared import checkpoint_dir
from ..streaming import poll
from .posts import ESTIMATES, PLACES_SQL, WITH, latest, posts, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
_DAY = 24 * 60


def query(sql: str | None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


@query("SELECT event_id, user_id FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 1 DAY AND ts <= (SELECT max(ts) FROM events) + INTERVAL 60 SECOND")
def window_filter(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return e.where(times.in_window(F.col("ts"), latest(spark, sf), _DAY)).select("event_id", "user_id")


_DIRTY = "CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '16:58' WHEN 2 THEN 'x' || event_id ELSE {} END"


@query("""SELECT event_id FROM events WHERE event_id % 5 IN (3, 4) AND date_trunc('milliseconds', ts) >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY""")
def window_filter_dirty_ts(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").withColumn("createdAt", F.expr(_DIRTY.format("date_format(cast(ts as timestamp), \"yyyy-MM-dd'T'HH:mm:ss.SSS'Z'\")")))
    return collect.window_filter(e, latest(spark, sf), 7 * _DAY).select("event_id")


_WHITE = r"\t-\r \x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}"
_WS = f"[{_WHITE}]+"
_STRIP = "regexp_replace(regexp_replace({}, '(?i)<br[\\s]*/?>', chr(10), 'g'), '(?i)</p>', chr(10), 'g')"
_TEXT = "regexp_replace(replace(replace(replace(replace(replace(regexp_replace(" + _STRIP + ", '<[^>]+>', '', 'g'), '&amp;', '&'), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), chr(10) || '{{2,}}', chr(10), 'g')"


def _html(x: str) -> str:
    return f"regexp_replace(regexp_replace({_TEXT.format(x)}, '^{_WS}', ''), '{_WS}$', '')"


@query(f"SELECT page_id, md5({_html('html')}) AS text_md5, length({_html('html')}) AS n FROM pages")
def html_to_text(spark: SparkSession, sf: str) -> DataFrame:
    t = text.html_to_text(F.col("html"))
    return table(spark, sf, "pages").select("page_id", F.md5(t).alias("text_md5"), F.length(t).cast("long").alias("n"))


@query(f"""SELECT event_id, {_html("'<p>a&amp;lt;' || event_id || '<BR/>&nbsp;&#39;</p><p>&quot;b</p>'")} AS t FROM events""")
def entity_decode_order(spark: SparkSession, sf: str) -> DataFrame:
    h = F.concat(F.lit("<p>a&amp;lt;"), "event_id", F.lit("<BR/>&nbsp;&#39;</p><p>&quot;b</p>"))
    return table(spark, sf, "events").select("event_id", text.html_to_text(h).alias("t"))


_TAGGED = "'#' || lang || ' ' || source || '#x' || doc_id || chr(12288) || '#' || lang || ',y ##z'"


@query(f"""SELECT doc_id, array_to_string(regexp_extract_all({_TAGGED}, '#([^{_WHITE}#]+)', 1), '|') AS tags FROM documents""")
def hashtags(spark: SparkSession, sf: str) -> DataFrame:
    t = F.concat(F.lit("#"), "lang", F.lit(" "), "source", F.lit("#x"), "doc_id", F.lit("　#"), "lang", F.lit(",y ##z"))
    return table(spark, sf, "documents").select("doc_id", F.array_join(text.hashtags(t), "|").alias("tags"))


@query("""SELECT event_id, array_to_string(list_filter([CASE WHEN event_id % 3 = 0 THEN '' ELSE event_type END, CASE WHEN event_id % 4 = 0 THEN '' ELSE 'a b' END, CASE WHEN event_id % 5 = 0 THEN NULL ELSE 'loc' END], lambda x: x IS NOT NULL AND x <> ''), ' ') AS h FROM events""")
def haystack(spark: SparkSession, sf: str) -> DataFrame:
    i = F.col("event_id")
    tags = F.when(i % 4 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("a"), F.lit("b")))
    h = text.haystack(F.when(i % 3 == 0, "").otherwise(F.col("event_type")), tags, F.when(i % 5 != 0, "loc"))
    return table(spark, sf, "events").select("event_id", h.alias("h"))


@query("""SELECT event_id, CASE WHEN event_id % 4 = 1 THEN 'p' || event_id WHEN event_id % 4 = 2 THEN 'u' || event_id ELSE 'g' || event_id END AS image FROM events WHERE event_id % 4 <> 0""")
def media_filter(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators.normalize import images

    def media(kind: str, p: str, u: str) -> F.Column:
        return F.struct(F.lit(kind).alias("type"), F.concat(F.lit(p), "event_id").alias("preview_url") if p else F.lit("").alias("preview_url"), F.concat(F.lit(u), "event_id").alias("url"))

    m = F.element_at(F.array(F.array(media("video", "v", "v")), F.array(media("video", "v", "v"), media("image", "p", "u")), F.array(media("image", "", "u")), F.array(media("gifv", "g", "u"))), (F.col("event_id") % 4 + 1).cast("int"))
    e = table(spark, sf, "events").withColumn("m", images(m)).where(F.size("m") > 0)
    first = F.get("m", F.lit(0))
    return e.select("event_id", text.either(first["preview_url"], first["url"]).alias("image"))


@query("SELECT min(doc_id) AS doc_id, arg_min(source, doc_id) AS source, md5(text) AS key FROM documents GROUP BY text")
def dedupe_first(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select("doc_id", "source", F.md5("text").alias("key"))
    return collect.first_by(d, "key", "doc_id").select("doc_id", "source", "key")


@query("SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id")
def map_last_wins(spark: SparkSession, sf: str) -> DataFrame:
    return collect.last_by(table(spark, sf, "events").select("user_id", "event_id", "event_type"), "user_id", "event_id")


@query("SELECT c.c_custkey, COALESCE(NULLIF(n.n_name, ''), 'unknown') AS author FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey + 9 * (c.c_custkey % 3)")
def lookup_left_join(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "nation")  # read as it is: the optimiser broadcasts it by its size
    c = table(spark, sf, "customer").withColumn("key", F.col("c_nationkey") + 9 * (F.col("c_custkey") % 3))  # keys beyond the table have no match
    return c.join(n, c["key"] == n["n_nationkey"], "left").select("c_custkey", text.either(F.col("n_name"), F.lit("unknown")).alias("author"))


@query("""WITH k AS (SELECT o_orderkey, unnest([o_custkey * 7, o_custkey, o_custkey % 13 + 1]) AS ck, unnest([0, 1, 2]) AS pos FROM orders)
SELECT k.o_orderkey, arg_min(c.c_name, k.pos) AS name FROM k JOIN customer c ON c.c_custkey = k.ck WHERE c.c_acctbal > 0 OR c.c_mktsegment = 'BUILDING' GROUP BY k.o_orderkey""")
def array_fk_first_match(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", F.posexplode(F.array(F.col("o_custkey") * 7, F.col("o_custkey"), F.col("o_custkey") % 13 + 1)).alias("pos", "ck"))
    c = table(spark, sf, "customer").where((F.col("c_acctbal") > 0) | (F.col("c_mktsegment") == "BUILDING")).select("c_custkey", "c_name")
    return o.join(c, o["ck"] == c["c_custkey"]).groupBy("o_orderkey").agg(F.min_by("c_name", "pos").alias("name"))


@query("""SELECT vec_id, CASE WHEN vec_id % 2 = 0 THEN (embedding[2]::DOUBLE + embedding[4]::DOUBLE) / 2 WHEN vec_id % 3 = 0 THEN embedding[2]::DOUBLE END AS lat,
CASE WHEN vec_id % 2 = 0 THEN (embedding[1]::DOUBLE + embedding[3]::DOUBLE) / 2 WHEN vec_id % 3 = 0 THEN embedding[1]::DOUBLE END AS lon FROM embeddings""")
def geo_precedence(spark: SparkSession, sf: str) -> DataFrame:
    v = F.transform(F.slice("embedding", 1, 4), lambda x: x.cast("double"))
    g = F.coalesce(geo.bbox_center(F.when(F.col("vec_id") % 2 == 0, v)), geo.point(F.when(F.col("vec_id") % 3 == 0, v)))
    return table(spark, sf, "embeddings").select("vec_id", g["lat"].alias("lat"), g["lon"].alias("lon"))


@query("SELECT 0 AS s, doc_id AS o, 'd' || doc_id AS id FROM documents UNION ALL SELECT 1, conv_id * 1000 + turn, 'c' || conv_id FROM conversations")
def union_sources(spark: SparkSession, sf: str) -> DataFrame:
    from ..schemas import RAW_POST

    def raw(df: DataFrame, ord: F.Column, id: F.Column) -> DataFrame:
        return df.select(ord.alias("ord"), *(id.alias("id") if f == "id" else F.lit(None).cast(t).alias(f) for f, t in RAW_POST.items()))

    d = raw(table(spark, sf, "documents"), F.col("doc_id"), F.concat(F.lit("d"), "doc_id"))
    c = raw(table(spark, sf, "conversations"), F.col("conv_id") * 1000 + F.col("turn"), F.concat(F.lit("c"), "conv_id"))
    return collect.union_sources(d, c).select("ord.s", "ord.o", "id")


def _fallback(spark: SparkSession, sf: str, minutes: float, later: str) -> DataFrame:
    e = table(spark, sf, "events").select(F.concat(F.lit("event:"), "event_id").alias("id"), F.col("ts").cast("timestamp").alias("ts"))
    now = latest(spark, sf) + F.expr(later)
    live = e.where(times.in_window(F.col("ts"), now, minutes)).select("id")
    return collect.with_fallback(live, sample_posts(spark, now).select("id"), True).select("id", "demo")


@query("SELECT 'sample:' || i AS id, true AS demo FROM range(20) t(i)")
def fallback_when_empty(spark: SparkSession, sf: str) -> DataFrame:
    return _fallback(spark, sf, 60, "interval 2 days")


@query("SELECT 'event:' || event_id AS id, false AS demo FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR")
def fallback_not_taken(spark: SparkSession, sf: str) -> DataFrame:
    return _fallback(spark, sf, 60, "interval 0 days")


@query(WITH + "SELECT b.ord, b.gord, b.score FROM best b")
def gazetteer_match(spark: SparkSession, sf: str) -> DataFrame:
    p = posts(spark, sf).where("geo is null")
    b = locate.best_place(text.haystack(F.col("text"), F.col("tags"), F.col("authorLocation")))
    # a generator's result is computed once, whatever reads it
    return p.select("ord", F.explode(F.array(b)).alias("b")).where("b is not null").select("ord", (-F.col("b.back")).alias("gord"), F.col("b.score").alias("score"))


@query(WITH + "SELECT ord, gord FROM near")
def nearest_place(spark: SparkSession, sf: str) -> DataFrame:
    p = posts(spark, sf).where("geo is not null").select("ord", F.explode(F.array(locate.nearest_place(F.col("geo.lat"), F.col("geo.lon")))).alias("n"))
    return p.where("n is not null").select("ord", (-F.col("n.back")).alias("gord"))


@query(WITH + "SELECT ord, round((a - 0.5::DOUBLE) * 0.1::DOUBLE, 6) AS jlat, round((o - 0.5::DOUBLE) * 0.1::DOUBLE, 6) AS jlon FROM jit")
def jitter(spark: SparkSession, sf: str) -> DataFrame:
    return posts(spark, sf).select("ord", F.round(geo.jitter(F.col("id"), "lat"), 6).alias("jlat"), F.round(geo.jitter(F.col("id"), "lon"), 6).alias("jlon"))


@query(WITH + 'SELECT ord, round(lat, 6) AS lat, round(lon, 6) AS lon, "locationLabel", pref, confidence, method FROM est')
def estimate_location(spark: SparkSession, sf: str) -> DataFrame:
    e = F.col("estimate")
    return locate.with_estimate(posts(spark, sf)).select("ord", F.round(e["lat"], 6).alias("lat"), F.round(e["lon"], 6).alias("lon"), e["label"].alias("locationLabel"), e["pref"].alias("pref"), e["confidence"].alias("confidence"), e["method"].alias("method"))


@query(WITH + """SELECT rank() OVER (ORDER BY ts DESC, ord) AS rank, id, source, "sourceLabel", url, text, array_to_string(tags, ',') AS tags, "createdAt", author, "authorHandle", image,
COALESCE(NULLIF("imageFull", ''), image) AS "imageFull", round(lat, 6) AS lat, round(lon, 6) AS lon, "locationLabel", pref, confidence, method FROM loc""")
def located_posts(spark: SparkSession, sf: str) -> DataFrame:
    p = collect.with_rank(collect.located(posts(spark, sf)))
    return p.select("rank", "id", "source", "sourceLabel", "url", "text", F.array_join("tags", ",").alias("tags"), "createdAt", "author", "authorHandle", "image", "imageFull", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"), "locationLabel", "pref", "confidence", "method")


@query(WITH + "SELECT count(*) AS collected, count(method) AS located, count(*) - count(method) AS unlocated FROM est")
def post_counts(spark: SparkSession, sf: str) -> DataFrame:
    return collect.counts(posts(spark, sf))


@query(WITH + """, w AS (SELECT e.* FROM est e, tnow WHERE e.ts >= now - INTERVAL 60 DAY)
SELECT (SELECT strftime(now, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' FROM tnow) AS "generatedAt", 86400.0::DOUBLE AS "windowMinutes", false AS demo, count(*) AS collected, count(method) AS located, count(*) - count(method) AS unlocated,
string_agg(id, ',' ORDER BY ts DESC, ord) FILTER (method IS NOT NULL) AS ids, string_agg("locationLabel", ',' ORDER BY ts DESC, ord) FILTER (method IS NOT NULL) AS labels FROM w""")
def api_envelope(spark: SparkSession, sf: str) -> DataFrame:
    now = latest(spark, sf)
    live = collect.union_sources(posts(spark, sf))
    recent = collect.collect_posts(live, sample_posts(spark, now), now, minutes=60 * _DAY)
    e = collect.envelope(recent, now, 60 * _DAY, joined=("id", "locationLabel"))
    return e.select("generatedAt", "windowMinutes", "demo", "counts.*", F.col("id").alias("ids"), F.col("locationLabel").alias("labels"))


def _text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


_samples = ", ".join(f"({i}, {_text(t)}, {_text(place)}, {g[0] if g else 'NULL'}::DOUBLE, {g[1] if g else 'NULL'}::DOUBLE)" for i, (t, place, _, g, _) in enumerate(SAMPLES))
_SAMPLE = f"""smp(ord, text, place, tlat, tlon) AS (VALUES {_samples}),
posts AS (SELECT ord, 'sample:' || ord AS id, text, regexp_extract_all(text, '#([^{_WHITE}#]+)', 1) AS tags, place AS "authorLocation", date_trunc('milliseconds', (SELECT max(ts) FROM events)) - to_minutes((ord * 7 + 3) % 56) AS ts, tlat, tlon FROM smp),
"""


@query(PLACES_SQL + _SAMPLE + ESTIMATES + """SELECT true AS demo, count(*) AS collected, count(method) AS located, count(*) - count(method) AS unlocated,
string_agg(id, ',' ORDER BY ts DESC, ord) FILTER (method IS NOT NULL) AS ids, string_agg("locationLabel" || '/' || coalesce(pref, '') || '/' || confidence || '/' || method, ',' ORDER BY ts DESC, ord) FILTER (method IS NOT NULL) AS places,
round(sum(lat), 6) AS lats, round(sum(lon), 6) AS lons FROM est""")
def sample_envelope(spark: SparkSession, sf: str) -> DataFrame:
    now = latest(spark, sf)
    e = collect.envelope(collect.collect_posts(None, sample_posts(spark, now), now, force_sample=True), now, 60)
    # read back from the JSON text that a client gets
    e = e.select("demo", "counts.*", F.from_json("json", "posts array<struct<id:string,locationLabel:string,pref:string,confidence:string,method:string,lat:double,lon:double>>")["posts"].alias("p"))
    total = {f"{c}s": F.round(F.aggregate(F.col("p")[c], F.lit(0.0), lambda a, x: a + x), 6) for c in ("lat", "lon")}
    place = F.transform("p", lambda x: F.concat_ws("/", x["locationLabel"], F.coalesce(x["pref"], F.lit("")), x["confidence"], x["method"]))
    return e.select("demo", "collected", "located", "unlocated", F.array_join("p.id", ",").alias("ids"), F.array_join(place, ",").alias("places"), *(x.alias(c) for c, x in total.items()))


_PIN = """SELECT id, CAST(CAST(regexp_extract(image, 'ramen-([0-9]+)', 1) AS INT) AS VARCHAR) AS img, CAST(floor(epoch_ms((SELECT date_trunc('milliseconds', now) FROM tnow)::TIMESTAMP - ts::TIMESTAMP) / 60000.0 + 0.5) AS INT) AS "minutesAgo", CAST(format('{:.4f}', lat) AS DOUBLE) AS lat, CAST(format('{:.4f}', lon) AS DOUBLE) AS lon, "locationLabel", confidence, method FROM loc"""
_PIN = _PIN.replace("epoch_ms((SELECT date_trunc('milliseconds', now) FROM tnow)::TIMESTAMP - ts::TIMESTAMP)", "(epoch_ms((SELECT now::TIMESTAMP FROM tnow)) - epoch_ms(date_trunc('milliseconds', ts)::TIMESTAMP))")


@query(WITH + _PIN)
def static_pins(spark: SparkSession, sf: str) -> DataFrame:
    p = mapview.static_pins(collect.located(posts(spark, sf)), latest(spark, sf))
    return p.select("id", "img", "minutesAgo", "lat", "lon", "locationLabel", "confidence", "method")


@query(WITH + f""", pins AS ({_PIN}), im(img, uri) AS (VALUES ('1', 'data:1'), ('2', 'data:2'), ('7', 'data:7'))
SELECT p.id, (SELECT epoch_ms(now::TIMESTAMP) FROM tnow) - p."minutesAgo"::BIGINT * 60000 AS "createdAt", im.uri AS image FROM pins p LEFT JOIN im USING (img)""")
def rehydrate_pins(spark: SparkSession, sf: str) -> DataFrame:
    now = latest(spark, sf)
    pins = mapview.static_pins(collect.located(posts(spark, sf)), now)
    images = spark.createDataFrame([(k, f"data:{k}") for k in "127"], "img string, uri string")
    return mapview.rehydrate(pins, images, now).select("id", "createdAt", "image")


def _shapes(spark: SparkSession) -> DataFrame:
    """Two squares around each prefecture of the gazetteer."""

    def ring(s: float) -> F.Column:
        return F.array(*(F.array(F.col("lon") + dx * s, F.col("lat") + dy * s) for dx, dy in ((-1, -1), (1, -1), (1, 1))))

    g = places(spark).where("kind = 'pref'")
    return g.select(F.col("ord").alias("feature"), F.col("label").alias("name"), F.array(F.array(ring(0.3), ring(0.1))).alias("polygons"))


_SHAPE = """, pt AS (SELECT gord AS feature, label AS name, r.s, v.i, glon + v.dx * r.s AS lon, glat + v.dy * r.s AS lat FROM gaz, (VALUES (0, 0.3::DOUBLE), (1, 0.1::DOUBLE)) r(k, s), (VALUES (0, -1, -1), (1, 1, -1), (2, 1, 1)) v(i, dx, dy) WHERE kind = 'pref'),
bd AS (SELECT min(lon) AS "minLon", max(lon) AS "maxLon", min(lat) AS "minLat", max(lat) AS "maxLat" FROM pt),
pr AS (SELECT *, cos(radians(("minLat" + "maxLat") / 2)) AS kx, 960.0::DOUBLE / (("maxLon" - "minLon") * cos(radians(("minLat" + "maxLat") / 2))) AS scale FROM bd)
"""


@query(WITH + _SHAPE + 'SELECT round("minLon", 9) AS "minLon", round("maxLon", 9) AS "maxLon", round("minLat", 9) AS "minLat", round("maxLat", 9) AS "maxLat" FROM bd')
def map_bounds(spark: SparkSession, sf: str) -> DataFrame:
    return mapview.map_bounds(_shapes(spark)).select(*(F.round(c, 9).alias(c) for c in ("minLon", "maxLon", "minLat", "maxLat")))


@query(WITH + _SHAPE + """SELECT vec_id, round(20 + (embedding[1]::DOUBLE - "minLon") * kx * scale, 6) AS x, round(20 + ("maxLat" - embedding[2]::DOUBLE) * scale, 6) AS y FROM embeddings, pr""")
def project_points(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "embeddings").select("vec_id", F.get("embedding", F.lit(0)).cast("double").alias("lon"), F.get("embedding", F.lit(1)).cast("double").alias("lat"))
    return mapview.project(p, mapview.map_bounds(_shapes(spark))).select("vec_id", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


@query(WITH + _SHAPE + """, rg AS (SELECT feature, name, s, string_agg((CASE WHEN i = 0 THEN 'M' ELSE 'L' END) || format('{:.1f}', 20 + (lon - "minLon") * kx * scale) || ' ' || format('{:.1f}', 20 + ("maxLat" - lat) * scale), ' ' ORDER BY i) || ' Z ' AS d FROM pt, pr GROUP BY ALL)
SELECT feature, name, string_agg(d, '' ORDER BY s DESC) AS d FROM rg GROUP BY feature, name""")
def svg_paths(spark: SparkSession, sf: str) -> DataFrame:
    s = _shapes(spark)
    return mapview.svg_paths(s, mapview.map_bounds(s))


_AGO = "greatest(0, (epoch_ms(date_trunc('milliseconds', (SELECT max(ts) FROM events))::TIMESTAMP) - epoch_ms(date_trunc('milliseconds', ts)::TIMESTAMP)) // 1000)"


@query(f"""SELECT event_id, CASE WHEN {_AGO} < 60 THEN {_AGO} || '秒前' WHEN {_AGO} // 60 < 60 THEN ({_AGO} // 60) || '分前' ELSE ({_AGO} // 3600) || '時間前' END AS ago FROM events""")
def time_ago(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", times.time_ago(F.col("ts").cast("timestamp"), latest(spark, sf)).alias("ago"))


@query("SELECT event_id, epoch_ms(date_trunc('milliseconds', (SELECT max(ts) FROM events))::TIMESTAMP) - epoch_ms(date_trunc('milliseconds', ts)::TIMESTAMP) < 600000 AS fresh FROM events")
def fresh_flag(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", times.is_fresh(F.col("ts").cast("timestamp"), latest(spark, sf)).alias("fresh"))


_ESC = "replace(replace(replace(replace(replace({}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#39;')"


@query(f"SELECT page_id, md5({_ESC.format('html')}) AS escaped FROM pages")
def html_escape(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", F.md5(text.escape_html(F.col("html"))).alias("escaped"))


_AGE = "greatest(0, (epoch_ms((SELECT now::TIMESTAMP FROM tnow)) - epoch_ms(date_trunc('milliseconds', ts)::TIMESTAMP)) // 1000)"


@query(WITH + f"""SELECT id, "locationLabel" AS location, CASE confidence WHEN 'high' THEN 'ジオタグ' WHEN 'medium' THEN '地名(市区)' ELSE '地名(都道府県)' END AS "confidenceLabel", 'c-' || confidence AS "confidenceClass",
CASE method WHEN 'geotag' THEN 'ジオタグ' ELSE '本文の地名' END AS "methodLabel", {_ESC.format('text')} AS text, {_ESC.format('''COALESCE(NULLIF("authorHandle", ''), author)''')} AS author,
CASE WHEN {_AGE} < 60 THEN {_AGE} || '秒前' WHEN {_AGE} // 60 < 60 THEN ({_AGE} // 60) || '分前' ELSE ({_AGE} // 3600) || '時間前' END AS ago, epoch_ms((SELECT now::TIMESTAMP FROM tnow)) - epoch_ms(date_trunc('milliseconds', ts)::TIMESTAMP) < 600000 AS fresh,
'#' || tags[1] || ' #' || tags[2] AS tags, COALESCE({_ESC.format('url')}, "sourceLabel") AS link FROM loc""")
def display_row(spark: SparkSession, sf: str) -> DataFrame:
    return mapview.display_rows(collect.located(posts(spark, sf)), latest(spark, sf))


@query(WITH + """SELECT CASE confidence WHEN 'high' THEN 'ジオタグ' WHEN 'medium' THEN '地名(市区)' ELSE '地名(都道府県)' END AS label, 'c-' || confidence AS class, count(*) AS n FROM loc GROUP BY ALL""")
def conf_labels(spark: SparkSession, sf: str) -> DataFrame:
    p = collect.located(posts(spark, sf))
    return p.groupBy(text.confidence_label(F.col("confidence")).alias("label"), text.confidence_class(F.col("confidence")).alias("class")).agg(F.count("*").alias("n"))


_SETTING = "' a' || r_regionkey || ' ,, b ,' || chr(12288) || 'c'"


@query(f"SELECT r_regionkey, array_to_string(list_filter([regexp_replace(regexp_replace(x, '^{_WS}', ''), '{_WS}$', '') for x in string_split({_SETTING}, ',')], lambda x: x <> ''), '|') AS items FROM region")
def config_lists(spark: SparkSession, sf: str) -> DataFrame:
    s = F.concat(F.lit(" a"), "r_regionkey", F.lit(" ,, b ,　c"))
    return table(spark, sf, "region").select("r_regionkey", F.array_join(text.config_list(s), "|").alias("items"))


@query("SELECT r.r_name AS instance, n.n_name AS tag, r.r_regionkey::BIGINT * 1000 + n.n_nationkey AS job FROM region r, nation n")
def source_fanout(spark: SparkSession, sf: str) -> DataFrame:
    a = table(spark, sf, "region").select(F.col("r_name").alias("instance"), F.col("r_regionkey").cast("long").alias("i"))
    b = table(spark, sf, "nation").select(F.col("n_name").alias("tag"), F.col("n_nationkey").cast("long").alias("j"))
    return fan_out(a, b)


@query("SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS r FROM orders) WHERE r <= 3")
def source_limit(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return collect.limit_by(o, ["o_custkey"], [F.desc("o_orderdate"), F.asc("o_orderkey")], 3).select("o_custkey", "o_orderkey")


@query(WITH + """SELECT ord % 50 AS pin, max(ord) AS ord, arg_max(id, ord) AS id FROM loc GROUP BY 1""")
def last_pin_by_id(spark: SparkSession, sf: str) -> DataFrame:
    p = collect.located(posts(spark, sf)).select((F.col("ord") % 50).alias("pin"), "ord", "id")
    return collect.last_by(p, "pin", "ord")


@query("SELECT doc_id, replace(replace(replace(replace(source, 'src', 'a b'), ' ', '%20'), '~', '~'), '+', '%2B') || '%E5%AE%B6%2F' || doc_id AS u FROM documents")
def uri_encode(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", text.encode_uri(F.concat(F.replace("source", F.lit("src"), F.lit("a b")), F.lit("家/"), "doc_id")).alias("u"))


@query("SELECT DISTINCT user_id FROM events")
def stream_window_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    """Events through the stream once, one of each user within the watermark, then the look-back window (which holds all events)."""
    base = f"{checkpoint_dir(spark)}/stream-{uuid.uuid4()}"
    events = spark.readStream.schema(table(spark, sf, "events").schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    q = poll.append_to(poll.deduplicated(events, "user_id", "ts"), f"{base}/out", f"{base}/state", refresh_seconds=None)
    q.awaitTermination()
    return poll.recent(spark, f"{base}/out", "ts", latest(spark, sf), 60 * _DAY).select("user_id")

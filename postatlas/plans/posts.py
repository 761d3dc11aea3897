"""A posts relation derived from the driver tables, so that every post operator can be queried and held against SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import iso
from ..schemas import RAW_POST
from ..sources.gazetteer import PLACES, rows

NAMES = tuple(n for names, *_ in PLACES for n in names)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def latest(spark: SparkSession, sf_dir: str) -> Column:
    """The latest event time as a literal: the ``now`` of all queries, read once."""
    t = table(spark, sf_dir, "events").agg(F.max("ts").cast("string")).first()[0]
    return F.to_timestamp(F.lit(t))


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, events = table(spark, sf_dir, "documents"), table(spark, sf_dir, "events")
    names = F.broadcast(spark.createDataFrame(list(enumerate(NAMES)), "k long, name string"))
    d = docs.join(events.select("event_id", "ts", "user_id"), docs["doc_id"] == events["event_id"])
    d = d.join(names, F.pmod("doc_id", F.lit(len(NAMES))) == F.col("k"))
    i = F.col("doc_id")
    even = F.pmod(i, F.lit(2)) == 0
    return d.select(
        i.alias("ord"),
        F.concat(F.lit("doc:"), i).alias("id"),
        F.when(even, "mastodon").otherwise("x").alias("source"),
        F.when(even, "Mastodon (demo)").otherwise("X (Twitter)").alias("sourceLabel"),
        F.when(F.pmod(i, F.lit(3)) != 0, F.concat(F.lit("https://e.example/?a=1&b="), i)).alias("url"),
        F.concat(F.col("text"), F.when(F.pmod(i, F.lit(5)) != 0, F.concat(F.lit(" "), "name")).otherwise("")).alias("text"),
        F.array("lang", docs["source"]).alias("tags"),
        iso(F.col("ts").cast("timestamp")).alias("createdAt"),
        F.concat(F.lit("user "), "user_id").alias("author"),
        F.when(F.pmod(i, F.lit(4)) != 0, F.concat(F.lit("@u"), "user_id")).otherwise("").alias("authorHandle"),
        F.lit(None).cast("string").alias("authorAvatar"),
        F.lit(None).cast("string").alias("authorLocation"),
        F.concat(F.lit("/images/ramen-"), F.lpad(F.pmod(i, F.lit(10)).cast("string"), 2, "0"), F.lit(".svg")).alias("image"),
        F.when(F.pmod(i, F.lit(2)) == 0, F.lit("/full.svg")).otherwise("").alias("imageFull"),
        F.when(F.pmod(i, F.lit(7)) == 0, F.struct((F.lit(26.0) + F.pmod(i * 37, F.lit(1700)).cast("double") / 100).alias("lat"), (F.lit(128.0) + F.pmod(i * 53, F.lit(1500)).cast("double") / 100).alias("lon"))).alias("geo"),
    ).select("ord", *RAW_POST)


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_names = ", ".join(f"({k}, {_text(n)})" for k, n in enumerate(NAMES))
_gaz = ", ".join(f"({o}, {lat}::DOUBLE, {lon}::DOUBLE, {_text(label)}, {_text(pref)}, {_text(kind)}, {prio})" for o, _, lat, lon, label, pref, kind, prio in rows())
_gname = ", ".join(f"({o}, {p}, {_text(n)})" for o, names, *_ in rows() for p, n in enumerate(names))
#: CTEs of the oracle: the gazetteer, then posts.
PLACES_SQL = f"""WITH names(k, name) AS (VALUES {_names}),
gaz(gord, glat, glon, label, pref, kind, prio) AS (VALUES {_gaz}),
gname(gord, pos, name) AS (VALUES {_gname}),
"""
POSTS_SQL = f"""posts AS (SELECT d.doc_id AS ord, 'doc:' || d.doc_id AS id, CASE WHEN d.doc_id % 2 = 0 THEN 'mastodon' ELSE 'x' END AS source,
  CASE WHEN d.doc_id % 2 = 0 THEN 'Mastodon (demo)' ELSE 'X (Twitter)' END AS "sourceLabel",
  CASE WHEN d.doc_id % 3 <> 0 THEN 'https://e.example/?a=1&b=' || d.doc_id END AS url,
  d.text || CASE WHEN d.doc_id % 5 <> 0 THEN ' ' || n.name ELSE '' END AS text,
  [d.lang, d.source] AS tags, strftime(e.ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS "createdAt", date_trunc('milliseconds', e.ts) AS ts,
  'user ' || e.user_id AS author, CASE WHEN d.doc_id % 4 <> 0 THEN '@u' || e.user_id ELSE '' END AS "authorHandle",
  '/images/ramen-' || lpad(CAST(d.doc_id % 10 AS VARCHAR), 2, '0') || '.svg' AS image, CASE WHEN d.doc_id % 2 = 0 THEN '/full.svg' ELSE '' END AS "imageFull", NULL::VARCHAR AS "authorLocation",
  CASE WHEN d.doc_id % 7 = 0 THEN 26.0::DOUBLE + CAST(d.doc_id * 37 % 1700 AS DOUBLE) / 100 END AS tlat,
  CASE WHEN d.doc_id % 7 = 0 THEN 128.0::DOUBLE + CAST(d.doc_id * 53 % 1500 AS DOUBLE) / 100 END AS tlon
  FROM documents d JOIN events e ON e.event_id = d.doc_id JOIN names n ON n.k = d.doc_id % {len(NAMES)}),
"""
#: CTEs after ``posts``: now, and the estimate of each post.
ESTIMATES = """tnow AS (SELECT date_trunc('milliseconds', max(ts)) AS now FROM events),
hay AS (SELECT ord, array_to_string(list_filter([text, array_to_string(tags, ' '), "authorLocation"], lambda x: x IS NOT NULL AND x <> ''), ' ') AS h FROM posts WHERE tlat IS NULL),
hits AS (SELECT h.ord, g.gord, arg_min(g.name, g.pos) AS name FROM hay h JOIN gname g ON contains(h.h, g.name) GROUP BY ALL),
best AS (SELECT x.ord, arg_max(x.gord, (g.prio * 100 + length(x.name), -x.gord)) AS gord, max(g.prio * 100 + length(x.name)) AS score FROM hits x JOIN gaz g USING (gord) GROUP BY x.ord),
cand AS (SELECT p.ord, g.gord, g.prio, (g.glat - p.tlat) * (g.glat - p.tlat) + (g.glon - p.tlon) * (g.glon - p.tlon) AS d FROM posts p, gaz g WHERE p.tlat IS NOT NULL),
close AS (SELECT *, min(d) OVER (PARTITION BY ord) AS dmin FROM cand WHERE d < 0.5),
near AS (SELECT ord, arg_max(gord, (prio, -gord)) AS gord FROM close WHERE d - dmin < 0.0004 GROUP BY ord),
jit AS (SELECT ord, (list_reduce(list_concat([2166136261::BIGINT], [unicode(c)::BIGINT for c in string_split(id || 'lat', '')]), lambda h, c: (xor(h, c) * 16777619) % 4294967296) % 10000)::DOUBLE / 10000.0::DOUBLE AS a,
  (list_reduce(list_concat([2166136261::BIGINT], [unicode(c)::BIGINT for c in string_split(id || 'lon', '')]), lambda h, c: (xor(h, c) * 16777619) % 4294967296) % 10000)::DOUBLE / 10000.0::DOUBLE AS o FROM posts),
est AS (SELECT p.*, COALESCE(p.tlat, g.glat + (j.a - 0.5::DOUBLE) * 0.1::DOUBLE) AS lat, COALESCE(p.tlon, g.glon + (j.o - 0.5::DOUBLE) * 0.1::DOUBLE) AS lon,
  CASE WHEN p.tlat IS NOT NULL THEN COALESCE(ng.label || ' 付近', '位置情報あり') ELSE g.label END AS "locationLabel",
  CASE WHEN p.tlat IS NOT NULL THEN ng.pref ELSE g.pref END AS pref,
  CASE WHEN p.tlat IS NOT NULL THEN 'high' WHEN g.kind = 'landmark' THEN 'medium' WHEN g.kind IS NOT NULL THEN 'low' END AS confidence,
  CASE WHEN p.tlat IS NOT NULL THEN 'geotag' WHEN g.kind IS NOT NULL THEN 'text' END AS method
  FROM posts p JOIN jit j USING (ord) LEFT JOIN best b USING (ord) LEFT JOIN gaz g ON g.gord = b.gord LEFT JOIN near n ON n.ord = p.ord LEFT JOIN gaz ng ON ng.gord = n.gord),
loc AS (SELECT * FROM est WHERE method IS NOT NULL)
"""
WITH = PLACES_SQL + POSTS_SQL + ESTIMATES

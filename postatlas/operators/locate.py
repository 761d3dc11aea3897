"""Location estimates: geotag with the nearest place, else the best place name in the text.

The gazetteer is a literal array inside the expression, so that a post needs no
join and no shuffle, whatever the number of posts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import finite, jitter, squared_distance
from ..functions.text import haystack
from ..shared import let
from ..sources.gazetteer import literal, narrow_names

RADIUS = 0.5  # squared degrees, strict
BAND = 0.0004  # squared degrees within which a narrower kind wins


def best_place(text: Column) -> Column:
    """The place with the highest score: kind first, then the length of its first listed name that occurs; ties go to the first place.

    Names without ASCII characters are looked for in what is left of the text
    when its ASCII runs are spaces, the others in the whole text, and only where
    one scan has found that any of them occurs.
    """
    def search(t: Column) -> Column:
        scored = F.transform(literal(), lambda p: F.struct((p["prio"] * 100 + F.length(F.get(F.filter(p["names"], lambda n: F.contains(F.when(n["wide"], t["wide"]).otherwise(t["narrow"]), n["name"])), F.lit(0))["name"])).alias("score"), (-p["ord"]).alias("back"), p["lat"].alias("lat"), p["lon"].alias("lon"), p["label"].alias("label"), p["pref"].alias("pref"), p["kind"].alias("kind")))
        return F.array_max(F.filter(scored, lambda s: s["score"].isNotNull()))

    def parts(t: Column) -> Column:
        return F.struct(F.regexp_replace(t, r"[\x00-\x7F]+", " ").alias("wide"), F.when(t.rlike(narrow_names()), t).otherwise("").alias("narrow"))

    return let(let(text, parts), search)


def nearest_place(lat: Column, lon: Column) -> Column:
    """The nearest place within the radius; among those as near as the band, the narrowest kind, then the first."""
    nearby = F.filter(F.transform(literal(), lambda p: F.struct(squared_distance(p["lat"], p["lon"], lat, lon).alias("d"), p["prio"].alias("prio"), (-p["ord"]).alias("back"), p["label"].alias("label"), p["pref"].alias("pref"))), lambda s: s["d"] < RADIUS)

    def narrowest(near: Column) -> Column:
        return let(F.array_min(F.transform(near, lambda s: s["d"])), lambda least: F.array_max(F.transform(F.filter(near, lambda s: s["d"] - least < BAND), lambda s: F.struct(s["prio"].alias("prio"), s["back"].alias("back"), s["label"].alias("label"), s["pref"].alias("pref")))))

    return let(nearby, narrowest)


def confidence(method: Column, kind: Column) -> Column:
    return F.when(method == "geotag", "high").when(kind == "landmark", "medium").otherwise("low")


def with_estimate(posts: DataFrame) -> DataFrame:
    """Adds ``estimate`` (lat, lon, label, pref, confidence, method), null where nothing is found.

    Posts need id, text, tags, authorLocation and geo.  No shuffle, no join.
    """
    lat, lon = F.col("geo")["lat"], F.col("geo")["lon"]
    tagged = F.coalesce(finite(lat) & finite(lon), F.lit(False))
    hit = F.struct(F.when(tagged, nearest_place(lat, lon)).alias("near"), F.when(~tagged, best_place(haystack(F.col("text"), F.col("tags"), F.col("authorLocation")))).alias("best"))
    # a generator evaluates the search once for each row; a plain projection would be copied into every use
    out = posts.select("*", F.explode(F.array(hit)).alias("_hit"))
    near, best = F.col("_hit.near"), F.col("_hit.best")

    def estimate(lat: Column, lon: Column, label: Column, pref: Column, conf: Column, method: str) -> Column:
        return F.struct(lat.alias("lat"), lon.alias("lon"), label.alias("label"), pref.alias("pref"), conf.alias("confidence"), F.lit(method).alias("method"))

    by_tag = estimate(lat, lon, F.coalesce(F.concat(near["label"], F.lit(" 付近")), F.lit("位置情報あり")), near["pref"], F.lit("high"), "geotag")
    by_text = estimate(best["lat"] + jitter(F.col("id"), "lat"), best["lon"] + jitter(F.col("id"), "lon"), best["label"], best["pref"], confidence(F.lit("text"), best["kind"]), "text")
    return out.withColumn("estimate", F.when(tagged, by_tag).when(best.isNotNull(), by_text)).drop("_hit")

"""Upstream JSON to RawPost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import bbox_center, point
from ..functions.text import either, html_to_text, truthy
from ..schemas import RAW_POST
from .collect import first_by


def images(media: Column) -> Column:
    """Attachments that are images or animations."""
    return F.filter(media, lambda m: m["type"].isin("image", "gifv"))


def normalize_mastodon(statuses: DataFrame) -> DataFrame:
    """Statuses (with instance and ord) to RawPost (with ord): image posts only, first of each url, in ``ord`` order.

    The media filter stands before the first-wins key: a dropped status claims no key.
    """
    s = statuses.withColumn("_images", images(F.col("media_attachments"))).where(F.size("_images") > 0)
    s = s.withColumn("_key", either(F.col("url"), F.concat_ws(":", "instance", "id")))
    s = first_by(s, "_key", "ord")
    image, account = F.get("_images", F.lit(0)), F.col("account")
    return s.select(
        "ord",
        F.concat(F.lit("mastodon:"), "instance", F.lit(":"), "id").alias("id"),
        F.lit("mastodon").alias("source"),
        F.concat(F.lit("Mastodon ("), "instance", F.lit(")")).alias("sourceLabel"),
        "url",
        html_to_text(F.col("content")).alias("text"),
        F.coalesce(F.transform("tags", lambda t: t["name"]), F.array().cast("array<string>")).alias("tags"),
        F.col("created_at").alias("createdAt"),
        either(account["display_name"], either(account["username"], F.lit("unknown"))).alias("author"),
        F.concat(F.lit("@"), truthy(account["acct"])).alias("authorHandle"),
        account["avatar"].alias("authorAvatar"),
        F.lit(None).cast("string").alias("authorLocation"),
        either(image["preview_url"], image["url"]).alias("image"),
        image["url"].alias("imageFull"),
        F.lit(None).cast("struct<lat:double,lon:double>").alias("geo"),
    ).select("ord", *RAW_POST)


def _last(table: Column, key: str, value: Column) -> Column:
    """The last element with this key; null without one."""
    return F.get(F.reverse(F.filter(table, lambda m: m[key] == value)), F.lit(0))


def normalize_x(responses: DataFrame) -> DataFrame:
    """Search responses (one row each) to RawPost (with ord), without posts that have no media.

    Media, users and places of a response are looked up inside its own row, so
    nothing is joined; the last of equal keys wins.
    """

    def usable(m: Column) -> Column:
        return (m["type"] == "photo") | truthy(m["url"]).isNotNull() | truthy(m["preview_image_url"]).isNotNull()

    include = F.col("includes")

    def looked_up(t: Column) -> Column:
        media = F.filter(F.transform(t["attachments"]["media_keys"], lambda k: _last(include["media"], "media_key", k)), usable)
        return F.struct(t.alias("t"), F.get(media, F.lit(0)).alias("img"), _last(include["users"], "id", t["author_id"]).alias("users"), _last(include["places"], "id", t["geo"]["place_id"]).alias("places"))

    t = responses.select(F.explode(F.transform("data", looked_up)).alias("x")).select("x.*").where("img is not null")
    user, img = F.col("users"), F.col("img")
    return t.select(
        F.monotonically_increasing_id().alias("ord"),
        F.concat(F.lit("x:"), "t.id").alias("id"),
        F.lit("x").alias("source"),
        F.lit("X (Twitter)").alias("sourceLabel"),
        F.concat(F.lit("https://twitter.com/i/web/status/"), "t.id").alias("url"),
        F.col("t.text").alias("text"),
        F.coalesce(F.transform("t.entities.hashtags", lambda h: h["tag"]), F.array().cast("array<string>")).alias("tags"),
        F.col("t.created_at").alias("createdAt"),
        either(user["name"], F.lit("unknown")).alias("author"),
        F.concat(F.lit("@"), truthy(user["username"])).alias("authorHandle"),
        user["profile_image_url"].alias("authorAvatar"),
        user["location"].alias("authorLocation"),
        either(img["preview_image_url"], img["url"]).alias("image"),
        either(img["url"], img["preview_image_url"]).alias("imageFull"),
        F.coalesce(bbox_center(F.col("places.geo.bbox")), point(F.col("t.geo.coordinates.coordinates"))).alias("geo"),
    ).select("ord", *RAW_POST)

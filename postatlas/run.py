"""Whole runs: one collection under the settings, the JSON response, and the static page."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import Config
from .operators import collect, mapview
from .sources.live import live_posts, read_geojson, read_images
from .sources.sample import sample_posts

log = logging.getLogger(__name__)


def recent_posts(spark: SparkSession, config: Config, now: Column, *, force_sample: bool = False, live: Callable[[SparkSession, Config], DataFrame] = live_posts) -> DataFrame:
    """Posts of one collection (with ``demo``): sources, union, window, fallback.  A forced sample calls no source."""
    some = None if force_sample else live(spark, config)
    if some is not None:
        some = some.persist()  # the fallback looks whether a row is there: sources are called once
    return collect.collect_posts(some, sample_posts(spark, now), now, minutes=config.window_minutes, use_fallback=config.use_fallback, force_sample=force_sample)


def response(spark: SparkSession, config: Config | None = None, *, force_sample: bool = False, live: Callable[[SparkSession, Config], DataFrame] = live_posts, now: Column | None = None) -> str:
    """The JSON text of one response; the clock is read once."""
    config = config or Config.from_env()
    if now is None:
        now = F.to_timestamp(F.lit(spark.range(1).select(F.current_timestamp().cast("string")).first()[0]))
    posts = recent_posts(spark, config, now, force_sample=force_sample, live=live)
    try:
        return collect.envelope(posts, now, config.window_minutes).select("json").first()[0]  # one row: the response
    finally:
        spark.catalog.clearCache()


@dataclass(frozen=True)
class Built:
    """What the static build made."""

    html: str
    posts: int
    images: int
    kilobytes: int


def build_static(spark: SparkSession, template: str, geojson_path: str, images_path: str, now: Column) -> Built:
    """The self-contained page of the sample posts, with the build's statistics; the caller writes it."""
    pins = mapview.static_pins(collect.located(sample_posts(spark, now)), now)
    images = mapview.image_table(read_images(spark, images_path))
    text = spark.read.option("wholetext", True).text(geojson_path).select(F.col("value").alias("json"))
    html = mapview.static_page(template, text, pins, images).first().html  # one page
    built = Built(html, pins.count(), images.count(), round(len(html) / 1024))
    log.info("page: posts=%d, images=%d, %d KB", built.posts, built.images, built.kilobytes)
    return built


def map_features(spark: SparkSession, geojson_path: str) -> tuple[DataFrame, DataFrame]:
    """The map's shapes and their bounds, from a GeoJSON file."""
    shapes = mapview.features(read_geojson(spark, geojson_path))
    return shapes, mapview.map_bounds(shapes)


def client_posts(body: str | None) -> list[dict]:
    """The posts of a response body, as a client takes them: an absent list is empty."""
    import json

    return json.loads(body or "{}").get("posts") or []

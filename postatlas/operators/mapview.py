"""Map-ready rows: bounds, projection, paths, pins, display rows and the static page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import confidence_class, confidence_label, either, escape_html, guard_script, image_number, method_label, to_fixed
from ..functions.times import is_fresh, parse_time, time_ago
from .collect import last_by

WIDTH, PAD = 1000.0, 20.0


def features(geojson: DataFrame) -> DataFrame:
    """One row for each feature: number, name and polygons."""
    return geojson.select(F.posexplode("features").alias("feature", "f")).select("feature", F.col("f.properties.nam_ja").alias("name"), F.col("f.geometry.coordinates").alias("polygons"))


def map_bounds(shapes: DataFrame) -> DataFrame:
    """One row: the extremes of all vertices; +-1e9 where there are none.  Extremes are taken per feature first, so no vertex is shuffled."""
    v = F.flatten(F.flatten("polygons"))

    def least(f: Column, i: int, sign: int) -> Column:
        x = F.transform(v, lambda p: F.get(p, F.lit(i)))
        return F.array_min(x) if sign < 0 else F.array_max(x)

    each = shapes.select(least(v, 0, -1).alias("a"), least(v, 0, 1).alias("b"), least(v, 1, -1).alias("c"), least(v, 1, 1).alias("d"))
    big = F.lit(1e9)
    return each.agg(F.coalesce(F.min("a"), big).alias("minLon"), F.coalesce(F.max("b"), -big).alias("maxLon"), F.coalesce(F.min("c"), big).alias("minLat"), F.coalesce(F.max("d"), -big).alias("maxLat"))


def projection(bounds: DataFrame) -> DataFrame:
    """The bounds with kx, scale, width and height of the equirectangular view."""
    kx = F.cos(F.radians((F.col("minLat") + F.col("maxLat")) / 2))
    b = bounds.withColumn("kx", kx).withColumn("scale", (WIDTH - 2 * PAD) / ((F.col("maxLon") - F.col("minLon")) * F.col("kx")))
    return b.withColumn("width", F.lit(WIDTH)).withColumn("height", (F.col("maxLat") - F.col("minLat")) * F.col("scale") + 2 * PAD)


def _xy(lon: Column, lat: Column) -> tuple[Column, Column]:
    return PAD + (lon - F.col("minLon")) * F.col("kx") * F.col("scale"), PAD + (F.col("maxLat") - lat) * F.col("scale")


def project(points: DataFrame, bounds: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Adds x and y; the projection is one broadcast row."""
    x, y = _xy(F.col(lon), F.col(lat))
    return points.crossJoin(F.broadcast(projection(bounds))).select(*points.columns, x.alias("x"), y.alias("y"))


def svg_paths(shapes: DataFrame, bounds: DataFrame) -> DataFrame:
    """(feature, name, d): the rings of each feature in order, one decimal."""

    def vertex(p: Column, i: Column) -> Column:
        x, y = _xy(F.get(p, F.lit(0)), F.get(p, F.lit(1)))
        return F.concat(F.when(i == 0, "M").otherwise("L"), F.format_string("%.1f", to_fixed(x, 1)), F.lit(" "), F.format_string("%.1f", to_fixed(y, 1)))

    ring = lambda r: F.concat(F.array_join(F.transform(r, vertex), " "), F.lit(" Z "))
    d = F.array_join(F.transform(F.flatten("polygons"), ring), "")
    return shapes.crossJoin(F.broadcast(projection(bounds))).select("feature", "name", d.alias("d"))


def page_order(pins: DataFrame) -> DataFrame:
    """The list of the static page: newest first by epoch milliseconds, ties in input order (``ord``)."""
    return pins.orderBy(F.col("createdAt").desc(), F.col("ord").asc())


def display_rows(posts: DataFrame, now: Column) -> DataFrame:
    """What a tooltip or list item shows of each located post, escaped."""
    ts = parse_time(F.col("createdAt"))
    tags = F.transform(F.slice(F.coalesce("tags", F.array().cast("array<string>")), 1, 4), lambda t: F.concat(F.lit("#"), escape_html(t)))
    return posts.select(
        "id",
        escape_html(F.col("locationLabel")).alias("location"),
        confidence_label(F.col("confidence")).alias("confidenceLabel"),
        confidence_class(F.col("confidence")).alias("confidenceClass"),
        method_label(F.col("method")).alias("methodLabel"),
        escape_html(F.col("text")).alias("text"),
        escape_html(either(F.col("authorHandle"), F.col("author"))).alias("author"),
        time_ago(ts, now).alias("ago"),
        is_fresh(ts, now).alias("fresh"),
        F.array_join(tags, " ").alias("tags"),
        F.when(F.coalesce(F.col("url"), F.lit("")) != "", escape_html(F.col("url"))).otherwise(F.col("sourceLabel")).alias("link"),
    )


def static_pins(posts: DataFrame, now: Column) -> DataFrame:
    """The 13 columns of the static page's pins."""
    age = (F.unix_millis(now) - F.unix_millis(parse_time(F.col("createdAt")))) / F.lit(60000.0)
    return posts.select("id", "sourceLabel", "text", "tags", "author", "authorHandle", image_number(F.col("image")).alias("img"), F.floor(age + 0.5).cast("int").alias("minutesAgo"), to_fixed(F.col("lat"), 4).alias("lat"), to_fixed(F.col("lon"), 4).alias("lon"), "locationLabel", "confidence", "method")


def rehydrate(pins: DataFrame, images: DataFrame, now: Column) -> DataFrame:
    """Pins with createdAt (epoch milliseconds) and image; images are (img, uri), a handful of files."""
    return pins.join(images.select(F.col("img"), F.col("uri").alias("image")), "img", "left").withColumn("createdAt", F.unix_millis(now) - F.col("minutesAgo").cast("long") * 60000)


def image_table(files: DataFrame) -> DataFrame:
    """(img, uri) from rows of path and content (binary), as a binaryFile scan gives them; of one number the last path counts."""
    from ..functions.text import encode_uri

    named = files.where(F.col("path").rlike(r"ramen-(\d+)\.svg"))
    rows = named.select(image_number(F.col("path")).alias("img"), F.concat(F.lit("data:image/svg+xml;utf8,"), encode_uri(F.decode("content", "UTF-8"))).alias("uri"), "path")
    return last_by(rows, "img", "path").select("img", "uri")


def static_page(template: str, geojson: DataFrame, pins: DataFrame, images: DataFrame) -> DataFrame:
    """One row ``html``: the template with its three placeholders filled; geojson has one row of ``json``."""
    row = {"ignoreNullFields": "false"}
    posts = pins.agg(F.to_json(F.coalesce(F.collect_list(F.struct(*pins.columns)), F.array()), row).alias("posts"))
    one = images.groupBy("img").agg(F.max("uri").alias("uri"))  # a map has no key twice
    table = one.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("img", "uri")))).alias("images"))
    page = geojson.select(guard_script(F.col("json")).alias("geo")).crossJoin(posts).crossJoin(table)
    html = F.lit(template)
    for mark, value in (("/*__GEOJSON__*/", "geo"), ("/*__POSTS__*/", "posts"), ("/*__IMAGES__*/", "images")):
        html = F.replace(html, F.lit(mark), F.col(value))
    return page.select(html.alias("html"))


def embedded_json(html: Column, element: str) -> Column:
    """The text of an inline JSON script element with this id."""
    return F.regexp_extract(html, f'(?s)<script id="{element}"[^>]*>(.*?)</script>', 1)

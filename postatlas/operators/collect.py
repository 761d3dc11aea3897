"""From sources to located posts: filters, first-wins and last-wins keys, union, window, fallback, projection, order and counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import either
from ..functions.times import in_window, iso, parse_time
from ..schemas import LOCATED_POST, RAW_POST
from ..shared import checkpoint_dir, unused
from .locate import with_estimate


def first_by(df: DataFrame, key: Sequence[str] | str, order: Sequence[str] | str) -> DataFrame:
    """The first row of each key in a given order: an aggregate that combines before the shuffle."""
    key, order = ([x] if isinstance(x, str) else list(x) for x in (key, order))
    return df.groupBy(*key).agg(F.min_by(F.struct(*df.columns), F.struct(*order)).alias("_row")).select("_row.*")


def last_by(df: DataFrame, key: Sequence[str] | str, order: Sequence[str] | str) -> DataFrame:
    """The last row of each key, as a map built in that order has it."""
    key, order = ([x] if isinstance(x, str) else list(x) for x in (key, order))
    return df.groupBy(*key).agg(F.max_by(F.struct(*df.columns), F.struct(*order)).alias("_row")).select("_row.*")


def limit_by(df: DataFrame, key: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """The first n rows of each key: a source's own limit, in a replay."""
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def union_sources(*sources: DataFrame) -> DataFrame:
    """UNION ALL in source order: ``ord`` becomes (source, ordinal in it), kept sortable as one struct."""
    parts = [s.select(F.struct(F.lit(i).alias("s"), F.col("ord").cast("long").alias("o")).alias("ord"), *RAW_POST) for i, s in enumerate(sources)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def window_filter(posts: DataFrame, now: Column, minutes: float, future_seconds: int = 60, created: str = "createdAt") -> DataFrame:
    return posts.withColumn("_ts", parse_time(F.col(created))).where(in_window(F.col("_ts"), now, minutes, future_seconds)).drop("_ts")


def with_fallback(recent: DataFrame, sample: DataFrame, enabled: bool) -> DataFrame:
    """``recent``, or ``sample`` if it has no row; ``demo`` tells which.  Lazy: one row at most is looked at, without an action."""
    recent = recent.withColumn("demo", F.lit(False))
    if not enabled:
        return recent
    n = unused("_n", sample.columns)
    some = recent.limit(1).agg(F.count("*").alias(n))
    stand_in = sample.crossJoin(F.broadcast(some)).where(F.col(n) == 0).drop(n).withColumn("demo", F.lit(True))
    return recent.unionByName(stand_in)


def located(posts: DataFrame) -> DataFrame:
    """The 18 public columns of posts with an estimate (and ord, demo if there); unlocated posts are dropped."""
    e = with_estimate(posts).where(F.col("estimate").isNotNull())
    full = either(F.col("imageFull"), F.col("image"))
    e = e.withColumns({"imageFull": full, "lat": F.col("estimate.lat"), "lon": F.col("estimate.lon"), "locationLabel": F.col("estimate.label"), "pref": F.col("estimate.pref"), "confidence": F.col("estimate.confidence"), "method": F.col("estimate.method")})
    return e.select(*(c for c in ("ord", "demo") if c in posts.columns), *LOCATED_POST)


def newest_first(posts: DataFrame) -> DataFrame:
    """Descending time, ties in input order."""
    return posts.orderBy(parse_time(F.col("createdAt")).desc(), F.col("ord").asc())


def with_rank(posts: DataFrame) -> DataFrame:
    """``rank`` of the newest-first order.

    A global rank needs a total order; positions come from a range-partitioned
    sort: rows are counted per partition, so no single task sees all of them.
    The sorted rows are checkpointed, since both counts and ranks read them.
    """
    checkpoint_dir(posts.sparkSession)
    ordered = newest_first(posts).withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()).checkpoint()
    sizes = ordered.groupBy("_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = sizes.select("_part", "_first", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))  # a row for each partition
    out = ordered.join(F.broadcast(before), "_part")
    return out.withColumn("rank", (F.col("_before") + F.col("_at") - F.col("_first") + 1).cast("long")).drop("_part", "_at", "_first", "_before", "_n")


def counts(posts: DataFrame) -> DataFrame:
    """collected, located and unlocated in one pass."""
    e = with_estimate(posts)
    return e.agg(F.count("*").alias("collected"), F.count_if(F.col("estimate").isNotNull()).alias("located"), F.count_if(F.col("estimate").isNull()).alias("unlocated"))


#: Parts of a window whose posts are put in order by themselves.
SLICES = 100


def envelope(posts: DataFrame, now: Column, minutes: float, joined: Sequence[str] = ()) -> DataFrame:
    """The response as one row: generatedAt, windowMinutes, demo, counts and the located posts newest first, and all of it as ``json``.

    One response holds all its posts; a time window bounds them.  Posts are put
    in order within slices of the window, then the slices, so that no task sorts
    all posts.  With ``joined``, the values of the columns named there stand for
    posts and json, as one text with commas each (null without a value), and
    nothing else of a post is gathered, whatever the size of its text.
    """
    e = with_estimate(posts)
    full = either(F.col("imageFull"), F.col("image"))
    values = {"imageFull": full, "lat": F.col("estimate.lat"), "lon": F.col("estimate.lon"), "locationLabel": F.col("estimate.label"), "pref": F.col("estimate.pref"), "confidence": F.col("estimate.confidence"), "method": F.col("estimate.method")}
    post = F.struct(*(values.get(c, F.col(c)).alias(c) for c in joined or LOCATED_POST))
    t = -F.unix_millis(parse_time(F.col("createdAt")))
    keyed = F.struct(t.alias("t"), F.col("ord").alias("o"), post.alias("p"))

    def texts(posts: Column) -> list[Column]:
        some = {c: F.array_compact(posts[c].cast("array<string>")) for c in joined}
        return [F.when(F.size(x) > 0, F.array_join(x, ",")).alias(c) for c, x in some.items()]

    parts = e.groupBy(F.floor(t / F.lit(max(1.0, minutes * 60_000 / SLICES))).alias("slice")).agg(
        F.bool_or("demo").alias("demo"), F.count("*").alias("collected"), F.count_if(F.col("estimate").isNotNull()).alias("located"), F.count_if(F.col("estimate").isNull()).alias("unlocated"),
        F.transform(F.array_sort(F.collect_list(F.when(F.col("estimate").isNotNull(), keyed))), lambda x: x["p"]).alias("posts"),
    )
    if joined:
        parts = parts.withColumn("posts", F.struct(*texts(F.col("posts"))))
    one = parts.agg(
        F.coalesce(F.bool_or("demo"), F.lit(False)).alias("demo"),
        F.struct(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("collected", "located", "unlocated"))).alias("counts"),
        F.transform(F.array_sort(F.collect_list(F.struct("slice", "posts"))), lambda x: x["posts"]).alias("posts"),
    )
    head = (iso(now).alias("generatedAt"), F.lit(float(minutes)).alias("windowMinutes"), "demo", "counts")
    if joined:
        return one.select(*head, *texts(F.col("posts")))
    out = one.select(*head, F.flatten("posts").alias("posts"))
    return out.withColumn("json", F.to_json(F.struct("generatedAt", "windowMinutes", "demo", "counts", "posts"), {"ignoreNullFields": "false"}))


def collect_posts(live: DataFrame | None, sample: DataFrame, now: Column, *, minutes: float = 60.0, use_fallback: bool = True, force_sample: bool = False) -> DataFrame:
    """Recent posts (with ``demo``): the live ones in the window, else the sample's."""
    recent_sample = window_filter(sample.withColumn("ord", F.struct(F.lit(-1).alias("s"), F.col("ord").cast("long").alias("o"))), now, minutes)
    if force_sample or live is None:
        return recent_sample.withColumn("demo", F.lit(True)) if use_fallback or force_sample else recent_sample.where("false").withColumn("demo", F.lit(False))
    return with_fallback(window_filter(live, now, minutes), recent_sample, use_fallback)

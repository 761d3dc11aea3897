"""Live and captured sources.  A failing source gives an empty partition, never an error."""

from __future__ import annotations

import json
import logging
import time
import urllib.parse
import urllib.request
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..config import Config
from ..schemas import GEOJSON, MASTODON_STATUS, X_RESPONSE

log = logging.getLogger(__name__)


def _get(url: str, headers: dict[str, str], timeout: float) -> str | None:
    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers=headers), timeout=timeout) as r:
            return r.read().decode("utf-8", "replace") if 200 <= r.status < 300 else None
    except Exception as e:
        log.warning("source %s: %s", url.split("?")[0], e)
        return None


def tag_url(instance: str, tag: str) -> str:
    # The path, the limit and the filter of a tag's timeline.
    return f"https://{instance}/api/v1/timelines/tag/{urllib.parse.quote(tag, safe="!'()*~")}?limit=40&only_media=true"


def search_url(query: str) -> str:
    # The fields that are asked for.
    return "https://api.twitter.com/2/tweets/search/recent?" + urllib.parse.urlencode({"query": query, "max_results": "50", "tweet.fields": "created_at,geo,entities,attachments", "expansions": "attachments.media_keys,author_id,geo.place_id", "media.fields": "url,preview_image_url,type", "user.fields": "name,username,profile_image_url,location", "place.fields": "full_name,geo,country"})


class _Job(InputPartition):
    def __init__(self, ord: int, instance: str, url: str):
        self.ord, self.instance, self.url = ord, instance, url


class _Reader(DataSourceReader):
    """One deadline holds for all calls of a collection: what has ended by then is kept."""

    def __init__(self, jobs: list[_Job], headers: dict[str, str], timeout: float):
        self.jobs, self.headers, self.deadline = jobs, headers, time.time() + timeout

    def partitions(self) -> list[InputPartition]:
        return self.jobs

    def read(self, job: _Job | None) -> Iterator[tuple]:
        if job is None:  # no partitions: the engine makes one without a job
            return
        left = self.deadline - time.time()
        body = _get(job.url, self.headers, left) if left > 0 else None
        if body is not None:
            yield job.ord, job.instance, body


class TagTimelines(DataSource):
    """One partition for each (instance, tag), one row of JSON each: ``spark.read.format("tag_timelines")``."""

    @classmethod
    def name(cls) -> str:
        return "tag_timelines"

    def schema(self) -> str:
        return "job long, instance string, body string"

    def reader(self, schema: object) -> DataSourceReader:
        o, d = self.options, Config()
        instances = tuple(x for x in o.get("instances", "").split(",") if x) or d.instances
        tags = tuple(x for x in o.get("tags", "").split(",") if x) or d.tags
        jobs = [_Job(i * len(tags) + j, a, tag_url(a, t)) for i, a in enumerate(instances) for j, t in enumerate(tags)]
        return _Reader(jobs, {"Accept": "application/json", "User-Agent": "postatlas/1.0"}, float(o.get("timeout", d.timeout_seconds)))


class RecentSearch(DataSource):
    """One partition, one row of JSON; none without a token: ``spark.read.format("recent_search")``."""

    @classmethod
    def name(cls) -> str:
        return "recent_search"

    def schema(self) -> str:
        return "job long, instance string, body string"

    def reader(self, schema: object) -> DataSourceReader:
        o, d = self.options, Config()
        token = o.get("token")
        jobs = [_Job(0, "x", search_url(o.get("query", d.x_query)))] if token else []
        return _Reader(jobs, {"Authorization": f"Bearer {token}"}, float(o.get("timeout", d.timeout_seconds)))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(TagTimelines)
    spark.dataSource.register(RecentSearch)


def live_posts(spark: SparkSession, config: Config) -> DataFrame:
    """RawPost rows of all sources that the settings name, in source order; nothing is fetched before the plan runs."""
    from ..operators.collect import union_sources
    from ..operators.normalize import normalize_mastodon, normalize_x

    register(spark)
    tags = spark.read.format("tag_timelines").option("instances", ",".join(config.instances)).option("tags", ",".join(config.tags)).option("timeout", str(config.timeout_seconds)).load()
    search = spark.read.format("recent_search").option("query", config.x_query).option("timeout", str(config.timeout_seconds))
    search = search.option("token", config.x_token) if config.x_token else search
    return union_sources(normalize_mastodon(parse_timelines(tags)), normalize_x(parse_search(search.load())))


def parse_timelines(bodies: DataFrame) -> DataFrame:
    """(job, instance, body) to statuses with instance and ``ord`` in job order; a body that is no array gives none."""
    rows = bodies.where(F.col("body").rlike(r"^\s*\[")).select("job", "instance", F.posexplode(F.from_json("body", f"array<{MASTODON_STATUS}>")).alias("_i", "s"))
    return rows.select((F.col("job") * 1_000_000 + F.col("_i")).cast("long").alias("ord"), "instance", "s.*")


def parse_search(bodies: DataFrame) -> DataFrame:
    """(body) to search responses."""
    return bodies.select(F.from_json("body", X_RESPONSE).alias("r")).where("r is not null").select("r.*")


def fan_out(instances: DataFrame, tags: DataFrame) -> DataFrame:
    """(instance, tag) pairs in job order; both sides are configuration lists."""
    return instances.crossJoin(F.broadcast(tags)).select("instance", "tag", (F.col("i") * 1000 + F.col("j")).alias("job"))


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).schema(GEOJSON).json(path)


def read_images(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def to_body(rows: list[dict]) -> str:
    return json.dumps(rows, ensure_ascii=False)

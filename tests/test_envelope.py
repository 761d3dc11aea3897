"""The envelope's posts: what is gathered of them, their order over slices of the window, and posts without a place."""

import datetime as dt
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from postatlas.operators import collect
from postatlas.plans import catalog
from postatlas.sources.sample import sample_posts

NOW = dt.datetime(2024, 1, 30, 12, 0)


def tables(spark, path, docs):
    """docs: doc_id, text, minutes before NOW."""
    spark.createDataFrame([(i, t, "en", "web", len(t)) for i, t, _ in docs], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, NOW - dt.timedelta(minutes=m), 1) for i, _, m in docs], "event_id long, ts timestamp, user_id long").write.parquet(f"{path}/events.parquet")


def both(spark, path):
    c = duckdb.connect()
    for t in ("documents", "events"):
        c.sql(f"create view {t} as select * from '{path}/{t}.parquet/*.parquet'")
    got = catalog.QUERIES["api_envelope"](spark, str(path)).first()
    return tuple(got), c.sql(catalog.ORACLES["api_envelope"]).fetchall()[0]


def test_nothing_but_ids_and_labels_is_gathered(spark, tmp_path):
    tables(spark, tmp_path, [(1, "博多", 0)])
    most = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        plan = catalog.QUERIES["api_envelope"](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.debug.maxToStringFields", most)
    gathered = [x for x in plan.splitlines() if "Aggregate" in x and "collect_list" in x]
    assert gathered and "locationLabel" in "".join(gathered)
    assert not re.findall(r"\b(?:text|url|image|author|tags)#\d+", "".join(gathered))  # columns of a post that the result has not


def test_order_over_slices(spark, tmp_path):
    # ties in time, neighbours around the edges of slices (864 minutes), posts without a place between, posts beyond the window
    docs = [(10 * k, ("博多 " if k % 3 else "none ") + "z" * k, 60 * 24 * 61 * (k * 7919 % 100) // 100) for k in range(1, 100)]
    docs += [(1000 + 10 * k, "札幌", m) for k, m in enumerate((0, 0, 863, 864, 865, 1727, 1728, 1728, 1729, 86400, 86401))]
    tables(spark, tmp_path, docs)
    got, want = both(spark, tmp_path)
    assert got == want
    when = {f"doc:{i}": (m, i) for i, _, m in docs}
    ids = got[6].split(",")
    assert ids == sorted(ids, key=when.get) and len(ids) == got[4] > 60 and got[5] > 20 and "doc:1100" not in ids


def test_no_post_has_a_place(spark, tmp_path):
    tables(spark, tmp_path, [(10, "nowhere", 0), (20, "nowhere", 5000)])
    got, want = both(spark, tmp_path)
    assert got == want and got[3:] == (2, 0, 2, None, None)


@pytest.mark.parametrize("minutes", [60, 1, 0.001])
def test_texts_are_those_of_the_posts(spark, minutes):
    """With columns named, the one row has the same values as the posts; a window may be short, and no post there."""
    now = F.lit(NOW.replace(tzinfo=dt.timezone.utc))
    posts = collect.collect_posts(None, sample_posts(spark, now), now, minutes=60, force_sample=True)
    posts = posts if minutes >= 1 else posts.where("false")
    e, t = collect.envelope(posts, now, minutes).first(), collect.envelope(posts, now, minutes, ("id", "pref")).first()
    assert (e.demo, e.counts) == (t.demo, t.counts) and len(e.posts) == e.counts.located == (20 if minutes >= 1 else 0)
    assert t.id == (",".join(p.id for p in e.posts) or None) and t.pref == (",".join(p.pref for p in e.posts if p.pref is not None) or None)

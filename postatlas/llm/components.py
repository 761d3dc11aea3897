"""Connected components of links, by alternating large-star and small-star steps.

Each step is a group-by with a minimum (combined before the shuffle) and a join
back; links stay in the cluster, and lineage is cut by a reliable checkpoint
after each round.  A hub's links are not dealt by the hub: nodes that hold more
than a share of all links are few, whatever the number of links, and their
minima are sent to all tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scale import checkpoint_dir


#: A node is a hub from this share of all links on: there are fewer than HUB such nodes.
HUB = 1000


def connected(links: DataFrame, *, rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable over ``links`` (a, b); links of a node with itself count as nodes only."""
    checkpoint_dir(links.sparkSession)
    e = links.where("a is not null and b is not null").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct().checkpoint()
    before = total = None
    for _ in range(rounds):
        # large star: every larger neighbour of a node links to the node's smallest neighbour
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n"))
        total = e.count() if total is None else total
        hubs = least.where(F.col("n") > max(HUB, 2 * total // HUB)).select("u", F.col("m").alias("hub"))
        marked = both.where("v >= u").join(F.broadcast(hubs), "u", "left")
        rest = marked.where("hub is null").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = marked.where("hub is not null").select(F.col("v").alias("a"), F.col("hub").alias("b")).union(rest).distinct()
        # small star: a node and its smaller neighbours link to the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        e = small.distinct().checkpoint()
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before, total = now, now[0]
    else:
        raise RuntimeError("components did not settle")
    return e.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))

"""Connected components of a table of links, in rounds of star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.workspace import written


# A node with more links than a task should have together, and with more than this share of all, is a hub. So there
# are at most twice as many hubs as the inverse of the share, and none while all links are no more than that.
HUB_LINKS, HUB_SHARE = 100_000, 1 / 1000


def components(links: DataFrame, hub_links: int = HUB_LINKS) -> DataFrame:
    """``node``, ``component`` (the smallest node reachable) for links ``a``, ``b`` of longs or structs.

    A round ties all larger neighbours of each node to its smallest one, then all smaller ones, and
    is written to the shared folder. It ends when a round changes nothing; the number of rounds is
    logarithmic in the size of the largest component. Only counts reach the driver. The smallest neighbours
    of hubs, which are few by their definition, go to all tasks, so that no task has all links of a hub.
    Links with a null end or from a node to itself say nothing. Nodes without a link are not in the result.
    """
    edges = written(
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    state, count = None, edges.count()
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("low"), F.count("*").alias("n"))
        least = least.select("a", F.least("low", "a").alias("m"), "n")
        large = _with_least(both, least, 2 * count, hub_links).where("b > a")
        large = large.select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(large.where("a != b").distinct(), "links-large")
        least = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
        small = (
            _with_least(large, least, 2 * count, hub_links)
            .select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b")
            .where("a != b")
            .distinct()
        )
        edges = written(small, "links")
        seen = edges.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.countDistinct("a")
        ).first()
        # A star per component: every node has one link, and to no node that has one itself.
        if seen == state or seen[0] == 0:
            break
        state, count = seen, seen[0]
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def _with_least(links: DataFrame, least: DataFrame, count: int, hub_links: int) -> DataFrame:
    """``links``, at most ``count``, with ``m`` of the node ``a``; that of hubs is joined by broadcast."""
    bound = max(hub_links, int(count * HUB_SHARE))
    if count <= bound:
        return links.join(least.select("a", "m"), "a")
    hubs = least.where(F.col("n") > bound).select(F.col("a").alias("hub"), F.col("m").alias("hub_m"))
    marked = links.join(F.broadcast(hubs), F.col("a") == F.col("hub"), "left")
    apart = marked.where("hub IS NOT NULL").select("a", "b", F.col("hub_m").alias("m"))
    rest = marked.where("hub IS NULL").select("a", "b")
    return rest.join(least.where(F.col("n") <= bound).select("a", "m"), "a").unionByName(apart)

"""Connected components by alternating large-star and small-star steps (Kiveris et al., "Connected Components in
MapReduce and Beyond", 2014): every step is a pre-aggregated minimum and an equi-join. The rows of a hub (a node that
holds a share of all rows) are not shuffled by it: hubs are few by that definition, so their minima are broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import released, staged

#: A node that more than one in so many rows share is a hub; there are at most as many hubs.
HUBS = 1024


def _with_least(rows: DataFrame, least: DataFrame, n: int) -> DataFrame:
    """The ``n`` ``rows`` (u, v) with their node's column ``m`` of ``least`` (u, m and the node's number of rows ``n``)."""
    hubs = F.broadcast(least.where(F.col("n") > n // HUBS).select("u", "m"))
    return rows.join(hubs, "u").unionByName(rows.join(hubs.select("u"), "u", "left_anti").join(least.select("u", "m"), "u"))


def _large_star(edges: DataFrame, n: int) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n"))
    return _with_least(both, least, 2 * n).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def _small_star(down: DataFrame, n: int) -> DataFrame:
    """``down``: edges from the larger node to the smaller one."""
    least = down.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    own = least.select("u", F.col("m").alias("v"))
    rest = _with_least(down.select("u", "v"), least, n).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return own.unionByName(rest).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every linked node that isn't its component's smallest: ``root`` is the smallest node
    reachable. Links may repeat, in either direction, and join a node with itself; no links give no rows. Rounds end
    when the edges stay the same; each is a table in the shared folder."""
    edges = staged(links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct(), "edges")
    state = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now
        down = staged(_large_star(edges, now[0]), "edges")
        stars = staged(_small_star(down, down.count()), "edges")
        released(edges)
        released(down)
        edges = stars

"""Connected components by alternating large-star and small-star steps.

Each step is a min per vertex (combined before the shuffle) and a join.  The minima and
the edges of each step are written to the shared folder, so a plan is one aggregate or
one join long, and neither lineage nor driver memory grows.  Rounds end as soon
as the edges are stars.  A vertex with more
neighbours than a task gets rows on average is not a key that one task joins: the
minima of such hubs, fewer than partitions, are broadcast, and their edges stay where they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import BROADCAST_BYTES, partitions, written

HUB = 1000                     # neighbours of a hub, at least: fewer are no load for a task
ROW_BYTES = 32


def _hub_size(edges: int, parts: int) -> int:
    """Neighbours that make a hub: more than a task's share of rows, and all hubs together fit a broadcast."""
    return max(HUB, 2 * edges // parts, 2 * edges * ROW_BYTES // BROADCAST_BYTES)


def _least(rows: DataFrame) -> DataFrame:
    """u, its least neighbour m, the number of its neighbours n and of smaller ones."""
    return written(rows.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"),
                                         F.count_if(F.col("v") < F.col("u")).alias("smaller")), "minima")


def _told(rows: DataFrame, least: DataFrame, hub: int | None) -> DataFrame:
    """``rows`` (u, v) with the ``m`` of their u; ``hub`` if there may be hubs."""
    if hub is None:
        return rows.join(least.select("u", "m"), "u").select("u", "v", "m")
    hubs = least.where(F.col("n") > hub).select("u", F.col("m").alias("h"))
    marked = rows.join(F.broadcast(hubs), "u", "left")
    rest = marked.where("h is null").select("u", "v").join(least.select("u", "m"), "u")
    return marked.where("h is not null").select("u", "v", F.col("h").alias("m")).unionAll(rest.select("u", "v", "m"))


def _large_star(both: DataFrame, least: DataFrame, hub: int | None) -> DataFrame:
    """The larger neighbours of each vertex move to the least of it and its neighbours."""
    least = least.select("u", F.least("u", "m").alias("m"), "n")
    large = _told(both.where("v > u"), least, hub)
    return written(large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large-stars")


def _small_star(edges: DataFrame, hub: int | None) -> DataFrame:
    """Each vertex and its smaller neighbours move to the least of these."""
    least = _least(edges)
    hubs = hub is not None and (least.agg(F.max("n")).first()[0] or 0) > hub
    small = _told(edges, least, hub if hubs else None).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return written(small.unionAll(least.select("u", F.col("m").alias("v"))).distinct(), "stars")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) for every id with an edge to another one.

    ``component`` is the smallest id reachable.  Loops, repeated edges
    and edges with a null end are ignored; no edges give no rows.
    """
    now = written(edges.where(f"{a} <> {b}").select(
        F.greatest(a, b).cast("bigint").alias("u"), F.least(a, b).cast("bigint").alias("v")).distinct(), "edges")
    while True:
        both = now.select("u", "v").unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _least(both)
        # In a star the centre has no smaller neighbour, and the others have no second one.
        ends, most, unfinished = least.agg(F.sum("n"), F.max("n"), F.bool_or((F.col("smaller") > 0) & (F.col("n") > 1))).first()
        if not unfinished:
            break
        hub = _hub_size(ends // 2, partitions(now.sparkSession))
        large = _large_star(both, least, hub if most > hub else None)
        now = _small_star(large, hub if ends > hub else None)
    return least.select(F.col("u").alias("id"), F.least("u", "m").alias("component"))

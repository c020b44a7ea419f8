"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _smallest(edges: DataFrame) -> DataFrame:
    """``u, m``: the smallest of each node and its neighbours."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame, tasks: int) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (both.join(_smallest(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u != v").coalesce(tasks).distinct().coalesce(tasks))


def _small_star(edges: DataFrame, tasks: int) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    smallest = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(smallest.select("u", F.col("m").alias("v"))).where("u != v").coalesce(tasks).distinct()


# Links that one task of a round takes. Fewer tasks write fewer and fuller shuffle files where links are few.
LINKS_A_TASK = 50_000


def components(links: DataFrame, rounds: int = 50) -> DataFrame:
    """``node, component`` of every node in ``links`` (columns ``u, v``, numbers): the smallest node that it reaches.

    Nodes only ever see the minimum of their neighbours, so no neighbourhood is gathered, and links of a hub move as
    ordinary join rows. Each round is written to the checkpoint folder. An empty table gives an empty one."""
    edges = links.where("u is not null and v is not null and u != v").select("u", "v").distinct().checkpoint()
    tasks = edges.count() // LINKS_A_TASK + 1
    edges, seen = edges.coalesce(tasks), None
    for _ in range(rounds):
        edges = _small_star(_large_star(edges, tasks), tasks).coalesce(tasks).checkpoint()
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            found = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            roots = found.select(F.col("component").alias("node"), "component").distinct()
            return found.union(roots)
        seen = now
    raise RuntimeError(f"no fixed point after {rounds} rounds")

"""Connected components of an edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mergewell.session import cut_lineage


def connected_components(edges: DataFrame, left: str, right: str, max_rounds: int = 60, rows: int | None = None) -> DataFrame:
    """Returns (node, component) for every node of an edge; component is the smallest node reachable.

    Alternates large-star and small-star steps, so long chains take a logarithmic number of rounds.
    Each step is a minimum per node, summed before the shuffle, joined back to the edges, so a node
    with very many edges is split by adaptive skew joins instead of being gathered. Every round ends in
    a checkpoint: a lost executor costs a round at most. rows is about how many rows the edges take to find. Self-loops and null ends are dropped, repeated
    edges count once, and an empty edge list gives an empty result.
    """
    ends = edges.select(F.col(left).alias("u"), F.col(right).alias("v")).where("u is not null and v is not null and u <> v")
    current = cut_lineage(ends.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), rows)
    state = _digest(current)
    for _ in range(max_rounds):
        if state[0] == 0:
            break
        current = cut_lineage(_small_star(_large_star(current)), 2 * state[0])
        now = _digest(current)
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    members = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.unionByName(members.select(F.col("component").alias("node"), "component")).distinct()


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest node of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    linked = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them; edges point from larger to smaller."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    linked = edges.join(low, "u")
    out = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def cluster_sizes(components: DataFrame) -> DataFrame:
    """(component, size), for skew reports."""
    return components.groupBy("component").agg(F.count("*").alias("size"))


def rank_in_component(components: DataFrame) -> DataFrame:
    return components.withColumn("rank", F.row_number().over(Window.partitionBy("component").orderBy("node")))

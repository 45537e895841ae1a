"""Gold clusters from strong and accepted edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mergewell.operators.components import connected_components
from mergewell.operators.consolidate import winner_order


def strong_edges(edges: DataFrame) -> DataFrame:
    """Edges that may merge: of one full identifier and not rejected, or accepted by a person."""
    accepted = F.col("decision") == "accepted"
    return edges.where(accepted | (F.col("blocking_key").startswith("ced:") & (F.coalesce("decision", F.lit("pending")) != "rejected"))).select("left_id", "right_id")


def clusters(edges: DataFrame) -> DataFrame:
    """(id, cluster_id) of all records that strong edges connect."""
    return connected_components(strong_edges(edges), "left_id", "right_id").select(F.col("node").alias("id"), F.col("component").alias("cluster_id"))


def gold_tables(records: DataFrame, members: DataFrame, previous: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """gold_entities (gold_id, winner_id, members), gold_members (gold_id, id) and gold_history (gold_id, action, members).

    A cluster keeps the id that its members had before, the smallest of several; a new one takes its
    cluster id. previous is an earlier gold_members.
    """
    joined = records.join(members, "id")
    if previous is not None:
        old = previous.select("id", F.col("gold_id").alias("old_id")).join(members, "id").groupBy("cluster_id").agg(F.min("old_id").alias("old_id"))
        joined = joined.join(old, "cluster_id", "left").withColumn("gold_id", F.coalesce("old_id", "cluster_id"))
    else:
        joined = joined.withColumn("gold_id", F.col("cluster_id"))
    entities = joined.groupBy("gold_id").agg(F.min_by("id", winner_order()).alias("winner_id"), F.count("*").alias("members"))
    history = entities.select("gold_id", F.when(F.col("members") > 1, "merge").otherwise("passthrough").alias("action"), "members")
    return entities, joined.select("gold_id", "id"), history


def published(records: DataFrame, entities: DataFrame, members: DataFrame) -> DataFrame:
    """Winners of the clusters and records that are in none."""
    winners = records.join(entities.select(F.col("winner_id").alias("id"), "gold_id"), "id")
    orphans = records.join(members.select("id"), "id", "left_anti").withColumn("gold_id", F.lit(None).cast(entities.schema["gold_id"].dataType))
    return winners.unionByName(orphans)

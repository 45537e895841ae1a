"""Exact consolidation: groups of one fingerprint and their winner."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mergewell.functions.scores import tier_rank, trust_rank

#: The columns of a canonical record.
CANONICAL_COLUMNS = {
    "Event": ("name", "event_type", "occurred_at", "affected_states", "magnitude", "depth_km", "status", "external_ids"),
    "AcopioCenter": ("event_id", "name", "location", "confidence_score", "status", "needs", "last_verified_at", "managing_org", "contact_hmac", "contact_masked", "capacity", "current_load"),
}


def winner_order(rank: Column | None = None) -> Column:
    """A struct that is smallest for the winner: best tier, newest fetch (unknown last), highest confidence, oldest creation, source, id."""
    fetched = F.col("fetched_at").try_cast("timestamp")
    return F.struct(
        (tier_rank(F.col("trust_tier")) if rank is None else rank).alias("tier"), fetched.isNull().alias("unknown"), (-F.unix_micros(fetched)).alias("fetched"),
        (-F.coalesce(F.col("confidence_score").try_cast("double"), F.lit(0.0))).alias("confidence"), F.col("created_at"), F.col("source_id"), F.col("id"),
    )


def pick_winners(records: DataFrame, key: str = "dedup_hash", rank: Column | None = None) -> DataFrame:
    """One row for each non-empty key: the winner's columns and group_size. Groups are global; partial minima are taken before the shuffle, so a hot key sends one row a task."""
    kept = records.where(F.col(key).isNotNull() & (F.col(key) != ""))
    best = kept.groupBy(key).agg(F.min_by(F.struct(*[c for c in records.columns if c != key]), winner_order(rank)).alias("w"), F.count("*").alias("group_size"))
    return best.select(key, "w.*", "group_size")


def canonical_records(winners: DataFrame, entity_type: str, version: int = 1) -> DataFrame:
    known = [c for c in CANONICAL_COLUMNS[entity_type] if c in winners.columns]
    return winners.select("dedup_hash", F.lit(version).alias("dedup_version"), F.col("id").alias("winner_id"), *known)


def deduplicate_typed(entities: DataFrame, key: str = "fingerprint", position: str = "pos") -> DataFrame:
    """The most trusted entity of each key, first one of equals, at the position of the key's first one."""
    grouped = entities.groupBy(key).agg(F.max_by(F.struct(*[c for c in entities.columns if c != key]), F.struct(trust_rank(F.col("trust_tier")), -F.col(position))).alias("w"), F.min(position).alias("first_pos"))
    return grouped.select(key, "w.*", "first_pos")


def first_seen(items: DataFrame, seen: DataFrame, key: str = "fingerprint", position: str = "pos") -> DataFrame:
    """Items whose key no earlier item and no earlier run had; items without a key always pass."""
    keyless = items.where(F.col(key).isNull() | (F.col(key) == ""))
    keyed = items.where(F.col(key).isNotNull() & (F.col(key) != ""))
    new = keyed.join(seen.select(key).distinct(), key, "left_anti")
    first = new.groupBy(key).agg(F.min_by(F.struct(*[c for c in items.columns if c != key]), position).alias("w")).select(key, "w.*")
    return first.select(*items.columns).unionByName(keyless)


def _free(df: DataFrame, stem: str) -> str:
    """A column name that df does not have."""
    taken = {c.lower() for c in df.columns}
    while stem in taken:
        stem += "_"
    return stem


def latest(rows: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """One row for each key: the last by order (null first), among equals, or without an order, the one of the largest hash of its values."""
    others = [c for c in rows.columns if c not in keys]
    rank = F.struct(*([F.col(order).isNotNull(), F.col(order)] if order else []), F.xxhash64(*others))
    best = _free(rows, "best")
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*others), rank).alias(best)).select(*keys, f"{best}.*").select(*rows.columns) if others else rows.distinct()


def union_by_id(primary: DataFrame, extra: DataFrame, key: str = "id") -> DataFrame:
    """One row for each id, from primary where it has one, among equals the one of the smallest hash; rows without an id all stay."""
    part = _free(primary, "part")
    both = primary.withColumn(part, F.lit(0)).unionByName(extra.withColumn(part, F.lit(1)))
    others = [c for c in both.columns if c != key]
    best = both.where(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(F.struct(*others), F.struct(part, F.xxhash64(*others))).alias("w"))
    return best.select(key, "w.*").select(*primary.columns).unionByName(both.where(F.col(key).isNull()).select(*primary.columns))


def upsert(current: DataFrame, new: DataFrame, keys: list[str], keep: tuple[str, ...] = (), order: str | None = None) -> DataFrame:
    """current with new's rows in place of those of equal keys; columns in keep hold their old value.

    A key that new holds several times counts once, with its last row by the column order (see latest);
    order itself need not be a column of current. Null keys match nothing and are inserted. For tables
    without MERGE: write the result as a new version.
    """
    fresh = latest(new, keys, order)
    mark = _free(fresh, "is_new")
    there = F.col(f"n.{mark}").isNotNull()
    marked = current.alias("o").join(fresh.withColumn(mark, F.lit(1)).alias("n"), keys, "full_outer")
    out = []
    for c in current.columns:
        if c in keys:
            out.append(F.col(c))
        elif c in keep:
            out.append(F.coalesce(F.col(f"o.{c}"), F.col(f"n.{c}")).alias(c))
        else:
            out.append(F.when(there, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c))
    return marked.select(*out)


def insert_ignore(current: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of new, one for each key, that current does not have."""
    return new.dropDuplicates(keys).join(current.select(*keys), keys, "left_anti")


def keyset_page(records: DataFrame, size: int, after: tuple | None = None, order: tuple[str, str] = ("created_at", "id")) -> DataFrame:
    """The next rows in order after a cursor; for pages only, whole deltas need no limit."""
    if after is not None:
        records = records.where(F.struct(*order) > F.struct(*[F.lit(v).cast(records.schema[c].dataType) for c, v in zip(order, after)]))
    return records.orderBy(*order).limit(size)


def limit_per_source(records: DataFrame, most: int, source: str = "source_id", order: tuple[str, ...] = ("page", "pos")) -> DataFrame:
    place = _free(records, "place")
    return records.withColumn(place, F.row_number().over(Window.partitionBy(source).orderBy(*order))).where(F.col(place) <= most).drop(place)


def group_by_signature(rows: DataFrame, payload: str) -> DataFrame:
    """(signature, rows): how many rows have exactly the same keys in a map column."""
    return rows.groupBy(F.array_join(F.array_sort(F.map_keys(payload)), ",").alias("signature")).agg(F.count("*").alias("rows"))

"""Sharding by histogram sort: exact byte counts below probed key boundaries, refined until they meet a tolerance, then one exchange."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mergewell.session import cut_lineage

LAW = "bytes"
#: Largest distance of a boundary from its target, as a share of a shard; a single row may exceed it.
TOLERANCE = 0.0005
#: Keys looked at for each open boundary in a round. At most PROBES + a few times its square root, times the shards, reach the driver.
PROBES = 64
#: Scan tasks; with the shards they bound the table of offsets, 24 bytes each.
TASKS = 50_000
#: Rows of a shard that the exchange deals to one task.
TASK_ROWS = 1_000_000
KEY = ("k1", "k2", "k3")
FIRST = "first"
Key = tuple[int, int, int]


def measured(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, k1, k2, k3, part): the sort key and the scan task of each row.

    The key is the text's hash, the id's and the number of the row, so equal texts are neighbours, a
    large group of copies can be divided, and no two rows share a key, not even equal ones.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    size = F.when(F.col(text).isNull(), F.lit(1)).otherwise(F.octet_length(body) + 1)
    return documents.select(
        F.col(doc_id).alias("doc_id"), size.cast("long").alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"),
        F.xxhash64(body).alias("k1"), F.xxhash64(F.col(doc_id)).alias("k2"), F.monotonically_increasing_id().alias("k3"), F.spark_partition_id().alias("part"),
    )


def _below(keys: list[np.ndarray], probes: np.ndarray) -> np.ndarray:
    """For each key, how many of the sorted probes are not above it; keys and probes hold the parts column by column."""
    first = probes[:, 0]
    at, end = np.searchsorted(first, keys[0], "left"), np.searchsorted(first, keys[0], "right")
    if len(keys) == 1:
        return end
    for a in np.unique(at[end > at]):
        rows = np.flatnonzero((at == a) & (end > at))
        at[rows] = a + _below([k[rows] for k in keys[1:]], probes[a : end[rows[0]], 1:])
    return at


def _columns(part: pd.DataFrame) -> list[np.ndarray]:
    return [part[k].to_numpy() for k in KEY]


def histogram(keys: DataFrame, probes: list[Key]) -> tuple[np.ndarray, np.ndarray]:
    """Exact bytes and rows below each probe, over all keys; each task sends one row a bucket it met."""
    table = np.array(probes, np.int64).reshape(-1, len(KEY))

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size, rows = np.zeros(len(table) + 1, np.int64), np.zeros(len(table) + 1, np.int64)
        for part in parts:
            at = _below(_columns(part), table)
            np.add.at(size, at, part["size"].to_numpy())
            rows += np.bincount(at, minlength=len(rows))
        met = np.flatnonzero(rows)
        yield pd.DataFrame({"bucket": met, "size": size[met], "n": rows[met]})

    total = np.zeros((2, len(probes) + 1), np.int64)
    counted = keys.select(*KEY, "size").mapInPandas(count, "bucket long, size long, n long")
    for r in counted.groupBy("bucket").agg(F.sum("size").alias("size"), F.sum("n").alias("n")).collect():
        total[:, r["bucket"]] = r["size"], r["n"]
    sums = total.cumsum(1)
    return sums[0], sums[1]


def _candidates(keys: DataFrame, gaps: list[tuple[Key | None, Key | None]], rows: int, wanted: int, turn: int) -> list[Key]:
    """Keys inside the open gaps, each kept by its hash with the chance that gives about wanted of them; all of them where they are few."""
    bounds = sorted({k for g in gaps for k in g if k is not None})
    inside = [0 if low is None else bounds.index(low) + 1 for low, _ in gaps]
    table = np.array(bounds, np.int64).reshape(-1, len(KEY))
    share = min(1.0, wanted / max(rows, 1))

    def pick(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            at = _below(_columns(part), table)
            mixed = part["h"].to_numpy().view(np.uint64) >> np.uint64(11)
            keep = np.isin(at, inside) & (mixed < np.uint64(share * 2**53) if share < 1 else True)
            yield part.loc[keep, list(KEY)]

    drawn = keys.select(*KEY, F.xxhash64(*KEY, F.lit(turn)).alias("h")).mapInPandas(pick, "k1 long, k2 long, k3 long")
    return [tuple(r) for r in drawn.collect()]


def find_splitters(keys: DataFrame, parts: int) -> list[Key | str | None]:
    """parts - 1 boundaries, the first keys of all shards but the first; FIRST where no row comes before, None where none is left.

    Every round draws keys inside the gaps that still hold a target, counts the exact bytes below all of
    them in one pass and narrows the gaps. A boundary is settled when it is within TOLERANCE of a shard
    of its target, or when all keys of its gap have been counted; then the nearest key is taken. Keys are
    unique, so every gap runs empty. What reaches the driver depends on parts alone.
    """
    total = keys.agg(F.sum("size").alias("size"), F.count("*").alias("n")).first()
    if not total["n"] or parts < 2:
        return []
    goals = [total["size"] * j / parts for j in range(1, parts)]
    slack = TOLERANCE * total["size"] / parts
    low: list[tuple[Key | None, int, int]] = [(None, 0, 0)] * len(goals)
    high: list[tuple[Key | None, int, int]] = [(None, total["size"], total["n"])] * len(goals)
    done: dict[int, Key | str | None] = {}
    turn = 0
    while still := [j for j in range(len(goals)) if j not in done]:
        gaps = {(low[j][0], high[j][0]): high[j][2] - low[j][2] for j in still}
        wanted, rows = PROBES * len(gaps), sum(gaps.values())
        probes = sorted(set(_candidates(keys, list(gaps), rows, wanted, turn)) - {k for g in gaps for k in g})
        turn += 1
        if probes:
            sizes, counts = histogram(keys, probes)
            for j in still:
                for key, size, n in zip(probes, sizes[:-1].tolist(), counts[:-1].tolist()):
                    if low[j][2] < n and size <= goals[j]:
                        low[j] = (key, size, n)
                    elif goals[j] < size and n < high[j][2]:
                        high[j] = (key, size, n)
        for j in still:
            near = min(low[j], high[j], key=lambda b: abs(b[1] - goals[j]))
            if abs(near[1] - goals[j]) <= slack or rows <= wanted:
                done[j] = near[0] if near[0] is not None else (FIRST if near[2] == 0 else None)
    return [done[j] for j in range(len(goals))]


def _shard_of(splitters: list[Key | str | None]) -> Column:
    """The number of splitters that are not above the key."""
    number = F.lit(0)
    for s in splitters:
        if s == FIRST:
            number = number + 1
        elif s is not None:
            a, b, c = s
            reached = (F.col("k1") > a) | ((F.col("k1") == a) & ((F.col("k2") > b) | ((F.col("k2") == b) & (F.col("k3") >= c))))
            number = number + reached.cast("int")
    return number


def shard(documents: DataFrame, shards: int = 16, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every document.

    Law `bytes`: the shards are consecutive ranges of the key order, equal in bytes up to the tolerance
    and the size of one document. A null text has size 1. Copies, repeated rows and null ids are divided
    like any others. The keys are written once, without a shuffle; rows of each scan task and shard are
    counted, and their sums give every task its first slot in each shard, so slots are gapless and the
    one exchange deals a shard's rows to tasks of TASK_ROWS slots, however large a shard is. Slots follow the input
    order. An empty table gives an empty result, and shards without rows do not appear. grown_shard is null under this law.
    """
    made = measured(documents.coalesce(TASKS), doc_id, text)
    keys = cut_lineage(made)
    splitters = find_splitters(keys, shards)
    placed = keys.withColumn("shard", _shard_of(splitters))
    counted = placed.groupBy("part", "shard").agg(F.count("*").alias("n"))
    start = F.sum("n").over(Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = cut_lineage(counted.select("part", "shard", F.coalesce(start, F.lit(0)).alias("start")))

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Appends each row's place among those of its scan task and shard; a scan task's rows lie in one task, in order."""
        seen: dict[int, int] = {}
        for batch in batches:
            pair = batch.column("part").to_numpy().astype(np.int64) * shards + batch.column("shard").to_numpy()
            order = np.argsort(pair, kind="stable")
            kinds, first, size = np.unique(pair[order], return_index=True, return_counts=True)
            at = np.empty(len(pair), np.int64)
            at[order] = np.arange(len(pair)) - np.repeat(first, size) + np.repeat([seen.get(k, 0) for k in kinds.tolist()], size)
            for k, n in zip(kinds.tolist(), size.tolist()):
                seen[k] = seen.get(k, 0) + n
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at)], [*batch.schema.names, "at"])

    fields = placed.select("doc_id", "size", "text_crc32", "part", "shard")
    rows = fields.mapInArrow(numbered, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields.schema.fields) + ", at long")
    slotted = rows.join(F.broadcast(starts), ["part", "shard"]).withColumn("slot", F.col("start") + F.col("at"))  # at most TASKS * shards rows
    tasks = max(1, int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = slotted.withColumn("block", F.floor(F.col("slot") / TASK_ROWS)).repartition(tasks, "shard", "block")
    return dealt.select("doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))

"""Pieces that several corpus operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mergewell.session import cut_lineage

#: Rows of (key, a few numbers) up to which a join broadcasts; beyond, rows of a key from which it is joined apart.
BROADCAST_ROWS, HOT_ROWS = 500_000, 10_000


def remainder(doc_id: Column) -> Column:
    """crc32 of the id written as text, modulo 5; labels of remainder 0 are held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def text_bytes(values) -> Iterator[bytes]:
    """UTF-8 of the texts of an Arrow column; null is empty."""
    for value in values.cast("large_binary"):
        yield value.as_py() or b""


def chunks(items: Iterable[bytes], limit: int = 4 << 20) -> Iterator[list[bytes]]:
    """Lists of consecutive items of limit bytes together, or of one larger item."""
    held: list[bytes] = []
    size = 0
    for item in items:
        if held and size + len(item) > limit:
            yield held
            held, size = [], 0
        held.append(item)
        size += len(item)
    if held:
        yield held


def text_key(text: Column) -> Column:
    """Identity of a whole text: the first 128 bits of its SHA-256, so that distinct texts never count as one; null for null."""
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that df does not have, in any case."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def join_small(wide: DataFrame, found: DataFrame, key: str, how: str = "left", values: int | None = None) -> DataFrame:
    """wide joined with found on key, of which found holds each value once; found must be materialised.

    Up to BROADCAST_ROWS rows, or values in all where its rows hold arrays, found is broadcast. Beyond,
    both sides are shuffled by the key, but for keys with more than HOT_ROWS rows in wide: their few rows
    of found are broadcast, so no task gets all rows of a hot key. Null keys match nothing and are not shuffled.
    """
    if (found.count() if values is None else values) <= BROADCAST_ROWS:
        return wide.join(F.broadcast(found), key, how)
    hot = cut_lineage(wide.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("rows")).where(F.col("rows") > HOT_ROWS).select(key))
    listed = F.broadcast(hot)  # a row for HOT_ROWS rows of wide
    cold = wide.where(F.col(key).isNotNull()).join(listed, key, "left_anti").join(found, key, how)
    apart = wide.join(listed, key, "left_semi").join(F.broadcast(found.join(listed, key, "left_semi")), key, how)
    without = wide.where(F.col(key).isNull()).join(F.broadcast(found.limit(0)), key, how)
    return cold.unionByName(apart).unionByName(without)


def training_rows(documents: DataFrame, labels: DataFrame, label: str, per_class: int) -> tuple[list[tuple[bytes, bool]], dict[bool, int]]:
    """A bounded sample of labelled documents of remainders 1 to 4, whole, and how many labelled ids each class has.

    At most per_class documents of either class, chosen by a hash of the id, reach the driver. A document
    labelled more than once takes the majority, ties count as true; an id that comes with several texts
    takes the one of the smallest SHA-256. Null labels, ids and texts are ignored; empty tables give an empty sample.
    """
    known = (
        labels.select("doc_id", F.col(label).cast("double").alias("y")).where("doc_id is not null and y is not null")
        .where(remainder(F.col("doc_id")) != 0).groupBy("doc_id").agg((F.avg("y") >= 0.5).alias("y"))
    )
    counts = {bool(r["y"]): r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    chosen = [known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for y in sorted(counts)]
    if not chosen:
        return [], counts
    wanted = F.broadcast(chosen[0] if len(chosen) == 1 else chosen[0].unionByName(chosen[1]))  # at most 2 * per_class rows
    met = documents.where("text is not null").select("doc_id", "text").join(wanted, "doc_id")
    rows = met.groupBy("doc_id", "y").agg(F.min_by("text", F.sha2("text", 256)).alias("text")).collect()
    rows.sort(key=lambda r: r["doc_id"])
    return [(r["text"].encode(), r["y"]) for r in rows], counts


def logistic(features, target, weight, rounds: int = 400, penalty: float = 1e-3):
    """Weighted logistic regression by Newton steps on standardised features; returns (mean, scale, coefficients)."""
    import numpy as np

    mean, scale = features.mean(0), features.std(0) + 1e-9
    x = np.hstack([(features - mean) / scale, np.ones((len(features), 1))])
    beta = np.zeros(x.shape[1])
    weight = weight / weight.sum()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + penalty * np.eye(len(beta)), x.T @ (weight * (target - p)) - penalty * beta * np.r_[np.ones(len(beta) - 1), 0])
        size = np.abs(step).max()
        beta += step * min(1.0, 2.0 / (size + 1e-12))
        if size < 1e-6:
            break
    return mean, scale, beta


def probability(model, features):
    import numpy as np

    mean, scale, beta = model
    return 1 / (1 + np.exp(-np.clip(((features - mean) / scale) @ beta[:-1] + beta[-1], -30, 30)))

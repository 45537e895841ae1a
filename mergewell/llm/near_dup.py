"""SimHash near-duplicates through deletion-variant signatures."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import arrow_udf

from mergewell.llm.common import free_name, join_small, text_bytes, text_key
from mergewell.operators.components import connected_components
from mergewell.session import cut_lineage, cut_scan

#: Fingerprints that differ in at most this many bits are linked. Two segments of 32 bits then include one that differs in at most one.
MOST = 3
SEGMENT_BITS = 32
#: A pair of neighbouring segment values with more pairs of fingerprints than this is linked through stars instead of pairs.
STAR_FROM = 4096


def hashes_of(text: bytes, width: int) -> np.ndarray:
    """The hash of each word shingle, repeats included; a shorter text is one shingle, a text without words has the one hash 0."""
    words = text.lower().split()  # bytes.lower() and bytes.split() know ASCII only
    if not words:
        return np.zeros(1, np.uint64)
    hashed, n = xxhash.xxh64_intdigest, max(1, len(words) - width + 1)
    return np.fromiter((hashed(b" ".join(words[i : i + width]), 42) for i in range(n)), np.uint64, n)


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half the hashes."""
    total = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65536):
        part = np.unpackbits(hashes[i : i + 65536].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        total += part.sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(total * 2 > len(hashes)).tobytes(), "big")


def fingerprint_of(text: bytes, width: int) -> int:
    return majority(hashes_of(text, width))


def fingerprints(documents: DataFrame, text: str = "text", width: int = 3, into: str = "fp") -> DataFrame:
    """All rows and columns, with the signed 64-bit SimHash of the whole text; null and empty texts have 0."""

    @arrow_udf("long")
    def hashed(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            values = np.array([fingerprint_of(t, width) for t in text_bytes(part)], np.uint64)
            yield pa.array(values.view(np.int64), pa.int64())

    return documents.withColumn(into, hashed(F.col(text)))


def _segment(fp: Column, which: int) -> Column:
    return F.shiftrightunsigned(fp, SEGMENT_BITS) if which == 0 else fp.bitwiseAND(F.lit((1 << SEGMENT_BITS) - 1))


def _long(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _flips(value: Column, most: int) -> Column:
    """An array of (z, d): the 32-bit value with each choice of at most `most` bits flipped, and how many."""
    masks = [(0, 0)] + [(1 << i, 1) for i in range(SEGMENT_BITS)]
    if most > 1:
        masks += [((1 << i) | (1 << j), 2) for i in range(SEGMENT_BITS) for j in range(i)]
    literal = F.array(*[F.struct(F.lit(m).cast("long").alias("m"), F.lit(d).alias("d")) for m, d in masks])
    return F.transform(literal, lambda x: F.struct(value.bitwiseXOR(x["m"]).alias("z"), x["d"].alias("d")))


def links(distinct: DataFrame, rows: int) -> DataFrame:
    """Edges (a, b) between distinct fingerprints, enough to connect every two that differ in at most three bits, none between others that are not so connected.

    Each fingerprint is cut into two segments, one of which differs in at most one bit between linked
    fingerprints. Every distinct segment value is indexed under its 32 one-wildcard variants; an
    equality join of the variants whose wildcard hides 0 with those where it hides 1 gives each pair of
    neighbouring values once (a variant holds two values at most, so nothing is hot here). Values and their
    neighbours then join the fingerprints that carry them, and the whole fingerprints are compared.
    Two values that many fingerprints carry are not paired: these fingerprints meet at the variants of
    their other segment (at most one bit flipped on either side, or one on one side and two on the
    other where the first segments are equal), and all that meet are linked to the smallest of them.
    Whoever meets so differs in at most three bits, and everyone who does meets: the links are as exact,
    in a number proportional to the fingerprints.
    """
    by_segment = cut_lineage(distinct.select(F.col("fp"), F.explode(F.array(*[F.struct(F.lit(s).alias("s"), _segment(F.col("fp"), s).alias("v"), _segment(F.col("fp"), 1 - s).alias("o")) for s in (0, 1)])).alias("x")).select("fp", "x.s", "x.v", "x.o"), 2 * rows)
    values = cut_lineage(by_segment.groupBy("s", "v").agg(F.count("*").alias("n")), 2 * rows)
    positions = F.array(*[F.lit(i) for i in range(SEGMENT_BITS)])
    variants = values.select("s", "v", "n", F.explode(positions).alias("w")).withColumn("bit", F.lit(1).cast("long").bitwiseAND(F.expr("shiftrightunsigned(v, w)")))
    variants = variants.withColumn("key", F.col("v").bitwiseAND(F.expr("~shiftleft(1L, w)")))
    zero = variants.where("bit = 0").select("s", "w", "key", F.col("v").alias("v0"), F.col("n").alias("n0"))
    one = variants.where("bit = 1").select("s", "w", "key", F.col("v").alias("v1"), F.col("n").alias("n1"))
    near = zero.join(one, ["s", "w", "key"]).select("s", "v0", "v1", "n0", "n1")
    same = values.where("n > 1").select("s", F.col("v").alias("v0"), F.col("v").alias("v1"), F.col("n").alias("n0"), F.col("n").alias("n1"))
    pairs = cut_lineage(near.unionByName(same), 16 * rows)
    few = pairs.where(F.col("n0") * F.col("n1") <= STAR_FROM).select("s", "v0", "v1")
    left = few.join(by_segment.select("s", F.col("v").alias("v0"), F.col("fp").alias("a")), ["s", "v0"])
    candidates = left.join(by_segment.select("s", F.col("v").alias("v1"), F.col("fp").alias("b")), ["s", "v1"])
    verified = candidates.where((F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MOST) & ((F.col("v0") != F.col("v1")) | (F.col("a") < F.col("b")))).select("a", "b")
    many = pairs.where(F.col("n0") * F.col("n1") > STAR_FROM).select("s", "v0", "v1")
    if many.isEmpty():
        return verified
    return verified.unionByName(_stars(by_segment, many))


def _stars(by_segment: DataFrame, many: DataFrame) -> DataFrame:
    equal = many.where("v0 = v1").select("s", F.col("v0").alias("v"), F.col("v0").alias("mate"))
    other = many.where("v0 <> v1")
    other = other.select("s", F.col("v0").alias("v"), F.col("v1").alias("mate")).unionByName(other.select("s", F.col("v1").alias("v"), F.col("v0").alias("mate")))
    met_equal = by_segment.join(equal, ["s", "v"]).select("fp", "s", F.col("v").alias("low"), F.col("v").alias("high"), F.explode(_flips(F.col("o"), 2)).alias("x"))
    met_other = by_segment.join(other, ["s", "v"]).select("fp", "s", F.least("v", "mate").alias("low"), F.greatest("v", "mate").alias("high"), F.explode(_flips(F.col("o"), 1)).alias("x"))
    met = met_equal.unionByName(met_other).select("fp", "s", "low", "high", "x.z", "x.d")
    meeting = Window.partitionBy("s", "low", "high", "z")
    centred = met.withColumn("centre", F.min(F.when(F.col("d") <= 1, F.col("fp"))).over(meeting))
    return centred.where("centre is not null and centre <> fp").select(F.col("fp").alias("a"), F.col("centre").alias("b")).distinct()


def near_duplicates(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """(doc_id, fp, component_id) for every document; component_id is the smallest id of those reachable through links.

    Documents of one fingerprint count as one from the start; fingerprints, not documents, are linked.
    Null and empty texts have fingerprint 0. Repeated rows are returned as often as they come. A group
    whose ids are all null has a null component. An empty table gives an empty result.
    """
    marked = cut_scan(fingerprints(documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text", width).drop("text"), documents)
    rows = marked.count()
    distinct = cut_lineage(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), rows)
    components = connected_components(links(distinct, rows), "a", "b", rows=rows)
    classes = distinct.join(components, distinct["fp"] == components["node"], "left").select("fp", "first", F.coalesce("component", "fp").alias("c"))
    smallest = classes.groupBy("c").agg(F.min("first").alias("component_id"))
    named = cut_lineage(classes.join(smallest, "c").select("fp", "component_id"), rows)
    return join_small(marked, named, "fp").select("doc_id", "fp", "component_id")


#: Texts that share this much of their distinct shingles are near copies for keep_first.
JACCARD = 0.8
#: Min-hashes: BANDS keys of ROWS each. Two texts at 0.8 meet in no key with a chance of (1 - 0.8 ** 4) ** 24, 3 in a million; above 0.8 it is less.
BANDS, ROWS = 24, 4
#: Rounds in which the texts of a key are compared with one of them only; the pairs of texts still apart are then all compared.
STARS = 3
_FACTORS = np.random.default_rng(42).integers(1, 1 << 32, BANDS * ROWS, np.uint32) | np.uint32(1)


def shingles_of(text: bytes, width: int) -> np.ndarray:
    """The sorted distinct hashes of the word shingles."""
    return np.unique(hashes_of(text, width))


def bands_of(shingles: np.ndarray) -> np.ndarray:
    """BANDS keys; two texts share one where ROWS of their min-hashes agree."""
    short = shingles.astype(np.uint32)
    least = np.full(len(_FACTORS), np.iinfo(np.uint32).max, np.uint32)
    for i in range(0, len(short), 2048):
        np.minimum(least, (_FACTORS[:, None] * short[None, i : i + 2048]).min(1), out=least)
    return np.array([xxhash.xxh64_intdigest(least[b * ROWS : (b + 1) * ROWS].tobytes(), b) for b in range(BANDS)], np.uint64)


def _signed(documents: DataFrame, width: int) -> DataFrame:
    """(k, x.s, x.n, x.bands, x.fp): the 128-bit hash of each text's shingle set, its size, its keys and its SimHash."""

    @arrow_udf("struct<s:binary,n:long,bands:array<long>,fp:long>")
    def signed(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            sets, marks = [], []
            for t in text_bytes(part):
                hashes = hashes_of(t, width)
                sets.append(np.unique(hashes))
                marks.append(majority(hashes))
            bands = np.array([bands_of(x) for x in sets], np.uint64).reshape(-1)
            hashes = [xxhash.xxh3_128_digest(x.tobytes()) for x in sets]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(bands) + 1, BANDS), pa.int32()), pa.array(bands.view(np.int64)))
            yield pa.StructArray.from_arrays([pa.array(hashes, pa.binary()), pa.array([len(x) for x in sets], pa.int64()), lists, pa.array(np.array(marks, np.uint64).view(np.int64))], ["s", "n", "bands", "fp"])

    return documents.withColumn("x", signed("text")).select("k", "x.*")


def _sets(documents: DataFrame, width: int) -> DataFrame:
    @arrow_udf("array<long>")
    def sets(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            found = [shingles_of(t, width).view(np.int64) for t in text_bytes(part)]
            ends = np.cumsum([0] + [len(x) for x in found])
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(found) if found else np.zeros(0, np.int64)))

    return documents.withColumn("set", sets("text")).select("s", "set")


def _alike(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose shingle sets have a Jaccard similarity of JACCARD or more."""
    both = pairs.join(sets.select(F.col("s").alias("a"), F.col("set").alias("x")), "a").join(sets.select(F.col("s").alias("b"), F.col("set").alias("y")), "b")
    common = F.size(F.array_intersect("x", "y"))
    # 5 common >= 4 union, in whole numbers, is a similarity of 0.8 or more
    return both.where(round(JACCARD * 10) * (F.size("x") + F.size("y") - common) <= 10 * common).select("a", "b")


def _near_enough(n: str, m: str) -> Column:
    """Sets whose sizes alone leave JACCARD possible."""
    return 10 * F.least(n, m) >= round(JACCARD * 10) * F.greatest(n, m)


def _marked_alike(distinct: DataFrame, rows: int) -> DataFrame:
    """The pairs (a, b) of sets that SimHash proposes: those of one fingerprint with the smallest of them, and the smallest ones of linked fingerprints."""
    marks = cut_lineage(distinct.groupBy("fp").agg(F.min(F.struct("s", "n")).alias("x")), rows)
    own = distinct.select("fp", "s", "n").join(marks, "fp").where(F.col("s") != F.col("x.s")).select("s", "n", F.col("x.s").alias("t"), F.col("x.n").alias("m"))
    a, b = (marks.select(F.col("fp").alias(c), F.col("x.s").alias(s), F.col("x.n").alias(n)) for c, s, n in (("a", "s", "n"), ("b", "t", "m")))
    met = links(marks.select("fp"), rows).join(a, "a").join(b, "b").select("s", "n", "t", "m")
    return own.unionByName(met).where(_near_enough("n", "m")).select(F.col("s").alias("a"), F.col("t").alias("b")).distinct()


def similar_classes(documents: DataFrame, width: int = 5) -> DataFrame:
    """(k, c) for every row of (k, text): c is the smallest k reachable through texts of a Jaccard similarity of JACCARD or more.

    SimHash proposes first: texts of one fingerprint and those of fingerprints that `links` joins. Its
    three bits do not reach down to JACCARD, so texts still apart that share a min-hash key are compared
    too. Every candidate is verified on the exact shingle sets. The texts of a key are first compared
    with one of them, another in each of STARS rounds, so a large group of copies needs no pairs; then
    every two texts of a key that are still in different classes are compared.
    """
    marked = cut_scan(_signed(documents, width), documents)
    rows = marked.count()
    distinct = cut_lineage(marked.groupBy("s").agg(F.min("k").alias("first"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.min("fp").alias("fp")), rows)
    keys = distinct.select("s", "n", F.posexplode("bands").alias("band", "key"))
    shared = keys.groupBy("band", "key").agg(F.count("*").alias("m")).where("m > 1").select("band", "key")
    met = cut_lineage(keys.join(shared, ["band", "key"]), BANDS * rows)
    proposed = cut_lineage(_marked_alike(distinct, rows), rows)
    wanted = met.select("s").unionByName(proposed.select(F.explode(F.array("a", "b")).alias("s"))).distinct()
    texts = distinct.join(wanted, "s").select("s", F.col("first").alias("k"))
    sets = cut_lineage(_sets(documents.join(texts, "k").select("s", "text").dropDuplicates(["s"]), width))

    def classed(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
        components = cut_lineage(connected_components(edges, "a", "b", rows=rows), rows)
        return components, cut_lineage(met.join(components, met["s"] == components["node"], "left").select("band", "key", "s", "n", F.coalesce("component", "s").alias("c")), BANDS * rows)

    edges = cut_lineage(_alike(proposed, sets), rows)
    components, named = classed(edges)
    for turn in range(STARS + 1):
        apart = named.groupBy("band", "key").agg(F.min("c").alias("low"), F.max("c").alias("high"), F.min_by(F.struct("s", "n", "c"), F.xxhash64("s", F.lit(turn))).alias("centre")).where("low <> high")
        if turn < STARS:
            pairs = named.join(apart.select("band", "key", "centre"), ["band", "key"]).where(F.col("c") != F.col("centre.c")).where(_near_enough("n", "centre.n"))
            pairs = pairs.select(F.col("s").alias("a"), F.col("centre.s").alias("b"))
        else:
            held = named.join(apart.select("band", "key"), ["band", "key"])
            left, right = held.select("band", "key", F.col("s").alias("a"), F.col("n").alias("na"), F.col("c").alias("ca")), held.select("band", "key", F.col("s").alias("b"), F.col("n").alias("nb"), F.col("c").alias("cb"))
            pairs = left.join(right, ["band", "key"]).where("a < b and ca <> cb").where(_near_enough("na", "nb")).select("a", "b")
        edges = edges.unionByName(cut_lineage(_alike(pairs.distinct(), sets), rows))
        components, named = classed(edges)
    classes = distinct.join(components, distinct["s"] == components["node"], "left").select("s", "first", F.coalesce("component", "s").alias("c"))
    smallest = classes.groupBy("c").agg(F.min("first").alias("least"))
    final = cut_lineage(classes.join(smallest, "c").select("s", "least"), rows)
    return marked.join(final, "s").select("k", F.col("least").alias("c"))


def keep_first(documents: DataFrame, width: int = 3) -> DataFrame:
    """One document of each class of near copies: the one of the smallest id, of equal ids the one whose text's hash is smallest.

    Near copies share JACCARD of their distinct shingles, and so do the copies of copies (`similar_classes`). Null and empty texts are near copies of one another.
    Documents with a null id are compared like the others and come last; one stays where all ids of a
    class are null. Rows that repeat id and text count once. All columns, whatever their names, stay as
    they are; an empty table stays empty.
    """
    text_id, some, chosen, row = (free_name(documents, n) for n in ("text_id", "has_id", "chosen", "row"))
    identity = F.coalesce(text_key(F.col("text")), F.lit(b""))
    keyed = documents.withColumn(text_id, identity)
    found = similar_classes(keyed.select(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.col(text_id).alias("t")).alias("k"), "text"), width)
    kept = cut_lineage(found.where("k = c").select(F.col("k.none").alias(some), F.col("k.doc_id").alias(chosen), F.col("k.t").alias(row)).distinct())
    matched = keyed.join(kept, keyed["doc_id"].eqNullSafe(kept[chosen]) & (keyed[text_id] == kept[row]))
    return matched.dropDuplicates([chosen, text_id]).select(*documents.columns)

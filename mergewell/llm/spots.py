"""SpotSigs document fingerprints."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import arrow_udf

from mergewell.llm.common import BROADCAST_ROWS, text_bytes, text_key
from mergewell.operators.components import connected_components
from mergewell.session import cut_lineage, cut_scan

#: Content words in a chain.
CHAIN = 2
SIMILARITY = 0.8
#: Width, in hex digits, of one signature in a fingerprint.
DIGITS = 8
#: Keys drawn for each range of documents to place its bounds.
SAMPLED = 40
#: Equal rows (id and text) from which they are counted before texts are shuffled, and copies that one task then repeats.
HOT_ROWS, REPEATED = 1000, 10_000
#: Common words that anchor chains.
ANCHORS = frozenset(
    "a an and are as at be by for from has have in is it of on or that the this to was were with "
    "au aux ce dans de des du elle en est et il la le les ne pas pour que qui sur un une "
    "das dem den der die ein eine ist mit nicht sich sie und von zu auf für "
    "al como con del el es esta lo los las no para por se su una y".encode().split()
)


def signatures(text: bytes) -> list[int]:
    """The sorted distinct 32-bit hashes of a text's spots: a common word and the next CHAIN words that are not common.

    Words are runs without ASCII white space, with ASCII letters lower-cased and ASCII punctuation cut
    off their ends. A text without a spot has one signature, the hash of all its words.
    """
    words = [w for w in (x.strip(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~") for x in text.lower().split()) if w]
    anchors = [i for i, w in enumerate(words) if w in ANCHORS]
    content = [i for i, w in enumerate(words) if w not in ANCHORS]
    out, at = set(), 0
    for i in anchors:
        while at < len(content) and content[at] < i:
            at += 1
        chain = content[at : at + CHAIN]
        if len(chain) == CHAIN:
            out.add(xxhash.xxh32_intdigest(b" ".join([words[i], *(words[j] for j in chain)])))
    if not out:
        out.add(xxhash.xxh32_intdigest(b"\0" + b" ".join(words)))
    return sorted(out)


def packed(found: list[int]) -> str:
    return "".join(f"{x:08x}" for x in found)


def likeness(a: list[int], b: list[int], least: float = 0.0) -> float:
    """Jaccard similarity of two signature sets; 0 without comparing them where their sizes rule least out."""
    if min(len(a), len(b)) < least * max(len(a), len(b)):
        return 0.0
    shared = len(set(a) & set(b))
    return shared / (len(a) + len(b) - shared)


def fingerprint(documents: DataFrame, text: str = "text", into: str = "fingerprint") -> DataFrame:
    """All rows and columns, with the fingerprint of the whole text: the hex of its signatures in order. Null counts as empty."""

    @arrow_udf("string")
    def spotted(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            yield pa.array([packed(signatures(t)) for t in text_bytes(part)], pa.string())

    return documents.withColumn(into, spotted(F.col(text)))


def signature_array(fingerprint: Column) -> Column:
    n = F.floor(F.length(fingerprint) / DIGITS).cast("int")
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substring(fingerprint, i * DIGITS + 1, F.lit(DIGITS)))


def similar_documents(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """(doc_id, class_id, component_id) for every document and (a, b, likeness) for the linked classes.

    Documents of one fingerprint form a class, named by its smallest id. Classes are partitioned by set
    length into bands whose borders lie a factor of `least` apart, so similar sets fall into the same or
    the next band. Each set is indexed under its rarest signatures, as many as two similar sets can't
    both lack; matches in the band or the next meet in an equality join, are pruned by length and then
    compared in full. Sets of one signature alone that all share are one class from the start. Null texts
    count as empty; rows that repeat are returned as often; ids that are null name no class of others.
    """
    from math import log

    marked = cut_scan(fingerprint(documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text").drop("text"), documents)
    classes = cut_lineage(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("class_id")).where("class_id is not null").withColumn("sigs", signature_array(F.col("fingerprint"))))
    one = classes.select("class_id", F.explode("sigs").alias("sig"))
    ranked = one.join(one.groupBy("sig").agg(F.count("*").alias("df")), "sig")
    sorted_sets = cut_lineage(ranked.groupBy("class_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("df", "sig"))), lambda x: x["sig"]).alias("sigs")).withColumn("n", F.size("sigs")))
    prefix = F.slice("sigs", 1, (F.col("n") - F.ceil(F.col("n") * least) + 1).cast("int"))
    band = F.floor(F.log("n") / -log(least) + 1e-9).cast("int")
    index = sorted_sets.select("class_id", "n", band.alias("band"), F.explode(prefix).alias("sig"))
    left = index.select(F.col("class_id").alias("a"), F.col("n").alias("na"), F.explode(F.array(F.col("band"), F.col("band") + 1)).alias("band"), "sig")
    right = index.select(F.col("class_id").alias("b"), F.col("n").alias("nb"), "band", "sig")
    met = left.join(right, ["band", "sig"]).where((F.col("na") <= F.col("nb")) & (F.col("na") >= F.col("nb") * least) & ((F.col("na") < F.col("nb")) | (F.col("a") < F.col("b")))).select("a", "b").distinct()
    full = met.join(sorted_sets.select(F.col("class_id").alias("a"), F.col("sigs").alias("sa")), "a").join(sorted_sets.select(F.col("class_id").alias("b"), F.col("sigs").alias("sb")), "b")
    shared = F.size(F.array_intersect("sa", "sb"))
    linked = cut_lineage(full.withColumn("likeness", shared / (F.size("sa") + F.size("sb") - shared)).where(F.col("likeness") >= least).select("a", "b", "likeness"))
    components = connected_components(linked, "a", "b")
    named = classes.select("fingerprint", "class_id").join(components, F.col("class_id") == F.col("node"), "left").select("fingerprint", "class_id", F.coalesce("component", "class_id").alias("component_id"))
    return marked.join(cut_lineage(named), "fingerprint", "left").select("doc_id", "class_id", "component_id"), linked


def _key(doc_id, text_id: bytes) -> tuple:
    """The place of a row among all others, as a value that falls from the first to the last: descending ids, null last, equal ids by the text's identity."""
    return (doc_id is not None, doc_id if doc_id is not None else 0, text_id)


def _ranges(rows: DataFrame, narrow: DataFrame, ranges: int) -> tuple[DataFrame, int]:
    """rows with (r, guest), their range in descending order of (doc_id, tk), numbered from 0, and how many ranges there are; narrow holds (doc_id, tk) of all rows.

    Bounds come from a sample of about SAMPLED keys a range, drawn by hash; they decide only how evenly
    tasks are filled. The first row of each range also appears as a guest of the range before, that of
    the first range in the last. Bounds and first rows, a key a range, travel with the tasks; the plan
    does not grow with their number.
    """
    share = min(1.0, SAMPLED * ranges / max(narrow.count(), 1))
    drawn = narrow.where(F.pmod(F.xxhash64("doc_id", "tk"), F.lit(1 << 30)) < int(share * (1 << 30))).distinct().collect()
    sample = sorted(_key(r["doc_id"], bytes(r["tk"])) for r in drawn)
    bounds = sorted({sample[len(sample) * i // ranges] for i in range(1, ranges)}) if sample else []

    def located(ids: pa.Array, keys: pa.Array) -> list[tuple[int, tuple]]:
        made = [_key(i, t) for i, t in zip(ids.to_pylist(), keys.to_pylist())]
        return [(len(bounds) - bisect_right(bounds, k), k) for k in made]

    @arrow_udf("int")
    def numbered(ids: pa.Array, keys: pa.Array) -> pa.Array:
        return pa.array([r for r, _ in located(ids, keys)], pa.int32())

    placed = narrow.select("doc_id", "tk", numbered("doc_id", "tk").alias("r"))
    tops = placed.groupBy("r").agg(F.max(F.struct(F.col("doc_id").isNotNull(), "doc_id", "tk")).alias("top")).collect()
    first = {r["r"]: _key(r["top"]["doc_id"], bytes(r["top"]["tk"])) for r in tops}
    filled = sorted(first)
    before = {r: filled[i - 1] for i, r in enumerate(filled)}

    @arrow_udf("array<struct<r:int,guest:int>>")
    def dealt(ids: pa.Array, keys: pa.Array) -> pa.Array:
        out = []
        for r, k in located(ids, keys):
            mine = {"r": r, "guest": 0}
            out.append([mine, {"r": before[r], "guest": 1}] if first[r] == k else [mine])
        return pa.array(out, pa.list_(pa.struct([("r", pa.int32()), ("guest", pa.int32())])))

    return rows.withColumn("x", F.explode(dealt("doc_id", "tk"))).select(*rows.columns, "x.r", "x.guest"), len(bounds) + 1


MADE = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compared(doc_id, own: str, mine: list[int], after: str, theirs: list[int]) -> tuple:
    third = len(own) // 3
    edited = (own[: len(own) - third] + after[:third]).encode()
    changed = signatures(edited)
    return doc_id, len(own), sha256(edited).hexdigest(), packed(mine), packed(changed), likeness(mine, changed), likeness(mine, theirs)


def _written(results: Iterator[tuple], id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Batches of at most 2000 results or about 8 MB."""
    schema = pa.schema([("doc_id", id_type), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
    out: list[tuple] = []
    size = 0
    for result in results:
        out.append(result)
        size += len(result[3]) + len(result[4])
        if len(out) >= 2000 or size > 8 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
            out, size = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


def _with_next(sorted_rows: DataFrame) -> DataFrame:
    """Each row of (doc_id, text, r, guest) but the guests, compared with the row after it in its range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = iter(batches)
        head = next(batches, None)
        if head is None:
            return

        def results() -> Iterator[tuple]:
            held, where = None, None
            for batch in _chained(head, batches):
                for doc_id, text, r, guest in zip(*(batch.column(i) for i in range(4))):
                    doc_id, text, r, guest = doc_id.as_py(), text.as_py(), r.as_py(), guest.as_py()
                    if r != where:
                        held, where = None, r
                    elif held is None and guest:
                        continue  # only the first of several equal guests counts
                    found = signatures(text.encode())
                    if held is not None:
                        yield _compared(*held, text, found)
                    held = None if guest else (doc_id, text, found)

        yield from _written(results(), head.schema.field(0).type)

    return sorted_rows.mapInArrow(run, f"doc_id {sorted_rows.schema['doc_id'].dataType.simpleString()}, {MADE}")


def _chained(head: pa.RecordBatch, rest: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield head
    yield from rest


def _with_equals(single: DataFrame) -> DataFrame:
    """The rows of (doc_id, text, copies) as often as copies less one, compared with themselves: the last of equal rows has another next."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(i, t, signatures(t.encode())) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            made = pa.Table.from_batches(_written((_compared(i, t, f, t, f) for i, t, f in texts), batch.schema.field(0).type))
            yield from made.append_column("copies", batch.column(2)).to_batches()

    found = single.mapInArrow(run, f"doc_id {single.schema['doc_id'].dataType.simpleString()}, {MADE}, copies long")
    wanted = F.col("copies") - 1
    parts = found.withColumn("part", F.explode(F.sequence(F.lit(0), F.floor((wanted - 1) / REPEATED))))
    dealt = parts.repartition(parts.sparkSession.sparkContext.defaultParallelism)
    again = F.sequence(F.lit(1).cast("long"), F.least(F.lit(REPEATED).cast("long"), wanted - F.col("part") * REPEATED))
    return dealt.withColumn("again", F.explode(again)).drop("copies", "part", "again")


def edited_fingerprints(documents: DataFrame, ranges: int | None = None) -> DataFrame:
    """For every document its fingerprint, that of its edited text, and how alike they and the next document's are.

    The edited text has its last third replaced by the first as many characters (or all) of the next
    document, descending doc_id (null last; equal ids by the text's hash), after the last the first; a
    single document is its own next. Null texts are empty. Ids are whole numbers or strings. Texts are
    shuffled once, each range of the order to a task of its own; the first row of each range is also sent
    to the range before it, so the next text is at hand while a task holds two texts at a time. Rows that
    repeat id and text more than HOT_ROWS times are counted before that: one of them is dealt, the others,
    whose next is their equal, are compared once and repeated afterwards by many tasks.
    """
    ranges = ranges or max(8, int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("tk", text_key(F.col("text")))
    narrow = cut_lineage(rows.select("doc_id", "tk"))
    often = cut_lineage(narrow.groupBy("doc_id", "tk").agg(F.count("*").alias("copies")).where(F.col("copies") > HOT_ROWS))
    hot, single = often.count(), None
    if hot:
        listed = often.select(F.col("doc_id").alias("hot_id"), F.col("tk").alias("hot_tk"), "copies")
        listed = F.broadcast(listed) if hot <= BROADCAST_ROWS else listed
        same = rows["doc_id"].eqNullSafe(F.col("hot_id")) & (rows["tk"] == F.col("hot_tk"))
        single = cut_lineage(rows.join(listed, same).groupBy("doc_id", "tk", "copies").agg(F.min("text").alias("text")))
        rows = rows.join(listed, same, "left_anti").unionByName(single.select("doc_id", "text", "tk"))
        narrow = narrow.join(often, narrow["doc_id"].eqNullSafe(often["doc_id"]) & (narrow["tk"] == often["tk"]), "left_anti").unionByName(single.select("doc_id", "tk"))
    dealt, count = _ranges(rows, narrow, ranges)
    placed = dealt.repartitionById(count, F.col("r")).sortWithinPartitions("r", "guest", F.col("doc_id").desc_nulls_last(), F.desc("tk"))
    out = _with_next(placed.select("doc_id", "text", "r", "guest"))
    return out if single is None else out.unionByName(_with_equals(single.select("doc_id", "text", "copies")))

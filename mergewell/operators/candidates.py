"""Candidate edges between persons: blocks, pairs, scores, and their merge with earlier edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mergewell.functions import scores
from mergewell.functions.location import city_and_state
from mergewell.functions.text import normalize_for_match
from mergewell.session import cut_lineage


def blocks(persons: DataFrame, keys: str = "block_keys", key: str = "id") -> DataFrame:
    """(block_key, id): each distinct non-empty key of each record that has an id."""
    named = persons.where(F.trim(F.col(key)) != "")
    return named.select(F.explode(F.array_distinct(F.filter(keys, lambda k: k != ""))).alias("block_key"), F.col(key).alias("id")).distinct()


def block_stats(members: DataFrame) -> DataFrame:
    """(block_key, members, pairs): what a block costs, for skew reports."""
    sized = members.groupBy("block_key").agg(F.count("*").alias("members"))
    return sized.withColumn("pairs", F.expr("members * (members - 1) div 2"))


def partners(new_members: DataFrame, history: DataFrame, keys: str = "block_keys", key: str = "id") -> DataFrame:
    """Records of history that share a block key with new ones, by a semi join on exploded keys."""
    wanted = new_members.select("block_key").distinct()
    ids = blocks(history, keys, key).join(wanted, "block_key", "left_semi").select("id").distinct()
    return history.join(ids.withColumnRenamed("id", key), key, "left_semi")


#: The columns from which `comparable` makes what pairs compare.
COMPARED = ("full_name", "cedula_hmac", "identity_kind", "cedula_partial", "cedula_partial_pattern", "last_known_location", "age_range", "status")


def comparable(persons: DataFrame, *kept: str) -> DataFrame:
    """What pairs compare, computed once a record, or a group of equal ones, and not once a pair; kept columns stay."""
    place = city_and_state(F.col("last_known_location"))
    return persons.select(
        *kept, normalize_for_match(F.col("full_name")).alias("name"), F.coalesce("cedula_hmac", F.lit("")).alias("hmac"),
        F.struct(F.col("identity_kind").alias("kind"), F.col("cedula_partial").alias("digits"), F.col("cedula_partial_pattern").alias("pattern")).alias("partial"),
        place.alias("place"), F.col("age_range").alias("ages"), "status",
    )


def _fields(prefix: str) -> dict[str, Column]:
    return {c: F.col(f"{prefix}.{c}") for c in ("name", "hmac", "partial", "place", "ages", "status")}


#: Members of a group of equal records from which it is divided, and records of a block from which its pairs are dealt to several tasks, one for each so many.
HOT_BLOCK = 1000
#: How far rounded scores may lie from the sums that the bounds below are made of.
MARGIN = 1e-4


def _bound(a: Column, b: Column) -> Column:
    """The most that Jaro-Winkler can give two names: n characters of which one at least is missing or moved give a Jaro value of 1 - 1 / 3n, and Winkler leaves 0.6 of what lacks."""
    n = F.greatest(F.length(a), F.length(b))
    return F.when(a == b, F.when(n > 0, 1.0).otherwise(0.0)).otherwise(1 - 0.2 / n)


def _routes(threshold: float) -> dict[str, float] | None:
    """What a pair may lack in all: of one full identifier, and of equal partial ones. None where a pair without either can reach the threshold."""
    w = scores.WEIGHTS
    most = sum(w.values()) - w["cedula"] - threshold + MARGIN
    if most >= 0:
        return None
    return {k: v for k, v in {"full": most + w["cedula"], "partial": most + w["cedula"] * scores.PARTIAL_MATCH}.items() if v >= 0}


def _identified(route: str, hmac: Column, kind: Column, digits: Column, pattern: Column) -> Column:
    """Whether a record has an identifier by which it can meet another on that route."""
    return hmac.isNotNull() & (hmac != "") if route == "full" else (kind == "partial") & pattern.isNotNull() & digits.isNotNull()


def _agreeing(rows: DataFrame, kind: str, spare: float) -> DataFrame:
    """The rows of (block_key, x) that have an identifier of that kind, with `on`, what two of them must have in common if they may lack no more than spare."""
    w, x, p = scores.WEIGHTS, F.col("x"), F.col("x.partial")
    parts, has = [x["hmac"]] if kind == "full" else [p["pattern"], p["digits"]], _identified(kind, x["hmac"], p["kind"], p["digits"], p["pattern"])
    if spare < w["location"]:
        parts, has = [*parts, x["place"]["state"]], has & (x["place"]["state"] != "")
    if spare < w["location"] * 0.5:
        parts, has = [*parts, x["place"]["city"]], has & (x["place"]["city"] != "")
    if spare < w["status"]:
        parts.append(F.coalesce(F.concat(F.lit("="), x["status"]), F.lit("")))
    return rows.where(has).withColumn("on", F.array(*parts))


def _met(rows: DataFrame, chosen: Column | None) -> DataFrame:
    """(block_key, a, b) for the pairs of groups of equal block_key and on, each with itself too, where an id of a can be smaller than one of b; with chosen, those of which one at least is chosen.

    Where groups hold more than HOT_BLOCK records in all they are dealt to as many tasks as that makes:
    each left group goes to one of them, each right one to all.
    """
    keys = ["block_key", "on"]
    rows = rows.withColumn("taken", F.lit(True) if chosen is None else F.coalesce(chosen, F.lit(False)))
    hot = rows.groupBy(*keys).agg(F.least(F.ceil(F.sum(F.size("x.ids")) / HOT_BLOCK), F.count("*")).cast("int").alias("tasks")).where("tasks > 1")
    dealt = rows.join(F.broadcast(hot), keys, "left").withColumn("tasks", F.coalesce("tasks", F.lit(1)))  # a row for HOT_BLOCK records
    left = dealt.where("taken").withColumn("part", F.pmod(F.xxhash64("x.low"), F.col("tasks")).cast("int")).select(*keys, "part", F.col("x").alias("a"))
    right = dealt.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1))).select(*keys, "part", F.col("x").alias("b"), F.col("taken").alias("also"))
    met = left.join(right, [*keys, "part"])
    if chosen is not None:  # two chosen ones have met both ways round, others have not
        way, back = F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))
        met = met.select("block_key", F.explode(F.when(F.col("also"), F.array(way)).otherwise(F.array(way, back))).alias("two")).select("block_key", "two.a", "two.b")
    return met.where(F.col("a.low") < F.col("b.high")).select("block_key", "a", "b")


def _groups(persons: DataFrame, new_ids: DataFrame | None, routes: dict[str, float] | None) -> DataFrame:
    """(block_key, x): the records of a block that are equal in all that is compared, and new or not, as one group; x is what is compared, their ids with the least and largest, and fresh.

    Groups of more than HOT_BLOCK records are divided. Records without an identifier for any route are
    left out. All routes, and whoever uses their edges twice, read this table, so it is made once.
    """
    keyed = persons.where(F.trim("id") != "").select("id", F.explode(F.array_distinct(F.filter("block_keys", lambda k: k != ""))).alias("block_key")).distinct()
    facts = persons.select("id", *COMPARED)
    if routes is not None:
        usable = F.lit(False)
        for route in routes:
            usable = usable | F.coalesce(_identified(route, *map(F.col, COMPARED[1:5])), F.lit(False))
        facts = facts.where(usable)
    fresh = F.lit(True)
    if new_ids is not None:
        facts = facts.join(new_ids.select("id", F.lit(True).alias("new")).distinct(), "id", "left")
        fresh = F.coalesce("new", F.lit(False))
    equal = ["block_key", *COMPARED, "fresh"]
    rows = keyed.join(facts.withColumn("fresh", fresh), "id").select("id", *equal).withColumn("hash", F.xxhash64(*equal))
    large = rows.groupBy("hash").agg(F.ceil(F.count("*") / HOT_BLOCK).cast("int").alias("parts")).where("parts > 1")
    parted = rows.join(F.broadcast(large), "hash", "left").withColumn("part", F.coalesce(F.pmod(F.xxhash64("id"), F.col("parts")), F.lit(0)))  # a row for HOT_BLOCK records
    groups = comparable(parted.groupBy(*equal, "part").agg(F.collect_list("id").alias("ids")), "block_key", "ids", "fresh")
    x = F.struct("name", "hmac", "partial", "place", "ages", "status", "ids", F.array_min("ids").alias("low"), F.array_max("ids").alias("high"), "fresh")
    return cut_lineage(groups.select("block_key", x.alias("x")))


def _group_pairs(persons: DataFrame, new_ids: DataFrame | None, threshold: float) -> DataFrame:
    """(block_key, a, b): what is compared of the two groups of equal records of each pair of a block that can reach the threshold, and their ids.

    The compared fields travel with the block keys, so pairs are made once, in one join, and never
    shuffled. Where no pair can reach the threshold without an equal identifier, that identifier, and
    whatever else the weights then leave no choice about, joins the key (`_routes`): a block of a common
    name or number makes no pairs that are bound to fail. Names join it too where names that differ
    cannot reach the threshold; the few so long that they could are joined apart. With new_ids, pairs
    of two old records never arise.
    """
    routes = _routes(threshold)
    rows = _groups(persons, new_ids, routes)
    fresh = None if new_ids is None else F.col("x.fresh")
    if routes is None:
        return _met(rows.withColumn("on", F.array(F.lit(""))), fresh)
    found = None
    for kind, spare in routes.items():
        agreeing = _agreeing(rows, kind, spare)
        least = scores.WEIGHTS["name"] * 0.2 / spare if spare else float("inf")  # characters from which names that differ can do
        if least > LONG_NAME:
            named = agreeing.withColumn("on", F.concat("on", F.array("x.name")))
            long = _met(agreeing, F.length("x.name") >= F.lit(least)).where(F.col("a.name") != F.col("b.name"))
            met = _met(named, fresh).unionByName(long if fresh is None else long.where(F.col("a.fresh") | F.col("b.fresh")))
        else:
            met = _met(agreeing, fresh)
        if kind == "partial":  # pairs of equal full identifiers have come by their own route
            met = met.where((F.col("a.hmac") == "") | (F.col("a.hmac") != F.col("b.hmac")))
        found = met if found is None else found.unionByName(met)
    return _met(rows.where("false").withColumn("on", F.array(F.lit(""))), fresh) if found is None else found


def _members(pairs: DataFrame) -> DataFrame:
    """Pairs of groups with left_ids and right_ids as pairs of their records, left_id and right_id, smaller id first. Dealt out first: few rows become many."""
    each = pairs.repartition(int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))).withColumn("left_id", F.explode("left_ids")).drop("left_ids").withColumn("right_id", F.explode("right_ids")).drop("right_ids")
    return each.where(F.col("left_id") < F.col("right_id"))


def _pairs(persons: DataFrame, new_ids: DataFrame | None, threshold: float) -> DataFrame:
    """(block_key, left_id, right_id): the pairs of records that stand behind those of `_group_pairs`."""
    return _members(_group_pairs(persons, new_ids, threshold).select("block_key", F.col("a.ids").alias("left_ids"), F.col("b.ids").alias("right_ids")))


#: Names of more characters than this are few: where only they could differ, equal names join the key.
LONG_NAME = 200


def find_candidates(persons: DataFrame, threshold: float = scores.THRESHOLD, new_ids: DataFrame | None = None, exact: bool = False) -> DataFrame:
    """(left_id, right_id, blocking_key, score, reasons, priority) for pairs of a block that reach the threshold; with exact also `exact`, the score before it is rounded to four places.

    Pairs come from an equality join on the block key, smaller id left. Two different full identifiers
    veto a pair. Whatever a pair can score beyond its name, and the most that two names of their lengths
    can, is known before the names are compared, so pairs that cannot reach the threshold never reach
    the string function; this loses none. Records of a block that are equal in all that is compared are
    scored as one, and their pairs written out last. With new_ids, pairs of two old records are left out.
    """
    sided = _group_pairs(persons, new_ids, threshold)
    a, b = _fields("a"), _fields("b")
    w = scores.WEIGHTS
    veto = (a["hmac"] != "") & (b["hmac"] != "") & (a["hmac"] != b["hmac"])
    parts = {
        "cedula": w["cedula"] * scores.cedula_score(a["hmac"], b["hmac"], a["partial"], b["partial"]),
        "location": w["location"] * scores.location_score(a["place"], b["place"]),
        "age": w["age"] * scores.age_score(a["ages"], b["ages"]),
        "status": w["status"] * F.when(a["status"].eqNullSafe(b["status"]), 1.0).otherwise(0.0),
    }
    known = sided.where(~veto).select(F.col("a.ids").alias("left_ids"), F.col("b.ids").alias("right_ids"), F.col("block_key").alias("blocking_key"), a["name"].alias("na"), b["name"].alias("nb"), *[v.alias(k) for k, v in parts.items()])
    rest = F.col("cedula") + F.col("location") + F.col("age") + F.col("status")
    possible = known.where(rest + w["name"] * _bound(F.col("na"), F.col("nb")) + MARGIN >= threshold)
    named = possible.withColumn("name", w["name"] * scores.jaro_winkler_udf("na", "nb")).withColumn("exact", F.col("name") + F.col("cedula") + F.col("location") + F.col("status") + F.col("age")).withColumn("score", F.round("exact", 4))
    reasons = F.map_from_arrays(F.array(*[F.lit(k) for k in w]), F.array(*[F.round(F.col(k), 4) for k in w]))
    scored = named.where((F.col("score") >= threshold) & (F.col("score") > 0)).select("left_ids", "right_ids", "blocking_key", "score", reasons.alias("reasons"), scores.priority(F.col("score")).alias("priority"), *(["exact"] if exact else []))
    return _members(scored).select("left_id", "right_id", "blocking_key", "score", "reasons", "priority", *(["exact"] if exact else []))


def merge_candidates(existing: DataFrame, found: DataFrame) -> DataFrame:
    """Existing edges with refreshed scores, reasons and priorities, and new ones as pending; decisions are never touched. Pairs match in either order, with their key.

    Both are dealt and sorted once, together: the existing edges of a key come first and take over what a
    found one says; one found edge stays itself where none exists. A hash, made once the rows are dealt, is
    the first sort key, so the others are seldom compared. Existing edges that lack a pair or a key match none.
    """
    values, ends = ["score", "reasons", "priority"], [F.least("left_id", "right_id").alias("low_id"), F.greatest("left_id", "right_id").alias("high_id")]
    none = lambda c: F.lit(None).cast(existing.schema[c].dataType).alias(c)
    stored = existing.select(*ends, "blocking_key", "left_id", "right_id", "decision", *values, F.lit(True).alias("stored"))
    new = found.select(*ends, "blocking_key", none("left_id"), none("right_id"), none("decision"), *values, F.lit(False).alias("stored"))
    lacking = F.col("stored") & (F.col("low_id").isNull() | F.col("blocking_key").isNull())
    keys = ["low_id", "high_id", "blocking_key", "lacking"]
    rows = stored.unionByName(new).withColumn("lacking", lacking).repartition(*keys).withColumn("hash", F.xxhash64(*keys))
    each = Window.partitionBy("hash", *keys).orderBy(F.col("stored").desc())
    whole = each.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    seen = rows.select("*", F.row_number().over(each).alias("n"), F.last(F.when(~F.col("stored"), F.struct(*values))).over(whole).alias("now"))
    return seen.where(F.col("stored") | (F.col("n") == 1)).select(
        F.coalesce("left_id", "low_id").alias("left_id"), F.coalesce("right_id", "high_id").alias("right_id"), "blocking_key",
        *[F.coalesce(F.col("now")[c], F.col(c)).alias(c) for c in values], F.coalesce("decision", F.lit("pending")).alias("decision"),
    )


#: What an edge must have to be stored, and the priority of one that says none.
EDGE_REQUIRED, DEFAULT_PRIORITY = ("left_id", "right_id", "blocking_key", "score"), 2


def edge_rows(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges as they are stored, pending and not touching gold, and those that lack a required value (null, empty or zero) or join a record with itself."""
    lacking = F.lit(False)
    for c in EDGE_REQUIRED:
        text = F.col(c).cast("string")
        lacking = lacking | F.col(c).isNull() | (F.trim(text) == "") | (F.col(c).try_cast("double").eqNullSafe(0.0) if c == "score" else F.lit(False))
    lacking = lacking | F.col("left_id").eqNullSafe(F.col("right_id"))
    stored = found.where(~lacking).withColumns({"priority": F.coalesce("priority", F.lit(DEFAULT_PRIORITY)), "decision": F.lit("pending"), "touches_gold": F.lit(False)})
    return stored, found.where(lacking)


def mark_gold(edges: DataFrame, members: DataFrame) -> DataFrame:
    """edges with touches_gold set where either record is in a gold cluster."""
    ids = members.select(F.col("id").alias("gold_member")).distinct()
    ends = edges.select("left_id", "right_id", F.explode(F.array("left_id", "right_id")).alias("gold_member")).join(ids, "gold_member", "left_semi").select("left_id", "right_id").distinct().withColumn("gold", F.lit(True))
    return edges.drop("touches_gold").join(ends, ["left_id", "right_id"], "left").withColumn("touches_gold", F.coalesce("gold", F.lit(False))).drop("gold")

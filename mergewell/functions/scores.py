"""Similarity, confidence and trust scores."""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.functions import arrow_udf

#: Weights of the person similarity, and what a match of partial identifiers counts.
WEIGHTS = {"name": 0.40, "cedula": 0.30, "location": 0.15, "age": 0.10, "status": 0.05}
PARTIAL_MATCH = 0.5
THRESHOLD = 0.85
#: The two rankings of trust tiers, the bonus of the confidence score and the score by tier alone.
TIER_RANK = {"A": 1, "B": 2, "C": 3, "D": 4}
TIER_BONUS = {"A": 0.20, "B": 0.15, "C": 0.10, "D": 0.05}
TIER_CONFIDENCE = {"A": 0.90, "B": 0.75, "C": 0.60, "D": 0.35, "E": 0.15}
#: What each filled field adds to the confidence of an entity.
FIELD_SCORES = {
    "Person": {"full_name": 0.25, "cedula_hmac": 0.25, "last_known_location": 0.20, "status": 0.10},
    "AcopioCenter": {"name": 0.25, "location_text": 0.25, "coordinates": 0.20, "needs": 0.10},
    "Event": {"event_type": 0.20, "description": 0.25, "location_text": 0.20, "date_iso": 0.15},
}


@lru_cache(1 << 14)
def jaro_winkler(a: str, b: str) -> float:
    """Winkler's similarity: prefixes of up to four characters lift Jaro values above 0.7."""
    if a == b:
        return 1.0 if a else 0.0
    if not a or not b:
        return 0.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    taken = [False] * len(b)
    left = []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == c:
                taken[j] = True
                left.append(c)
                break
    if not left:
        return 0.0
    right = [c for c, t in zip(b, taken) if t]
    m = len(left)
    moved = sum(x != y for x, y in zip(left, right)) // 2
    jaro = (m / len(a) + m / len(b) + (m - moved) / m) / 3
    if jaro <= 0.7:
        return jaro
    prefix = next((k for k, (x, y) in enumerate(zip(a[:4], b[:4])) if x != y), min(4, len(a), len(b)))
    return jaro + prefix * 0.1 * (1 - jaro)


@arrow_udf(T.DoubleType())
def jaro_winkler_udf(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array([jaro_winkler(x or "", y or "") for x, y in zip(a.to_pylist(), b.to_pylist())], pa.float64())


def location_score(a: Column, b: Column) -> Column:
    """1 for the same city and state, one half for the same state, 0 otherwise or where a side has no state; sides are (city, state)."""
    known = (a["state"] != "") & (b["state"] != "")
    return F.when(known & (a["state"] == b["state"]), F.when((a["city"] != "") & (a["city"] == b["city"]), 1.0).otherwise(0.5)).otherwise(0.0)


def cedula_score(hmac_a: Column, hmac_b: Column, partial_a: Column, partial_b: Column) -> Column:
    """partial is (identity_kind, digits, pattern)."""
    full = (hmac_a != "") & (hmac_a == hmac_b)
    part = (partial_a["kind"] == "partial") & (partial_b["kind"] == "partial") & (partial_a["digits"] == partial_b["digits"]) & (partial_a["pattern"] == partial_b["pattern"])
    return F.when(full, 1.0).when(part, PARTIAL_MATCH).otherwise(0.0)


def age_score(a: Column, b: Column) -> Column:
    """Overlap over union of the ranges (min, max); equal single ages have no union and score 0."""
    overlap = F.least(a["max"], b["max"]) - F.greatest(a["min"], b["min"])
    union = F.greatest(a["max"], b["max"]) - F.least(a["min"], b["min"])
    return F.when((union > 0) & (overlap > 0), overlap / F.nullif(union, F.lit(0))).otherwise(0.0)


def priority(score: Column) -> Column:
    return F.when(score >= 0.95, 2).otherwise(1)


def _lookup(values: dict, key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for k, v in values.items() for x in (k, v)]), key)


def tier_rank(tier: Column) -> Column:
    """1 for A to 4 for D, 5 for others: the smallest wins."""
    return F.coalesce(_lookup(TIER_RANK, F.upper(F.trim(tier))), F.lit(5))


def trust_rank(tier: Column) -> Column:
    """4 for A to 1 for D and others: the largest wins."""
    return F.coalesce(5 - _lookup(TIER_RANK, F.upper(tier)), F.lit(1))


def confidence_from_tier(tier: Column) -> Column:
    return F.coalesce(_lookup(TIER_CONFIDENCE, F.upper(tier)), F.lit(0.10))


def confidence_score(entity: str, fields: dict[str, Column], tier: Column) -> Column:
    """Completeness plus the tier's bonus, at most 1, to three places; blank strings and empty arrays count as missing."""
    total = F.coalesce(_lookup(TIER_BONUS, F.upper(tier)), F.lit(TIER_BONUS["D"]))
    for name, value in FIELD_SCORES[entity].items():
        column = fields.get(name)
        if column is not None:
            text = F.trim(column.cast("string"))
            total = total + F.when(column.isNotNull() & ~text.isin("", "[]", "{}"), value).otherwise(0.0)
    return F.round(F.least(total, F.lit(1.0)), 3)


def age_range(age: Column) -> Column:
    years = age.try_cast("int")
    return F.when(years.between(0, 130), F.struct(years.alias("min"), years.alias("max")))


def is_minor(ages: Column) -> Column:
    """The model's rule: true below 18 at most, false from 18 at least, else unknown."""
    return F.when(ages["max"] < 18, True).when(ages["min"] >= 18, False)


def derived_is_minor(explicit: Column, ages: Column) -> Column:
    """The normaliser's rule: an explicit value, else the lower age below 18."""
    return F.coalesce(explicit, ages["min"] < 18)

"""Content fingerprints, block keys and record identity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mergewell.functions.dates import truncate_to_hour
from mergewell.functions.text import normalize_for_match, phonetic_hash

#: Version of the deduplication rules of each type, and whether exact matches merge without review.
SPECS = {"Event": (1, True), "AcopioCenter": (1, True), "Person": (1, False)}


def spec_for(entity_type: str) -> tuple[int, bool]:
    return SPECS[entity_type]


def _joined(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", *[F.coalesce(p, F.lit("")) for p in parts]), 256)


def event_fingerprint(event_type: Column, location: Column, date_iso: Column) -> Column:
    return _joined(normalize_for_match(event_type), normalize_for_match(location), truncate_to_hour(date_iso))


def center_fingerprint(event_id: Column, name: Column, location: Column) -> Column:
    return _joined(normalize_for_match(event_id), normalize_for_match(name), normalize_for_match(location))


def claim_fingerprint(event_id: Column, claim_type: Column, location: Column, description: Column) -> Column:
    return _joined(normalize_for_match(event_id), normalize_for_match(claim_type), normalize_for_match(location), F.substring(normalize_for_match(description), 1, 300))


def dedup_key(entity_type: Column, record: dict[str, Column]) -> Column:
    """The fingerprint of the record's type; persons have their deterministic id, or null."""
    get = lambda k: record.get(k, F.lit(None).cast("string"))
    return (
        F.when(entity_type == "Event", event_fingerprint(get("event_type"), get("location_text"), get("date_iso")))
        .when(entity_type == "AcopioCenter", center_fingerprint(get("event_id"), get("name"), get("location_text")))
        .otherwise(F.nullif(get("deterministic_id"), F.lit("")))
    )


def person_block_keys(event_id: Column, full_name: Column, hmac: Column, kind: Column, partial: Column, pattern: Column, phonetic: Column | None = None) -> Column:
    """The strong key, the partial key and the phonetic key, those that exist, in this order."""
    event = F.coalesce(event_id, F.lit(""))
    sound = phonetic_hash(full_name) if phonetic is None else phonetic
    strong = F.when(F.trim(hmac) != "", F.concat(F.lit("ced:"), event, F.lit(":"), hmac))
    part = F.when((kind == "partial") & (partial != "") & (pattern != ""), F.concat(F.lit("ced_partial:"), event, F.lit(":"), pattern, F.lit(":"), partial))
    return F.array_compact(F.array(strong, part, F.concat(F.lit("phon:"), event, F.lit(":"), sound)))


def center_block_keys(event_id: Column, name: Column, location: Column) -> Column:
    return F.array(F.concat(F.lit("phon:"), F.coalesce(event_id, F.lit("")), F.lit(":"), normalize_for_match(location), F.lit(":"), phonetic_hash(name)))


def external_id(entity_type: Column, source_id: Column, record_id: Column, content_hash: Column) -> Column:
    own = F.coalesce(F.nullif(record_id, F.lit("")), content_hash)
    return F.sha2(F.concat_ws("|", F.lower(entity_type), source_id, own), 256)


def content_hash(df: DataFrame, columns: list[str], into: str = "content_hash") -> DataFrame:
    """Hash of the compact JSON of the columns in order of their names, nulls included."""
    return df.withColumn(into, F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256))

"""Row rules: validation, minors, tokenised identifiers, enrichment, quarantine, staging and projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mergewell.functions import pii, scores, text
from mergewell.functions.location import location_label, normalize_location
from mergewell.operators.keys import external_id

#: Allowed values of the enumerations.
STATUS = ("missing", "deceased", "unknown")
CENTER_STATUS = ("active", "full", "closed", "unverified")
EVENT_TYPES = ("earthquake", "flood", "landslide", "other")
IDENTITY_KINDS = ("hmac", "partial", "none")
PROVENANCE = ("cleartext", "source_masked_lossy", "source_hashed")
PARTIAL_PATTERNS = ("suffix_4", "suffix_3", "suffix_2", "edges_2_2")
TIERS = ("A", "B", "C", "D")
REASON_CODES = ("pii_untreatable", "invalid_schema", "parser_unavailable", "pdf_no_text", "unclassified_sensitive", "contradictory_sources", "ambiguous_manual_review")
RISK_LEVELS = ("low", "medium", "high")
RAW_PII_FIELDS = ("cedula", "documento", "identity_document", "dni", "rut", "telefono", "telefono_contacto", "phone", "email")
STATUS_REMAP = {"found": "missing", "injured": "missing"}
PERSON_FIELDS = ("full_name", "alternate_names", "cedula_hmac", "cedula_masked", "cedula_partial", "cedula_partial_pattern", "identity_kind", "pii_provenance", "name_truncated", "age_range", "sex", "is_minor", "last_known_location", "status", "trust_tier", "dedup_confidence", "confidence_score")
CENTER_FIELDS = ("name", "location_text", "coordinates", "status", "trust_tier", "confidence_score", "managing_org", "contact_public", "current_load")
UUID = r"^(?i)(urn:uuid:)?\{?[0-9a-f]{8}-?[0-9a-f]{4}-?[0-9a-f]{4}-?[0-9a-f]{4}-?[0-9a-f]{12}\}?$"
SLUGS = {"Person": "person", "AcopioCenter": "acopio_center", "Event": "event"}


def _named(rules: dict[str, Column]) -> Column:
    """The names of the rules that a row breaks; unknown (null) counts as kept unless the rule says otherwise."""
    return F.array_compact(F.array(*[F.when(F.coalesce(broken, F.lit(False)), F.lit(name)) for name, broken in rules.items()]))


def _blank(c: str) -> Column:
    return F.col(c).isNull() | (F.trim(F.col(c)) == "")


def _outside(c: str, allowed: tuple[str, ...]) -> Column:
    return F.col(c).isNotNull() & ~F.col(c).isin(*allowed)


def valid_score(c: Column) -> Column:
    """The score within 0 and 1, values a rounding error outside moved to the border; null otherwise."""
    value = c.try_cast("double")
    clamped = F.when(F.abs(value) <= 1e-9, 0.0).when(F.abs(value - 1) <= 1e-9, 1.0).otherwise(value)
    return F.when(clamped.between(0, 1), clamped)


def broken_person_rules() -> Column:
    kind, partial, pattern = F.col("identity_kind"), F.col("cedula_partial"), F.col("cedula_partial_pattern")
    return _named({
        "full_name": _blank("full_name"), "fuente": _blank("fuente"), "event_id": ~F.coalesce(F.col("event_id").rlike(UUID), F.lit(False)),
        "status": _outside("status", STATUS), "identity_kind": _outside("identity_kind", IDENTITY_KINDS), "pii_provenance": _outside("pii_provenance", PROVENANCE),
        "trust_tier": F.col("trust_tier").isNotNull() & ~F.upper("trust_tier").isin(*TIERS), "confidence_score": F.col("confidence_score").isNotNull() & valid_score(F.col("confidence_score")).isNull(),
        "cedula_masked": F.col("cedula_masked").isNotNull() & ((F.trim("cedula_masked") == "") | (F.length("cedula_masked") > 15)),
        "cedula_partial": partial.isNotNull() & ~partial.rlike(r"^\d{2,4}$"), "cedula_partial_pattern": _outside("cedula_partial_pattern", PARTIAL_PATTERNS),
        "age_range": F.col("age_range.min") > F.col("age_range.max"), "hmac_without_value": (kind == "hmac") & F.col("cedula_hmac").isNull(),
        "partial_without_value": (kind == "partial") & (partial.isNull() | pattern.isNull()), "value_without_partial": (partial.isNotNull() | pattern.isNotNull()) & (kind != "partial"),
    })


def broken_center_rules() -> Column:
    lat, lon = F.col("coordinates.lat"), F.col("coordinates.lon")
    return _named({
        "name": _blank("name"), "location_text": _blank("location_text"), "fuente": _blank("fuente"), "event_id": ~F.coalesce(F.col("event_id").rlike(UUID), F.lit(False)),
        "status": _outside("status", CENTER_STATUS), "trust_tier": F.col("trust_tier").isNotNull() & ~F.upper("trust_tier").isin(*TIERS),
        "coordinates": F.col("coordinates").isNotNull() & ~F.coalesce(lat.between(-90, 90) & lon.between(-180, 180), F.lit(False)),
    })


def broken_event_rules() -> Column:
    iso = F.regexp_replace("date_iso", "Z$", "+00:00")
    return _named({"description": _blank("description"), "fuente": _blank("fuente"), "event_type": F.col("event_type").isNull() | ~F.col("event_type").isin(*EVENT_TYPES), "date_iso": F.col("date_iso").isNotNull() & iso.try_cast("timestamp").isNull()})


def split_valid(df: DataFrame, broken: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that keep all rules, and the others with the rules they break: nothing is dropped."""
    judged = df.withColumn("broken_rules", broken)
    return judged.where(F.size("broken_rules") == 0).drop("broken_rules"), judged.where(F.size("broken_rules") > 0)


def protect_minors(df: DataFrame) -> DataFrame:
    """Minors lose photo and masked identifier; "municipality, state" keeps the state, any other place with a comma is removed."""
    minor = F.col("is_minor").eqNullSafe(True)
    place = F.col("last_known_location")
    parts = F.transform(F.split(place, ","), lambda p: F.trim(p))
    reduced = F.when(~F.contains(place, F.lit(",")), place).when((F.size(parts) == 2) & F.forall(parts, lambda p: p != ""), F.get(parts, F.lit(1)))
    status = F.when(F.contains(place, F.lit(",")), "removed_minor").when(place.isNotNull(), "present").otherwise(F.col("last_known_location_status"))
    return df.withColumns({
        "foto_status": F.when(minor & F.col("foto").isNotNull(), "removed_minor").otherwise(F.col("foto_status")), "foto": F.when(~minor, F.col("foto")),
        "cedula_masked": F.when(~minor, F.col("cedula_masked")), "last_known_location_status": F.when(minor, status).otherwise(F.col("last_known_location_status")),
        "last_known_location": F.when(minor, reduced).otherwise(place),
    })


def tokenise_identifiers(df: DataFrame, aliases: dict[str, tuple[str, ...]], secret: str) -> DataFrame:
    """For each name, name_hmac and name_masked from the first non-empty alias column; the originals are dropped."""
    out, drop = df, []
    for name, columns in aliases.items():
        have = [c for c in columns if c in df.columns]
        if have:
            value = F.coalesce(*[F.nullif(F.trim(F.col(c).cast("string")), F.lit("")) for c in have])
            out = out.withColumns({f"{name}_hmac": F.when(value.isNotNull(), text.hmac_token(value, secret)), f"{name}_masked": text.mask_last4(value)})
            drop += have
    return out.drop(*drop)


def strip_raw_pii(df: DataFrame, fields: tuple[str, ...] = RAW_PII_FIELDS) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.lower() in fields])


def gate_unmapped(df: DataFrame, unmapped: str = "unmapped") -> tuple[DataFrame, DataFrame]:
    """Rows whose leftover fields hold no personal data, and the others."""
    found = pii.has_pii(F.to_json(unmapped))
    return df.where(~found), df.where(found)


def enrich(df: DataFrame, name: str = "full_name", location: str = "last_known_location") -> DataFrame:
    """Location as "municipality, state", the state or as it was, and the deterministic id from the phonetic name and the place."""
    place = normalize_location(F.col(location))
    named = df.withColumn("__place", place)
    labelled = named.withColumn(location, F.when(F.col("__place.estado").isNotNull(), location_label(F.col("__place"))).otherwise(F.col(location))).drop("__place")
    return labelled.withColumn("deterministic_id", text.deterministic_id(text.phonetic_hash(text.normalize_person_name(F.col(name))), F.col(location)))


def quarantine_rows(df: DataFrame, body: str, reason: str, risk: str, source: str = "source_slug", secret: str = "") -> DataFrame:
    """(source_slug, reason_code, risk_level, payload_hash, payload_preview_redacted, pii_findings_summary); reason and risk must be known."""
    if reason not in REASON_CODES or risk not in RISK_LEVELS:
        raise ValueError(f"unknown reason or risk: {reason}, {risk}")
    return df.select(
        F.col(source).alias("source_slug"), F.lit(reason).alias("reason_code"), F.lit(risk).alias("risk_level"), F.sha2(F.col(body), 256).alias("payload_hash"),
        text.preview(pii.redact_pii(F.col(body), secret)).alias("payload_preview_redacted"), pii.pii_summary(F.col(body)).alias("pii_findings_summary"),
    )


def staging_rows(df: DataFrame, entity_type: str, source_id: Column, record_id: str, payload: list[str]) -> DataFrame:
    """The staging envelope: external id, content hash and the payload as JSON without fields of a leading underscore."""
    kept = sorted(c for c in payload if not c.startswith("_"))
    body = df.withColumn("raw_json", F.to_json(F.struct(*kept), {"ignoreNullFields": "false"}))
    hashed = body.withColumn("content_hash", F.sha2("raw_json", 256))
    made = external_id(F.lit(entity_type), source_id, F.col(record_id).cast("string"), F.col("content_hash"))
    return hashed.select(F.lit(SLUGS[entity_type]).alias("entity_type"), source_id.alias("source_id"), made.alias("external_id"), "content_hash", "raw_json")


def project(df: DataFrame, fields: tuple[str, ...], schema: str, default_event: str) -> DataFrame:
    """Typed columns from raw_json; the event falls back to the default, statuses no longer in use become missing."""
    parsed = df.withColumn("r", F.from_json("raw_json", schema))
    have = [f for f in fields if f in parsed.select("r.*").columns]
    status = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for k, v in STATUS_REMAP.items() for x in (k, v)]), F.col("r.status")), F.col("r.status"))
    columns = [status.alias("status") if f == "status" else F.col(f"r.{f}") for f in have]
    return parsed.select("id", F.coalesce(F.nullif(F.col("r.event_id"), F.lit("")), F.lit(default_event)).alias("event_id"), *columns)


def allowed_host(url: Column, domains: list[str]) -> Column:
    return F.lit(True) if not domains else F.coalesce(F.lower(F.try_parse_url(url, F.lit("HOST"))).isin(*[d.lower() for d in domains]), F.lit(False))


def purge_raw_text(artifacts: DataFrame, now: Column, hours: int = 12) -> DataFrame:
    """Raw text older than the retention becomes null, its status purged."""
    old = F.col("fetched_at") < now - F.make_dt_interval(hours=F.lit(hours))
    return artifacts.withColumns({"pii_status": F.when(old, "purged").otherwise(F.col("pii_status")), "raw_text": F.when(~old, F.col("raw_text"))})


def score_entity(df: DataFrame, entity_type: str) -> DataFrame:
    fields = {f: F.col(f) for f in scores.FIELD_SCORES[entity_type] if f in df.columns}
    return df.withColumn("confidence_score", scores.confidence_score(entity_type, fields, F.col("trust_tier")))


TYPES = {slug: name for name, slug in SLUGS.items()}
PERSON_RECORD = "struct<event_id:string,full_name:string,alternate_names:array<string>,cedula_hmac:string,cedula_masked:string,cedula_partial:string,cedula_partial_pattern:string,identity_kind:string,pii_provenance:string,name_truncated:boolean,age_range:struct<min:int,max:int>,sex:string,is_minor:boolean,last_known_location:string,status:string,trust_tier:string,dedup_confidence:double,confidence_score:double>"
CENTER_RECORD = "struct<event_id:string,name:string,location_text:string,coordinates:struct<lat:double,lon:double>,status:string,trust_tier:string,confidence_score:double,managing_org:string,contact_public:string,current_load:int>"


def route(staged: DataFrame) -> DataFrame:
    """staged with its route: person, acopio_center, event (kept in the catalogue, not projected), malformed (no id or no JSON object) or unknown."""
    malformed = F.coalesce(F.trim(F.col("id").cast("string")) == "", F.lit(True)) | F.from_json("raw_json", "map<string,string>").isNull() | ~F.coalesce(F.ltrim("raw_json").startswith("{"), F.lit(False))
    known = F.when(F.col("entity_type").isin("person", "acopio_center", "event"), F.col("entity_type")).otherwise("unknown")
    return staged.withColumn("route", F.when(malformed, "malformed").otherwise(known))


def project_types(staged: DataFrame, default_event: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(persons, centers, errors) of staged rows; events are skipped, errors has the id and the reason of every other row."""
    routed = route(staged)
    persons = project(routed.where("route = 'person'"), PERSON_FIELDS, PERSON_RECORD, default_event)
    centers = project(routed.where("route = 'acopio_center'"), CENTER_FIELDS, CENTER_RECORD, default_event)
    return persons, centers, routed.where("route in ('malformed', 'unknown')").select("id", "entity_type", F.col("route").alias("reason"))


def seed_events(staged: DataFrame, catalogue: DataFrame, default_event: str, event_type: str = "earthquake", description: str = "") -> DataFrame:
    """The rows that the event catalogue still lacks: the default event and each one that a record to be projected refers to."""
    named = route(staged).where("route in ('person', 'acopio_center')").select(F.get_json_object("raw_json", "$.event_id").alias("event_id")).where("event_id <> ''")
    wanted = named.unionByName(named.sparkSession.range(1).select(F.lit(default_event).alias("event_id"))).distinct()
    return wanted.join(catalogue.select("event_id"), "event_id", "left_anti").select("event_id", F.lit(event_type).alias("event_type"), F.lit(description).alias("description"))


def job_records(staged: DataFrame) -> DataFrame:
    """Staged rows as consolidation reads them: payload instead of raw_json, the type's name for its slug, a missing tier empty."""
    name = F.try_element_at(F.create_map(*[F.lit(x) for pair in TYPES.items() for x in pair]), F.col("entity_type"))
    return staged.withColumns({"entity_type": F.coalesce(name, F.col("entity_type")), "trust_tier": F.coalesce("trust_tier", F.lit(""))}).withColumnRenamed("raw_json", "payload")


def staging_envelope(df: DataFrame, entity_type: str, source_id: Column, record_id: str, payload: list[str], dedup: Column, block_keys: Column, version: int = 1, artifact: Column | None = None) -> DataFrame:
    """staging_rows with what consolidation needs beside it: dedup_hash, dedup_version, block_keys, normalizer_version and the artifact."""
    carried = {"dedup_hash": dedup, "dedup_version": F.lit(version), "block_keys": block_keys, "normalizer_version": F.lit("1"), "artifact_id": F.lit(None).cast("string") if artifact is None else artifact}
    kept = sorted(c for c in payload if not c.startswith("_"))
    body = df.withColumns({"raw_json": F.to_json(F.struct(*kept), {"ignoreNullFields": "false"}), **carried})
    hashed = body.withColumn("content_hash", F.sha2("raw_json", 256))
    made = external_id(F.lit(entity_type), source_id, F.col(record_id).cast("string"), F.col("content_hash"))
    return hashed.select(F.lit(SLUGS[entity_type]).alias("entity_type"), source_id.alias("source_id"), made.alias("external_id"), "content_hash", "raw_json", *carried)

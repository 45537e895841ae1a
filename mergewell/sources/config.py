"""The catalogue of sources and its rules."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Types of sources, tiers, and the fields that full and thin entries need.
SOURCE_TYPES = ("html_static", "api_json", "rss", "manual_file", "webapp_js", "pdf", "x_recent_search")
TIERS = ("A", "B", "C", "D")
REQUIRED = ("id", "name", "type", "enabled", "trust_tier", "url", "refresh_minutes", "parser_asignado")
THIN = ("id", "enabled", "parser_asignado")
#: Columns that a thin entry's catalogue row must have.
CATALOGUE_REQUIRED = ("url", "source_type", "governed_tier", "refresh_minutes")
UUID = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
WHOLE = ("max_retries", "page_size", "probe_limit", "rate_limit_per_minute", "max_concurrent_pages", "max_concurrent_posts", "bulk_size")


def _is_text(v) -> bool:
    return isinstance(v, str) and bool(v.strip())


def _is_whole(v) -> bool:
    return isinstance(v, int) and not isinstance(v, bool) and v > 0


def _texts(v) -> bool:
    return isinstance(v, list) and all(isinstance(x, str) for x in v)


#: What an optional field must be, where it is given and not null.
OPTIONAL = {
    "required_keywords": (_texts, "a list of texts"),
    "notes": (lambda v: isinstance(v, str), "a text"),
    "timeout_seconds": (lambda v: isinstance(v, (int, float)) and not isinstance(v, bool) and v > 0, "a positive number"),
    "allowed_domains": (lambda v: _texts(v) and bool(v) and all(map(_is_text, v)), "a list of texts that is not empty"),
    "full_scan": (lambda v: isinstance(v, bool), "true or false"),
    "cursor_field": (_is_text, "a text that is not empty"),
} | {name: (_is_whole, "a positive whole number") for name in WHOLE}


def is_thin(entry: dict) -> bool:
    """Whether the catalogue, and not the entry, says where the source is."""
    return "url" not in entry


def validate_entry(entry) -> list[str]:
    """What is wrong with one entry."""
    if not isinstance(entry, dict):
        return ["is no mapping"]
    thin = is_thin(entry)
    missing = [k for k in (THIN if thin else REQUIRED) if k not in entry]
    if missing:
        return [f"{k} is missing" for k in missing]
    errors = [f"{k} must be a text that is not empty" for k in (("id", "parser_asignado") if thin else ("id", "name", "type", "trust_tier", "url", "parser_asignado")) if not _is_text(entry[k])]
    if not isinstance(entry["enabled"], bool):
        errors.append("enabled must be true or false")
    if _is_text(entry["id"]) and not (UUID.fullmatch(entry["id"]) if thin else re.fullmatch(r"[a-zA-Z0-9_-]+", entry["id"])):
        errors.append("id must be a UUID" if thin else "id may hold letters, digits, - and _ alone")
    if not thin:
        errors += ["unknown type"] * (entry["type"] not in SOURCE_TYPES) + ["unknown trust tier"] * (entry["trust_tier"] not in TIERS)
        if not _is_whole(entry["refresh_minutes"]):
            errors.append("refresh_minutes must be a positive integer")
        errors += [f"{k} must be {what}" for k, (holds, what) in OPTIONAL.items() if entry.get(k) is not None and not holds(entry[k])]
    return errors


def validate_sources(sources: list[dict]) -> list[str]:
    """What is wrong with a list of source entries; a thin entry, one without a url, needs its id, parser and flag alone."""
    errors, seen = [], set()
    for i, entry in enumerate(sources):
        errors += [f"sources[{i}]: {e}" for e in validate_entry(entry)]
        own = entry.get("id") if isinstance(entry, dict) else None
        if own is not None and str(own) in seen:
            errors.append(f"sources[{i}]: the id occurs twice")
        seen.add(str(own))
    return errors


def read_config(path: str) -> tuple[dict, list[dict]]:
    """(project, sources) of a YAML file, checked; `parser` is an old name of parser_asignado. Anything wrong is an error that lists it all."""
    import yaml

    with open(path, encoding="utf-8") as file:
        found = yaml.safe_load(file)
    if not isinstance(found, dict) or not isinstance(found.get("sources"), list):
        raise ValueError("the file must hold a mapping with a list `sources`")
    entries = [({"parser_asignado": e["parser"]} if "parser" in e and "parser_asignado" not in e else {}) | e if isinstance(e, dict) else e for e in found["sources"]]
    errors = validate_sources(entries)
    if errors:
        raise ValueError("; ".join(errors))
    return found.get("project") or {}, entries


def load_sources(path: str, catalogue: DataFrame | None = None) -> tuple[dict, list[dict]]:
    """(project, sources): full entries as they are and thin ones with their catalogue row.

    Fails closed: thin entries without a catalogue, without a row or with an empty required column are
    errors. A thin entry is enabled if it says so and its row is active. Only rows of listed ids reach the driver.
    """
    project, entries = read_config(path)
    thin = [e["id"] for e in entries if is_thin(e)]
    rows = {}
    if thin:
        if catalogue is None:
            raise ValueError("thin sources need the catalogue")
        rows = {r["source_id"]: r.asDict() for r in catalogue.where(F.col("source_id").isin(*thin)).collect()}
    return project, [_filled(e, rows) if is_thin(e) else e for e in entries]


def _filled(entry: dict, rows: dict[str, dict]) -> dict:
    row = rows.get(entry["id"])
    if row is None:
        raise ValueError(f"no catalogue row for source {entry['id']}")
    empty = [c for c in CATALOGUE_REQUIRED if row.get(c) in (None, "")]
    if empty:
        raise ValueError(f"source {entry['id']}: {', '.join(empty)} is empty in the catalogue")
    active = row.get("active")
    named = {"name": row.get("display_name") or entry["id"], "type": row["source_type"], "trust_tier": row["governed_tier"], "url": row["url"], "refresh_minutes": row["refresh_minutes"]}
    return {k: row.get(k) for k in OPTIONAL if k != "notes"} | named | {"id": entry["id"], "parser_asignado": entry["parser_asignado"], "enabled": entry["enabled"] and (True if active is None else bool(active))}


def resolve_sources(thin: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Thin entries with their catalogue row, as a table; one that is missing fails the query, and only active rows stay enabled."""
    joined = thin.join(catalogue.withColumnRenamed("source_id", "id"), "id", "left")
    checked = joined.withColumn("url", F.when(F.col("url").isNull(), F.raise_error(F.concat(F.lit("no catalogue row for source "), F.col("id")))).otherwise(F.col("url")))
    return checked.withColumn("enabled", F.col("enabled") & F.coalesce("active", F.lit(False)))

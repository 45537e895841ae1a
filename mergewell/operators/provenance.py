"""Where records come from: runs, raw artifacts, counters and the quarantine sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mergewell.operators.records import REASON_CODES, RISK_LEVELS

#: Characters of a quarantined text that are shown.
PREVIEW = 500


def as_text(df: DataFrame, column: str) -> Column:
    """Texts as they are, structs, maps and arrays as JSON with sorted keys, anything else as its string."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.StringType):
        return F.col(column)
    if isinstance(kind, T.StructType):
        return F.when(F.col(column).isNotNull(), F.to_json(F.struct(*[F.col(f"{column}.{f}") for f in sorted(kind.fieldNames())]), {"ignoreNullFields": "false"}))
    return F.to_json(column) if isinstance(kind, (T.MapType, T.ArrayType)) else F.col(column).cast("string")


def start_runs(sources: DataFrame, batch: str, started_at: Column) -> DataFrame:
    """scrape_runs: (run_id, source_id, started_at), one for each source; run ids follow from the batch, so a repeated batch has the same ones."""
    ids = sources.select("source_id").where("source_id is not null").distinct()
    return ids.select(F.substring(F.sha2(F.concat_ws("|", F.lit(batch), F.col("source_id").cast("string")), 256), 1, 32).alias("run_id"), "source_id", started_at.alias("started_at"))


def raw_artifacts(pages: DataFrame, runs: DataFrame, body: str = "raw_content") -> DataFrame:
    """One artifact for each page of a source that has a run: (artifact_id, run_id, source_id, source_url, http_status, fetched_at, body_hash, page, raw_text, pii_status).

    Pages without a run are no artifacts (see unrecorded), so nothing is staged without one. The body's
    hash is the page's own where it has one. A page that is met twice in a run has one artifact id.
    """
    have = set(pages.columns)
    optional = lambda c, kind: F.col(c).cast(kind) if c in have else F.lit(None).cast(kind)
    told = pages.withColumn("raw_text", as_text(pages, body)).join(runs.select("run_id", F.col("source_id").alias("run_source")), F.col("source_id") == F.col("run_source"))
    hashed = F.coalesce(optional("content_hash", "string"), F.sha2("raw_text", 256))
    made = told.select("run_id", "source_id", optional("source_url", "string").alias("source_url"), optional("http_status", "int").alias("http_status"), optional("fetched_at", "timestamp").alias("fetched_at"), hashed.alias("body_hash"), optional("page", "int").alias("page"), "raw_text", F.lit("raw").alias("pii_status"))
    number = F.substring(F.sha2(F.concat_ws("|", "run_id", F.coalesce("source_url", F.lit("")), F.coalesce(F.col("page").cast("string"), F.lit("")), F.coalesce("body_hash", F.lit(""))), 256), 1, 32)
    return made.select(number.alias("artifact_id"), *made.columns)


def unrecorded(pages: DataFrame, runs: DataFrame) -> DataFrame:
    """Pages of sources without a run: they must not be staged."""
    return pages.join(runs.select("source_id"), "source_id", "left_anti")


def finish_runs(runs: DataFrame, outcomes: DataFrame, finished_at: Column) -> DataFrame:
    """runs with finished_at and stats, a map of outcome to number, from (source_id, outcome) rows; sources without any have zero `records`."""
    counted = outcomes.groupBy("source_id", "outcome").agg(F.count("*").alias("n"))
    stats = counted.groupBy("source_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("outcome", "n")))).alias("stats"), F.sum("n").alias("records"))
    joined = runs.join(stats, "source_id", "left")
    return joined.select("run_id", "source_id", "started_at", finished_at.alias("finished_at"), F.coalesce("stats", F.create_map(F.lit("records"), F.lit(0).cast("long"))).alias("stats"))


def run_summary(outcomes: DataFrame, columns: tuple[str, ...] = ("staged", "quarantined", "failed")) -> DataFrame:
    """One row for each source with how many records had each outcome, and one of all sources (source_id null); counts are taken before the shuffle."""
    counts = [F.count_if(F.col("outcome") == c).alias(c) for c in columns]
    return outcomes.rollup("source_id").agg(F.count("*").alias("records"), *counts)


def commonest(notes: DataFrame, note: str = "note", most: int = 5) -> DataFrame:
    """The most frequent notices and their number; ties in order of the notice. The limit is the report's."""
    return notes.groupBy(F.col(note).alias("note")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "note").limit(most)


def run_notice(total: int, failed: int, quarantined: int) -> str:
    """OK, DEGRADED (some records failed or are held back) or FAILED (none got through), with the numbers."""
    state = "FAILED" if total and failed == total else "DEGRADED" if failed or quarantined else "OK"
    return f"{state} records={total} failed={failed} quarantined={quarantined}"


def quarantine_sink(rows: DataFrame, run: Column, now: Column, retention_days: int = 30) -> DataFrame:
    """The full quarantine rows to append: review fields, retention and a preview of PREVIEW characters. A reason or risk that is not known fails the query."""
    checked = lambda c, allowed: F.when(F.col(c).isin(*allowed), F.col(c)).otherwise(F.raise_error(F.concat(F.lit(f"unknown {c}: "), F.coalesce(F.col(c), F.lit("null")))))
    return rows.select(
        F.sha2(F.concat_ws("|", "source_slug", "reason_code", "payload_hash"), 256).alias("id"), run.alias("run_id"), "source_slug", checked("reason_code", REASON_CODES).alias("reason_code"),
        checked("risk_level", RISK_LEVELS).alias("risk_level"), F.substring("payload_preview_redacted", 1, PREVIEW).alias("payload_preview_redacted"), "payload_hash", "pii_findings_summary",
        F.lit("pending").alias("review_status"), F.lit(None).cast("string").alias("review_decision"), (now + F.make_dt_interval(days=F.lit(retention_days))).alias("retention_until"), now.alias("quarantined_at"),
    )


def append(rows: DataFrame, folder: str, dry_run: bool = False) -> int | None:
    """Appends rows to a Parquet table and returns how many; a dry run plans and checks the query, writes nothing and returns null."""
    from pyspark.sql import Observation

    if dry_run:
        rows.schema  # noqa: B018
        return None
    seen = Observation("appended")
    rows.observe(seen, F.count("*").alias("n")).write.mode("append").parquet(folder)
    return seen.get["n"]
